"""Token ids in fixed-width bit-packed blocks.

File format. A dataset is a Parquet folder; Parquet gives atomic commits, retries and any store that Spark reaches.
Each row is one block of whole documents, and blocks are self-describing:

* ``shard`` int, ``block`` int: place in the order of the dataset; shards follow ascending document ids,
* ``bits`` int: width of an id, the least that holds the vocabulary,
* ``first`` long: ids of the shard before this block,
* ``first_doc``, ``last_doc`` long: the least and the largest document id of the block; Parquet keeps their ranges a file,
* ``doc_ids`` array<long>, ``ends`` array<long>: the block's documents and where each ends, counted in ids,
* ``payload`` binary: the ids, most significant bit first, one behind the other without gaps.

Id k of a block lies at bits ``[k * bits, (k + 1) * bits)``, so any range is read without what is before it.
Nulls: a null text is an empty one (only the end id); a null document id sorts first. Documents of equal id keep
separate entries, in the order of a hash of the text, so equal tables give equal files; rows that repeat both are alike. An
empty table gives an empty dataset. Columns besides id and text are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm import hf
from sluice.llm.common import scratch_dir, small_batches

BLOCK_TOKENS = 65_536
SCHEMA = "shard int, block int, bits int, first long, first_doc long, last_doc long, doc_ids array<long>, ends array<long>, payload binary"
#: Ids handled at once, so that the expansion to bits stays small.
_SLICE = 1 << 16


def width(vocabulary: int) -> int:
    """The least bits that hold the ids 0..vocabulary-1."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids below 2**bits to their packed bytes."""
    if bits == 16:
        return ids.astype(">u2").tobytes()
    out = []
    for at in range(0, len(ids), _SLICE):  # a slice of 2**16 ids fills whole bytes at any width
        raw = np.ascontiguousarray(ids[at : at + _SLICE], dtype=">u4").view(np.uint8).reshape(-1, 4)
        out.append(np.packbits(np.unpackbits(raw, axis=1)[:, 32 - bits :].reshape(-1)).tobytes())
    return b"".join(out)


def unpack(payload: bytes, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids start..stop of a block, reading only their bytes."""
    if stop <= start:
        return np.zeros(0, dtype="<u4")
    if bits == 16:
        return np.frombuffer(payload, ">u2", stop - start, 2 * start).astype("<u4")
    first, last = start * bits // 8, -(-stop * bits // 8)
    out = []
    raw = np.unpackbits(np.frombuffer(payload, np.uint8, last - first, first))[start * bits - 8 * first :]
    for at in range(0, stop - start, _SLICE):
        n = min(_SLICE, stop - start - at)
        wide = np.zeros((n, 32), np.uint8)
        wide[:, 32 - bits :] = raw[at * bits : (at + n) * bits].reshape(n, bits)
        out.append(np.packbits(wide, axis=1).view(">u4").reshape(-1))
    return np.concatenate(out).astype("<u4")


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, *, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> None:
    """Encodes every text, appends ``end_id`` and writes the dataset in ascending order of ``id_col``.

    One range exchange orders the documents; each task streams its range into blocks and holds one block at a time.
    """
    small_batches(docs.sparkSession)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, bits = hf.lower_words(tokenizer), width(hf.vocabulary_size(tokenizer))
        end, shard = np.asarray([end_id], "<u4").tobytes(), TaskContext.get().partitionId()
        names, ends, parts, held, first, number = [], [], [], 0, 0, 0

        def flush():
            nonlocal names, ends, parts, held, first, number
            known = [n for n in names if n is not None]
            row = [[shard], [number], [bits], [first], [min(known, default=None)], [max(known, default=None)], [names], [ends], [pack(np.frombuffer(b"".join(parts), "<u4"), bits)]]
            first, number = first + held, number + 1
            names, ends, parts, held = [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, _TYPES)], names=_NAMES)

        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), encode.texts(batch.column(1))):
                raw += end
                held += len(raw) // 4
                names.append(name)
                ends.append(held)
                parts.append(raw)
                if held >= block_tokens:
                    yield flush()
        if names:
            yield flush()

    # Shards are ranges of (id, hash of the text, lot), so their order is the order of ids. The lot splits rows that repeat both.
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"), F.xxhash64(F.monotonically_increasing_id()).alias("lot"))
    ordered = keyed.repartitionByRange("doc_id", "h", "lot").sortWithinPartitions("doc_id", "h", "lot")
    ordered.select("doc_id", "text").mapInArrow(blocks, SCHEMA).write.mode("overwrite").parquet(path)


_NAMES = ["shard", "block", "bits", "first", "first_doc", "last_doc", "doc_ids", "ends", "payload"]
_TYPES = [pa.int32(), pa.int32(), pa.int32(), *[pa.int64()] * 3, pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]


def read(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of a dataset, with ``base``: the ids of all shards before."""
    blocks = spark.read.schema(SCHEMA).parquet(path)
    sizes = blocks.groupBy("shard").agg(F.sum(F.element_at("ends", -1)).alias("n"))  # a row a shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return blocks.join(F.broadcast(bases), "shard")  # a row for each writing task, so payloads need no exchange


def documents(blocks: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from its unpacked ids."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], [], []]
            for row in batch.to_pylist():
                ids = unpack(row["payload"], row["bits"], 0, row["ends"][-1]).tobytes()
                at = 0
                for name, end in zip(row["doc_ids"], row["ends"]):
                    for column, value in zip(out, (name, row["base"] + row["first"] + at, end - at, zlib.crc32(ids[4 * at : 4 * end]))):
                        column.append(value)
                    at = end
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    small_batches(blocks.sparkSession)
    return blocks.select("bits", "first", "doc_ids", "ends", "payload", "base").mapInArrow(rows, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_range(spark: SparkSession, path: str, doc_id: int, start: int, stop: int) -> np.ndarray:
    """Random access: ids start..stop of one document (the first of its id); ``first_doc`` and ``last_doc`` prune files.

    A block that holds the document is fetched, and of its payload only the bytes of those ids are unpacked.
    """
    wanted = F.lit(doc_id).cast("long")
    rows = spark.read.schema(SCHEMA).parquet(path).where((F.col("first_doc") <= wanted) & (F.col("last_doc") >= wanted) & F.array_contains("doc_ids", wanted))
    rows = rows.orderBy("shard", "block").limit(1).collect()
    if not rows:
        raise KeyError(doc_id)
    at = rows[0]["doc_ids"].index(doc_id)
    base = rows[0]["ends"][at - 1] if at else 0
    return unpack(bytes(rows[0]["payload"]), rows[0]["bits"], base + start, min(base + stop, rows[0]["ends"][at]))


def query(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Writes the dataset to the shared folder, reads it back and returns a row per document."""
    path = f"{scratch_dir(spark)}/sluice-{spark.sparkContext.applicationId}/tokens-{uuid.uuid4().hex}"
    write(docs, path, tokenizer, end_id)
    return documents(read(spark, path))
