"""Exact top-k by inner product over an impact-ordered index, score at a time.

Vectors become integers, floor(scale * x). Rows are dealt into blocks. A block's index has, for each component, its
postings in segments of equal quantised impact (the magnitude's top bits), highest first. A query reads segments of
all components by descending impact of the product. What is unread bounds every score: a vector's score lies within
the sum over components of |q| times the impact still to come. Reading stops only on proof that few vectors can be
members: those whose upper bound reaches the k-th best lower bound. These are rescored exactly, so the result is exact
wherever reading stops.

Every query meets every row once: a stated query set against all rows, in blocks. Rows are dealt by hash into lots of a
few blocks; a task builds a lot's indexes once, and blocks of queries then stream past them. Each query gets k rows a
lot, and a window ranks these. Memory is one lot and one batch of query blocks.

Vectors that are null or hold a null or non-finite component take no part; a vector of another length counts as if its
missing components were 0. Fewer than k candidates give all. Ties go to the smaller id. Candidates of equal id keep separate
entries. Queries that repeat id and vector are one query; those of one id with different vectors are each ranked for
themselves. A query never meets a candidate of its own id. An empty table of rows or of queries gives no rows. Components times scale, and scores, must fit a long. Columns besides
id and vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import small_batches

#: Rows of a block and of a lot (where lots of one block would be more than tasks want), queries of a block, impact levels.
ROWS, LOT, QUERIES, LEVELS = 4096, 65_536, 512, 6


class BlockIndex:
    """Impact-ordered postings of one block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        size = np.abs(vectors)
        self.top = size.max(0) if len(vectors) else np.zeros(vectors.shape[1], np.int64)
        # quantised impact: the level of a magnitude below its component's largest, by equal steps
        step = np.maximum(1, -(-self.top // LEVELS))
        level = np.minimum(LEVELS - 1, np.maximum(0, (self.top - size) // step))
        self.segments, self.ceiling = [], np.zeros((vectors.shape[1], LEVELS + 1), np.int64)
        for d in range(vectors.shape[1]):
            order = np.argsort(level[:, d], kind="stable")
            cuts = np.searchsorted(level[order, d], np.arange(LEVELS + 1))
            own = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
            self.segments.append([(rows, vectors[rows, d]) for rows in own])
            for k in reversed(range(LEVELS)):  # the largest magnitude in this segment or a later one
                self.ceiling[d, k] = max(int(size[own[k], d].max()) if len(own[k]) else 0, self.ceiling[d, k + 1])

    def search(self, name: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k best (score, id) of the block for one query, best first."""
        weight = np.abs(query)
        gain = weight[:, None] * self.ceiling
        order = np.argsort(-gain[:, :LEVELS], axis=None, kind="stable")
        sums, unread = np.zeros(len(self.ids), np.int64), int(gain[:, 0].sum())
        other, need = self.ids != name, max(4 * k, 64)
        for at, i in enumerate(order.tolist()):
            d, level = divmod(i, LEVELS)
            if not gain[d, level]:
                break
            rows, values = self.segments[d][level]
            sums[rows] += query[d] * values
            unread -= int(gain[d, level] - gain[d, level + 1])
            if at % 32 == 31 and other.sum() > k:
                floor = np.partition(sums[other], -k)[-k] - unread
                if int((sums[other] + unread >= floor).sum()) <= need:
                    break
        members = np.flatnonzero(other)
        if len(members) > k:
            members = members[sums[members] + unread >= np.partition(sums[members], -k)[-k] - unread]
        exact = self.vectors[members] @ query
        best = np.lexsort((self.ids[members], -exact))[:k]
        return list(zip(exact[best].tolist(), self.ids[members][best].tolist()))


def matrix(column: pa.Array, scale: int) -> np.ndarray:
    """Vectors of an Arrow list column as integers, shorter ones filled with zeros."""
    sizes = np.asarray(column.value_lengths(), np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.floor(scale * np.asarray(column.flatten(), np.float64))
    return out


def _wide(x: np.ndarray, width: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, max(0, width - x.shape[1]))))


def _packed(vectors: DataFrame, rows: int, scale: int) -> DataFrame:
    """Blocks of at most ``rows`` rows of one lot: ids, keys and integer matrices as bytes. Rows come sorted by lot."""

    def block(lot: int, ids: np.ndarray, keys: np.ndarray, m: np.ndarray) -> pa.RecordBatch:
        small = np.int32 if not m.size or np.abs(m).max() < 2**31 else np.int64
        raw = [[lot], [ids.tobytes()], [keys.tobytes()], [m.shape[1]], [m.astype(small).tobytes()]]
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(raw, kinds)], names=_BLOCK.replace(",", "").split()[::2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lots, ids, keys = (np.asarray(batch.column(i), np.int64) for i in range(3))
            m = matrix(batch.column(3), scale)
            cuts = [0, *(np.flatnonzero(np.diff(lots)) + 1).tolist(), len(lots)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                for at in range(a, b, rows):
                    part = slice(at, min(at + rows, b))
                    if part.stop > at:
                        yield block(int(lots[at]), ids[part], keys[part], m[part])

    return vectors.select("lot", "i", "key", "v").mapInArrow(run, _BLOCK)


_BLOCK = "lot int, ids binary, keys binary, width int, matrix binary"


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, keys = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["keys"], np.int64)
    cells = len(ids) * row["width"]
    kind = np.int32 if len(row["matrix"]) == 4 * cells else np.int64
    return ids, keys, np.frombuffer(row["matrix"], kind).reshape(len(ids), row["width"]).astype(np.int64)


def search(vectors: DataFrame, queries: DataFrame, k: int, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of ``vectors`` for each row of ``queries``."""
    spark = vectors.sparkSession
    small_batches(spark)

    def usable(df: DataFrame) -> DataFrame:
        v = F.col("v")
        fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return df.select(F.col(id_col).cast("long").alias("i"), F.col(vector_col).cast("array<double>").alias("v")).where(v.isNotNull() & fine & F.col("i").isNotNull()).withColumn("key", F.xxhash64("v"))

    total = vectors.count()
    lots = max(1, -(-total // LOT), min(-(-total // ROWS), 4 * spark.sparkContext.defaultParallelism))
    lot = F.pmod(F.xxhash64("i", "key", F.monotonically_increasing_id()), F.lit(lots)).cast("int")
    rows = usable(vectors).withColumn("lot", lot).repartition(lots, "lot").sortWithinPartitions("lot")
    rows = _packed(rows, ROWS, scale).withColumn("side", F.lit(0))
    asked = usable(queries).dropDuplicates(["i", "key"]).withColumn("lot", F.lit(0))
    asked = _packed(asked, QUERIES, scale).withColumn("lot", F.explode(F.sequence(F.lit(0), F.lit(lots - 1)))).withColumn("side", F.lit(1))
    met = rows.select("lot", "side", "ids", "keys", "width", "matrix").unionByName(asked.select("lot", "side", "ids", "keys", "width", "matrix"))
    met = met.repartition(lots, "lot").sortWithinPartitions("lot", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, index = None, [], None
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]  # a block
                if row["lot"] != current:
                    current, held, index = row["lot"], [], None
                ids, keys, m = _unpacked(row)
                if row["side"] == 0:
                    held.append((ids, m))
                    continue
                if index is None:
                    width = max((x.shape[1] for _, x in held), default=0)
                    index, held = lot_indexes(held, width), []
                best = [found for name, key, q in zip(ids.tolist(), keys.tolist(), m) for found in best_of(index, name, key, q, k)]
                columns = list(zip(*best)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "key", "vec_id", "score"])

    best = met.mapInArrow(run, "query_id long, key long, vec_id long, score long")
    order = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def lot_indexes(blocks: list[tuple[np.ndarray, np.ndarray]], width: int) -> list[BlockIndex]:
    """Indexes of a lot's rows, joined to full blocks."""
    if not blocks:
        return []
    ids, m = np.concatenate([i for i, _ in blocks]), np.concatenate([_wide(x, width) for _, x in blocks])
    return [BlockIndex(ids[at : at + ROWS], m[at : at + ROWS]) for at in range(0, len(ids), ROWS)]


def best_of(indexes: list[BlockIndex], name: int, key: int, query: np.ndarray, k: int) -> list[tuple[int, int, int, int]]:
    """The k best rows of a lot for one query; components beyond the lot's width meet only zeros."""
    found = []
    for index in indexes:
        q = np.zeros(index.vectors.shape[1], np.int64)
        q[: len(query)] = query[: len(q)]
        found += index.search(name, q, k)
    return [(name, key, i, s) for s, i in sorted(found, key=lambda x: (-x[0], x[1]))[:k]]


def query(vectors: DataFrame) -> DataFrame:
    return search(vectors, vectors.where("vec_id % 100 = 0"), 10)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, q.e AS asked, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, least(len(q.e), len(c.e)) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM (SELECT DISTINCT vec_id, e FROM v) q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id, asked ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
