"""Packing token sequences by minimum bin slack.

Documents are cut at the window: full windows stand alone, and the rest of each document (shorter than the window)
joins a bounded pool. For a pool, a bitset dynamic programme over its multiset of lengths finds the sum closest to
the window; backtracked counts say how many pieces of each length the window takes, and a choice is repeated while
the pool holds it. Where the pool cannot fill a window, one piece is cut to close it. The last ids of a pool, fewer
than a window, go to sequences whose lengths are powers of two, which need no padding.

Nulls and empty texts give one piece (the end id). An empty table gives no rows. A document id may repeat; each row
is packed as a document of its own. Columns besides id and text are not read. A task holds one pool of at most
``POOL`` remainders at a time, whatever the size or skew of the table, and needs no shuffle.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm import hf
from sluice.llm.chunks import LIMIT
from sluice.llm.common import small_batches

WINDOW = 2048
POOL = 4096
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_NAMES = [x.split()[0] for x in SCHEMA.split(", ")]


def fill(counts: dict[int, int], target: int) -> dict[int, int]:
    """How many pieces of each length sum closest to ``target`` without passing it.

    Bit s of the bitset says that some multiset of the lengths seen so far sums to s. The bitset before each length
    is kept, so that walking back gives the counts. It ends early once ``target`` itself is reached.
    """
    mask, sums, layers = (1 << (target + 1)) - 1, 1, []
    for length in sorted(counts, reverse=True):
        if length > target:
            continue
        layers.append((length, sums))
        for _ in range(min(counts[length], target // length)):
            more = (sums | sums << length) & mask
            if more == sums:
                break
            sums = more
        if sums >> target & 1:
            break
    left, taken = sums.bit_length() - 1, {}
    for length, before in reversed(layers):
        n = 0
        while not before >> left & 1:
            left, n = left - length, n + 1
        if n:
            taken[length] = n
    return taken


def pack_pool(pieces: list[tuple], window: int = WINDOW) -> Iterator[list[tuple]]:
    """Sequences, each a list of pieces (doc, start, ids as bytes, doc_tokens), from a pool of shorter pieces."""
    stock: dict[int, list[tuple]] = defaultdict(list)
    for piece in reversed(pieces):
        stock[len(piece[2]) // 4].append(piece)
    total = sum(n * len(group) for n, group in stock.items())

    def take(length: int) -> tuple:
        group = stock[length]
        piece = group.pop()
        if not group:
            del stock[length]
        return piece

    def cut(size: int) -> list[tuple]:
        """Pieces of exactly ``size`` ids, the last one cut if need be."""
        out = []
        while size:
            doc, start, ids, n = take(max(stock))
            if len(ids) // 4 > size:
                rest = (doc, start + size, ids[4 * size :], n)
                stock[len(rest[2]) // 4].append(rest)
                ids = ids[: 4 * size]
            out.append((doc, start, ids, n))
            size -= len(ids) // 4
        return out

    while total >= window:
        seed = max(stock)
        counts = {n: len(group) for n, group in stock.items()}
        counts[seed] -= 1
        chosen = fill({n: c for n, c in counts.items() if c}, window - seed)
        chosen[seed] = chosen.get(seed, 0) + 1
        filled = sum(n * c for n, c in chosen.items())
        for _ in range(min(len(stock[n]) // c for n, c in chosen.items()) if filled == window else 1):
            yield [take(n) for n, c in chosen.items() for _ in range(c)] + cut(window - filled)
            total -= window
    for bit in reversed(range(total.bit_length())):
        if total >> bit & 1:
            yield cut(1 << bit)


def pack(docs: DataFrame, tokenizer: str, end_id: int, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, pool: int = POOL, memo: int = LIMIT) -> DataFrame:
    """A row for each piece; sequence ids are unique over all tasks and the same if a task runs again.

    A worker's memo of chunks takes at most ``memo`` bytes; that bound changes no row.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = hf.byte_level(tokenizer, memo), np.asarray([end_id], "<u4").tobytes()
        number, rows, held = TaskContext.get().partitionId() << 36, [], []

        def emit(sequence: list[tuple]) -> None:
            nonlocal number
            offset = 0
            for doc, start, ids, n in sequence:
                rows.append((doc, start, len(ids) // 4, zlib.crc32(ids), n, number, offset))
                offset += len(ids) // 4
            number += 1

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows))
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_NAMES)

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), encode.texts(batch.column(1))):
                ids += end
                n = len(ids) // 4
                for start in range(0, n - n % window, window):
                    emit([(doc, start, ids[4 * start : 4 * (start + window)], n)])
                if n % window:
                    held.append((doc, n - n % window, ids[4 * (n - n % window) :], n))
                if len(held) >= pool:
                    for sequence in pack_pool(held, window):
                        emit(sequence)
                    held = []
            if rows:
                yield out()
        for sequence in pack_pool(held, window):
            emit(sequence)
        if rows:
            yield out()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)
