"""Byte-level BPE by two tiers: a minimal perfect hash for whole pre-tokens, a heap over linked bytes for the rest.

``ids`` of a text are those of a rank file (base64 token, rank) applied to each match of a split pattern, without
special tokens. Null texts encode as empty ones; a decode of the ids gives the text's UTF-8 bytes again.

Rows are encoded each for itself, repeated ones and those of a null id as well; an empty table gives no rows. A text of any
length is one row of a batch; a pre-token of any length goes through the heap in n log n steps. Before both tiers stands a
memo of frequent chunks, of ``chunks.LIMIT`` bytes. Columns besides id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.chunks import ChunkEncoder
from sluice.llm.common import small_batches

_M64 = (1 << 64) - 1


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class MinimalPerfectHash:
    """Hash and displace: n keys to the slots 0..n-1, each key one slot.

    Keys fall into n / 2 groups. Groups of several keys, largest first, try displacements until all their keys meet
    free slots; groups of one key then take what slots remain and store the slot itself, as a negative number.
    """

    def __init__(self, keys: list[bytes]):
        self.n, self.groups = len(keys), max(1, len(keys) // 2)
        hashes = [self._hash(key) for key in keys]
        members: dict[int, list[int]] = {}
        for i, (group, _, _) in enumerate(hashes):
            members.setdefault(group, []).append(i)
        self.shift = np.zeros(self.groups, np.int64)
        self.value = np.full(self.n, -1, np.int64)  # the key's position in ``keys``, by slot
        used, single = bytearray(self.n), []
        for group, own in sorted(members.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(own) == 1:
                single.append((group, own[0]))
                continue
            for d in range(1, 1 << 30):
                slots = {self._slot(hashes[i], d) for i in own}
                if len(slots) == len(own) and not any(used[s] for s in slots):
                    break
            self.shift[group] = d
            for i in own:
                slot = self._slot(hashes[i], d)
                used[slot], self.value[slot] = 1, i
        free = (s for s in range(self.n) if not used[s])
        for (group, i), slot in zip(single, free):
            self.shift[group], self.value[slot] = -slot - 1, i
        self.shift, self.value = self.shift.tolist(), self.value.tolist()

    def _hash(self, key: bytes) -> tuple[int, int, int]:
        import xxhash

        h = xxhash.xxh3_128_intdigest(key)
        return (h & 0xFFFFFFFF) % self.groups, h >> 32 & 0xFFFFFFFF, h >> 64

    def _slot(self, hashed: tuple[int, int, int], d: int) -> int:
        mixed = (hashed[1] + d * hashed[2]) * 0x9E3779B97F4A7C15 & _M64
        return (mixed ^ mixed >> 29) % self.n

    def slot_value(self, key: bytes) -> int:
        """The position that ``key`` would have; the caller compares the key itself."""
        hashed = self._hash(key)
        d = self.shift[hashed[0]]
        return self.value[-d - 1 if d < 0 else self._slot(hashed, d)]


class BytePairEncoder:
    """Ranks, their perfect hash, and the merge heap."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        self.tokens = sorted(ranks, key=ranks.get)
        self.ids = [ranks[t] for t in self.tokens]
        self.hash = MinimalPerfectHash(self.tokens)
        self.bytes_of = dict(zip(self.ids, self.tokens))

    def piece(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        at = self.hash.slot_value(piece)
        return [self.ids[at]] if self.tokens[at] == piece else self.merge(piece)

    def merge(self, piece: bytes) -> list[int]:
        """Joins the adjacent pair of lowest rank, leftmost first, until no pair is a token."""
        rank, n = self.ranks.get, len(piece)
        after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]  # 0 marks a part that has been joined to its left
            if not j or j >= n or end[j] != stop:
                continue
            end[i], end[j] = stop, 0
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank(piece[i : end[k]])) is not None:
                    heapq.heappush(heap, (r, i, end[k]))
            if (p := before[i]) >= 0 and (r := rank(piece[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : end[i]]])
            i = after[i]
        return out


_ENCODERS: dict[tuple[str, str], tuple] = {}


def encoder(path: str, pattern: str):
    """(encode(text) -> bytes of ids, decode(bytes of ids) -> bytes), built once in a worker process."""
    if (path, pattern) not in _ENCODERS:
        import regex

        pairs, split = BytePairEncoder(load_ranks(path), pattern), regex.compile(pattern)

        def piece_ids(text: str) -> bytes:
            ids = [i for m in split.findall(text) for i in pairs.piece(m.encode())]
            return struct.pack(f"<{len(ids)}I", *ids)

        def word_ids(text: str) -> bytes:
            ids = pairs.piece(text.encode())
            return struct.pack(f"<{len(ids)}I", *ids)

        of = pairs.bytes_of.__getitem__
        _ENCODERS[path, pattern] = ChunkEncoder(piece_ids, word_ids), lambda ids: b"".join(map(of, np.frombuffer(ids, "<u4").tolist()))
    return _ENCODERS[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array<int>) of every text."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids, _ = encoder(path, pattern)
        for batch in batches:
            ids = [np.frombuffer(raw, "<i4") for raw in to_ids.texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and text_bytes (binary) of every array of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, to_bytes = encoder(path, pattern)
        for batch in batches:
            raw = [to_bytes(np.asarray(ids or [], "<u4").tobytes()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["doc_id", "text_bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text_bytes binary")


def digests(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes each text, decodes its ids and returns the digests of both; no ids leave the task."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids, to_bytes = encoder(path, pattern)
        sha = lambda raw: hashlib.sha256(raw).hexdigest()
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for raw in to_ids.texts(batch.column(1)):
                counts.append(len(raw) // 4)
                ids_sha.append(sha(raw))
                text_sha.append(sha(to_bytes(raw)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(text_sha)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
