"""Exact n-gram Jaccard self-join with signature trees, and the components of its links.

A document's set holds the distinct shingles of ``n`` words (runs outside [\\x20\\x09-\\x0D], A-Z lower-cased); a
shorter text's whole sequence is its one shingle; without a word the set is empty and links with nothing. Two
documents link when 100 * common >= percent * union. Sets are compared as 64-bit shingle hashes.

1. Equal sets are one node from here on, named by the least row number of its rows.
2. Nodes that can link meet in a bucket. From SEGMENTS_FROM percent on, a bucket is a segment: for each band of sizes that a
   set lies in (bands overlap, so two sizes that can link share one), the shingles are dealt by hash over more segments than
   two linked sets of the band can differ in shingles, so such sets agree in one segment at least, and in one that is not
   empty unless both have very many empty ones; those are dealt anew with another salt. Sets that merely share passages
   or frequent shingles hardly ever agree in a whole segment, so buckets grow with the near copies and not with the corpus.
   Below SEGMENTS_FROM segments would hold too little; there a bucket is an element of the set's prefix and a band of
   sizes. A count sketch over the shingles of all documents says which are frequent, each set is ordered by (frequency
   level, hash), and sets that link share their t least common elements within their first size - ceil(percent * size) + t
   ones, t being SPARE percent of the size and one. Sets with fewer such elements that any other set has go.
3. Buckets are gathered around the member that lies in most of them: a room holds all members of the buckets of one such
   member. Two nodes that can link are in one room at least, and a node is in a few rooms, not in one for each bucket.
4. In a room, bitmaps have a bit for each element that several of its sets hold, so those of single nodes are exact.
   Signature trees hold OR-combined bitmaps and size ranges; the dual traversal of two trees leaves out node pairs whose
   largest possible overlap is too small and those of one component already. Only what joins components leaves the
   room, fewer rows than it has members. Rooms beyond a part's bound are dealt over parts twice first, which joins
   most of a large class; then the members outside the room's largest component meet all parts, or, if they are more
   than a part holds, those parts whose sizes and shared elements allow a link (``_wide_cells``).

No bucket, room, class or candidate list has a cap. Pairs within a component are not enumerated.

Rows of equal id count as one document that has the links of each of its sets. Rows with a null id get a null component
and join nothing. Null and empty texts have n_shingles 0 and are their own component. An empty table gives no rows.
Columns besides id and text are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import discard, materialise, small_batches
from sluice.llm.components import components
from sluice.llm.urlfilter import passing

#: Counters of the sketch; sets of a part, and the shingles that they may hold together.
SKETCH, PART, PART_SHINGLES = 1 << 20, 400, 500_000
SLICE, _SHIFT = 1 << 12, np.uint64(44)
#: Of a set's size, in percent: so many more first elements are sent, and must be shared.
SPARE = 3
#: Ratio of sizes in a band of prefix buckets.
BAND = 1.25
#: Least percent that segments serve, and how often sets with many empty segments are dealt anew at most.
SEGMENTS_FROM, SALTS = 85, 16
#: Words of bitmaps that a step of a traversal compares at most.
_STEP = 1 << 21
#: Nodes under a node of a tree.
FAN = 16
_P = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _P[3]
    x = (x ^ (x >> np.uint64(29))) * _P[0]
    return x ^ (x >> np.uint64(32))


#: Random words by place in a word (modulo 64) and byte, for the hash of a word: their sum.
_TABLE = None


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hashes of the words of lower-cased bytes: tabulation by place and byte."""
    global _TABLE
    if _TABLE is None:
        with np.errstate(over="ignore"):
            _TABLE = _mix(np.arange(1, 64 * 256 + 1, dtype=np.uint64) * _P[1])
    b = np.frombuffer(raw, np.uint8)
    at = np.flatnonzero((b != 32) & ((b < 9) | (b > 13)))
    if not len(at):
        return np.zeros(0, np.uint64)
    new = np.empty(len(at), bool)
    new[0], new[1:] = True, at[1:] != at[:-1] + 1
    starts = np.flatnonzero(new)
    place = np.arange(len(at)) - np.repeat(starts, np.diff(starts, append=len(at)))
    values = _TABLE[(place & 63) << 8 | b[at]]
    if place.max() > 63:
        with np.errstate(over="ignore"):
            values = values * (2 * (place >> 6).astype(np.uint64) * _P[2] + np.uint64(1))
    return np.add.reduceat(values, starts)


def shingles(text: str | None, n: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a whole text."""
    h = word_hashes((text or "").encode("utf-8", "replace").lower())
    if not len(h):
        return np.zeros(0, np.uint64)
    size = min(n, len(h))
    with np.errstate(over="ignore"):
        out = np.full(len(h) - size + 1, size, np.uint64)
        for i in range(size):
            out = _mix(out + h[i : len(h) - size + 1 + i])
    out.sort()
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """A row for each set, with a bit for each element that several of the sets hold."""
    every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    names, at, n = np.unique(every, return_inverse=True, return_counts=True)
    column = np.cumsum(n > 1) - 1
    shared = n[at] > 1
    row, column = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[shared], column[at[shared]]
    words = int((n > 1).sum()) // 64 + 1
    out = np.zeros((len(sets), words), np.uint64)
    np.bitwise_or.at(out, (row, column >> 6), np.uint64(1) << (column & 63).astype(np.uint64))
    return out


class SignatureTree:
    """Levels of nodes over rows in an order; node i of a level covers nodes FAN * i and following of the level below.

    A node has the OR of its rows' bitmaps, their least and largest size, and their least and largest label.
    """

    def __init__(self, bits: np.ndarray, sizes: np.ndarray, rows: np.ndarray):
        self.rows = rows[np.lexsort((bits[rows, 0], sizes[rows]))]
        self.levels = [(bits[self.rows], sizes[self.rows], sizes[self.rows])]
        while len(self.levels[-1][0]) > 1:
            self.grow()

    def grow(self) -> None:
        below, starts = self.levels[-1], np.arange(0, len(self.levels[-1][0]), FAN)
        self.levels.append(tuple(f.reduceat(x, starts, axis=0) for f, x in zip((np.bitwise_or, np.minimum, np.maximum), below)))

    def relabel(self, label: np.ndarray) -> None:
        """Takes new labels of all rows."""
        self.labels = [(label[self.rows],) * 2]
        for level in self.levels[1:]:
            starts, (least, most) = np.arange(0, len(self.labels[-1][0]), FAN), self.labels[-1]
            self.labels.append((np.minimum.reduceat(least, starts), np.maximum.reduceat(most, starts)))


def _children(nodes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    below = nodes[:, None] * FAN + np.arange(FAN)
    return below, below < n


def merge(parent: np.ndarray, x: np.ndarray, y: np.ndarray) -> bool:
    """Joins the classes of x and y in a table of least members; whether any changed."""
    changed = False
    while len(x):
        a, b = parent[x], parent[y]
        apart = a != b
        x, y, a, b = x[apart], y[apart], a[apart], b[apart]
        if len(x):
            changed = True
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
            while (parent[parent] != parent).any():
                parent[:] = parent[parent]
    return changed


def join_trees(left: SignatureTree, right: SignatureTree, label: np.ndarray, percent: int) -> None:
    """Dual traversal: joins the labels (positions of least members) of all rows of ``left`` and ``right`` that link."""
    while len(left.levels) < len(right.levels):
        left.grow()
    while len(right.levels) < len(left.levels):
        right.grow()
    left.relabel(label)
    right.relabel(label)
    wave = max(1, _STEP // (FAN * FAN * left.levels[0][0].shape[1]))
    stack = [(len(left.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    top = True
    while stack:
        level, i, j = stack.pop()
        if not top:  # a step down
            (i, fine), (j, good) = _children(i, len(left.levels[level][0])), _children(j, len(right.levels[level][0]))
            i, j = np.broadcast_arrays(i[:, :, None], j[:, None, :])
            keep = (fine[:, :, None] & good[:, None, :]).ravel()
            i, j = i.ravel()[keep], j.ravel()[keep]
        top = False
        (low, high), (least, most) = left.labels[level], right.labels[level]
        apart = ~((low[i] == high[i]) & (least[j] == most[j]) & (low[i] == least[j]))
        i, j = i[apart], j[apart]
        (a, small, large), (b, little, big) = left.levels[level], right.levels[level]
        # sizes first: what they rule out needs no bitmap
        near = (100 + percent) * np.minimum(large[i], big[j]) >= percent * (small[i] + little[j])
        i, j = i[near], j[near]
        overlap = np.bitwise_count(a[i] & b[j]).sum(1).astype(np.int64)
        bound = np.minimum(np.minimum(large[i], big[j]), overlap)
        fits = (100 + percent) * bound >= percent * (small[i] + little[j])
        i, j = i[fits], j[fits]
        if level == 0:
            if merge(label, label[left.rows[i]], label[right.rows[j]]):
                left.relabel(label)
                right.relabel(label)
            continue
        for at in range(0, len(i), wave):
            stack.append((level - 1, i[at : at + wave], j[at : at + wave]))


def forest(names: np.ndarray, roots: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(root, least root that it is joined with) for the links between rows of side 1 or 3 and rows of side 2 or 3."""
    _, once = np.unique(names, return_index=True)
    sets, sides = [sets[i] for i in once], sides[once]
    known, label = np.unique(roots[once], return_inverse=True)
    _, first = np.unique(label, return_index=True)
    label = first[label]  # the first row of each root stands for it
    own, bits, sizes = label.copy(), bitmaps(sets), np.asarray([len(s) for s in sets], np.int64)
    rows, columns = np.flatnonzero(sides & 1), np.flatnonzero(sides & 2)
    if len(rows) and len(columns):
        join_trees(SignatureTree(bits, sizes, rows), SignatureTree(bits, sizes, columns), label, percent)
    roots = roots[once]
    moved = np.unique(np.stack([roots[own], roots[label]], axis=1)[own != label], axis=0)
    return moved[:, 0], moved[:, 1]


@functools.cache
def size_bands(percent: int) -> tuple[float, float]:
    """Ratio of the lower ends of following bands, and ratio of a band's ends: sizes that can link share a band."""
    ratio = 100 / percent
    step = ratio ** max(1, int(30 / (100 - percent)))
    return step, step * ratio


@functools.cache
def segments_of(band: int, percent: int) -> tuple[int, int]:
    """Segments of a band, and how many of them two linked sets agree in at least."""
    step, width = size_bands(percent)
    low, high = max(1, int(step**band)), int(step**band * width) + 1
    differ = 2 * high * (100 - percent) // (100 + percent)
    return next((n, n - differ) for n in range(differ + 1, 10**9) if n * np.exp(-low / n) < n - differ or n > 2 * differ)


def segment_keys(s: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the buckets of a set: linked sets share one.

    A set under a salt with fewer empty segments than linked sets agree in shares a segment with shingles with any set
    that it links with; others come under the next salt too. Under the last salt empty segments are keys as well.
    """
    if percent >= 100 or not len(s):
        return np.zeros(0, np.uint64)
    step, width = size_bands(percent)
    # a set of size n lies in the bands that begin at n / width to n; one more at each end for the rounding
    first = max(0, int(np.floor(np.log(len(s) / width) / np.log(step))))
    out = []
    for band in range(first, int(np.log(len(s)) / np.log(step)) + 2):
        if not int(step**band) <= len(s) <= int(step**band * width) + 1:
            continue
        n, agree = segments_of(band, percent)
        for salt in range(SALTS):
            with np.errstate(over="ignore"):
                own = _mix(s + np.uint64(2 * salt + 1) * _P[1])
                at = ((own >> np.uint64(33)) % np.uint64(n)).astype(np.int64)
                half = [np.bincount(at, (_mix(own ^ _P[2]) >> shift & np.uint64(0xFFFFFFFF)).astype(np.float64), n).astype(np.uint64) for shift in (np.uint64(0), np.uint64(32))]
                held = np.bincount(at, minlength=n) > 0
                name = np.uint64((band * SALTS + salt) * 2 + 1) * _P[0]
                keys = _mix(_mix(half[0] + half[1] * _P[3]) + np.arange(n, dtype=np.uint64) * _P[1] + name)
            enough = n - int(held.sum()) < agree
            out.append(keys[held] if enough or salt < SALTS - 1 else keys)
            if enough:
                break
    return np.unique(np.concatenate(out))


def _sketch(docs: DataFrame, n: int) -> np.ndarray:
    """How often the shingles of all documents fall on each of SKETCH counters.

    A task sends its counters in slices; each slice is added up as a stream.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                np.add.at(held, (shingles(text, n) >> _SHIFT).astype(np.int64), 1)
        yield send(dict(enumerate(held.reshape(-1, SLICE))))

    def send(slices: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(slices), pa.int32()), pa.array([x.astype("<i8").tobytes() for x in slices.values()], pa.binary())], names=["slice", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held[k] = held.get(k, 0) + np.frombuffer(raw, "<i8")
        if held:
            yield send(held)

    total = np.zeros(SKETCH, np.int64).reshape(-1, SLICE)
    schema = "slice int, counts binary"
    for r in docs.select("text").mapInArrow(count, schema).repartition("slice").mapInArrow(add, schema).collect():
        total[r["slice"]] = np.frombuffer(bytes(r["counts"]), "<i8")
    return total.reshape(-1)


def spare(size):
    """Elements that linked sets share at least among their first ones, by the smaller set's size."""
    return size * SPARE // 100 + 1


def _prefixes(docs: DataFrame, n: int, percent: int):
    """A function that gives the first elements of a set in the common order; its table of levels has SKETCH bytes."""
    counts = _sketch(docs, n)
    usual = max(1.0, float(counts.mean()))
    level = np.maximum(0, np.floor(np.log2(np.maximum(counts, 1) / (2 * usual))) + 1).astype(np.int8)
    shared = docs.sparkSession.sparkContext.broadcast(level)

    def prefix(s: np.ndarray) -> np.ndarray:
        first = len(s) - -(-percent * len(s) // 100) + spare(len(s)) if len(s) else 0
        return s[np.argsort(shared.value[(s >> _SHIFT).astype(np.int64)], kind="stable")[:first]]

    return prefix


def _features(docs: DataFrame, n: int, keys_of) -> DataFrame:
    """doc_id, a hash of the text, size, the set's hash, and what ``keys_of`` the set gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(2).to_pylist():
                s = shingles(text, n)
                rows.append((len(s), *set_key(s), signed(keys_of(s))))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            own = [pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *own], names=["doc_id", "text_hash", "size", "k1", "k2", "keys"])

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, "doc_id long, text_hash long, size long, k1 long, k2 long, keys array<long>")


def set_key(s: np.ndarray) -> tuple[int, int]:
    """128 bits of hash of a set."""
    import xxhash

    key = xxhash.xxh3_128_digest(s.tobytes())
    return int.from_bytes(key[:8], "little", signed=True), int.from_bytes(key[8:], "little", signed=True)


def _sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """node and whole set of the rows ``wanted`` (node, doc_id, text_hash, k1); copies of a row in a task give one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            nodes, sets = [], []
            for node, k1, text in zip(*(c.to_pylist() for c in batch.columns)):
                if node not in seen:
                    s = shingles(text, n)
                    if set_key(s)[0] == k1:
                        seen.add(node)
                        nodes.append(node)
                        sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], names=["node", "set"])

    # a bounded filter keeps the other texts out of the exchange
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").withColumn("key", F.xxhash64("doc_id", "text_hash"))
    docs = passing(docs, wanted.select(F.xxhash64("doc_id", "text_hash").alias("key")), wanted.count()).drop("key")
    same = docs["doc_id"].eqNullSafe(wanted["doc_id"]) & (docs["text_hash"] == wanted["text_hash"])
    return docs.join(wanted, same).select("node", "k1", "text").mapInArrow(run, "node long, set binary")


def _part(count: Column, *of) -> Column:
    return F.pmod(F.xxhash64(*of), F.greatest(count, F.lit(1))).cast("int")


def _band(size: Column) -> Column:
    return F.floor(F.log(size) / F.log(F.lit(BAND))).cast("int")


def _segment_buckets(nodes: DataFrame) -> DataFrame:
    """(e, band, node, size) of the segments that several nodes have; a segment of very many nodes is counted in each task and
    then only joined with its count."""
    entries = nodes.select("node", "size", F.explode("keys").alias("e"))
    common = materialise(entries.groupBy("e").agg(F.count("*").alias("n")).where("n > 1").select("e"), "common")
    buckets = materialise(entries.join(common, "e").select("e", F.lit(0).alias("band"), "node", "size"), "buckets")
    discard(common)
    return buckets


def _prefix_buckets(nodes: DataFrame, percent: int) -> DataFrame:
    """(e, band, node, size) of the prefix elements that several nodes of like size have."""
    # buckets: an element that several nodes have, and a band of sizes; a node also visits the larger bands that it reaches
    entries = nodes.select("node", "size", F.posexplode("keys").alias("at", "e"))
    common = entries.groupBy("e").agg(F.count("*").alias("n")).where("n > 1").select("e")
    common = materialise(common, "common")
    entries = entries.join(common, "e")
    bands = F.sequence(_band(F.col("size")), _band(F.col("size") * 100 / percent))
    visits = materialise(entries.select("e", "at", "node", "size", F.posexplode(bands).alias("visit", "band")), "visits")
    # nodes that meet others of like size in too few elements go
    met = lambda v: v.groupBy("e", "band").agg(F.count("*").alias("n"), F.count_if(F.col("visit") == 0).alias("own")).where("n > 1 and own > 0").select("e", "band")
    held = materialise(visits.join(met(visits), ["e", "band"], "left_semi"), "visits")
    discard(common, visits)
    needed = F.floor(F.ceil(F.col("size") * percent / 100) * SPARE / 100) + 1
    enough = held.groupBy("node").agg(F.count_distinct("e").alias("n"), F.first("size").alias("size")).where(F.col("n") >= needed).select("node")
    first = F.col("size") - F.ceil(F.col("size") * percent / 100) + 1
    sifted = materialise(held.join(enough, "node", "left_semi").where(F.col("at") < first), "visits")
    buckets = materialise(sifted.join(met(sifted), ["e", "band"], "left_semi").select("e", "band", "node", "size"), "visits")
    discard(held, sifted)
    return buckets


def _rooms(buckets: DataFrame) -> DataFrame:
    """(room, node, size) of nodes that may link with another: linking nodes share a room."""
    # a bucket belongs to the member that lies in most buckets
    held = buckets.join(buckets.groupBy("node").agg(F.count("*").alias("degree")), "node")
    centres = held.groupBy("e", "band").agg(F.max_by("node", F.struct("degree", F.xxhash64("node"))).alias("room"))
    rooms = materialise(held.join(centres, ["e", "band"]).select("room", "node", "size").distinct(), "rooms")
    discard(buckets)
    return rooms


def _links(nodes: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(u, v) between nodes that join all nodes that links do; nodes has node, size, keys, doc_id, text_hash, k1."""
    rooms = _rooms(_segment_buckets(nodes) if percent >= SEGMENTS_FROM else _prefix_buckets(nodes, percent))
    wanted = nodes.join(rooms.select("node").distinct(), "node", "left_semi").select("node", "doc_id", "text_hash", "k1")
    wanted = materialise(wanted, "wanted")
    sets = materialise(_sets(docs, wanted, n), "sets")

    def in_part(table: pa.Table) -> pa.Table:
        names, roots, sides = (np.asarray(table.column(c).combine_chunks(), np.int64) for c in ("node", "root", "side"))
        u, v = forest(names, roots, sides, [np.frombuffer(s, np.uint64) for s in table.column("set").to_pylist()], percent)
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    def meet(rows: DataFrame) -> DataFrame:
        return rows.select("room", "cell", "node", "root", "side").join(sets, "node").groupBy("room", "cell").applyInArrow(in_part, "u long, v long")

    parts = lambda rows, size: F.greatest(F.ceil(F.col(rows) / PART), F.ceil(F.col(size) / PART_SHINGLES)).cast("int")
    about = rooms.groupBy("room").agg(F.count("*").alias("n"), F.sum("size").alias("weight"))
    large = materialise(about.select("room", parts("n", "weight").alias("parts")).where("parts > 1"), "large")
    tagged, dealt = rooms.withColumn("root", F.col("node")), None
    if not large.isEmpty():
        deal = F.explode(F.transform(F.array(F.lit(0), F.lit(1)), lambda k: _part(F.col("parts"), k, "node") + k * F.col("parts")))
        dealt = materialise(meet(rooms.join(large, "room").withColumns({"cell": deal, "root": F.col("node"), "side": F.lit(3)})), "links")
        tagged = rooms.join(components(dealt).withColumnRenamed("u", "node"), "node", "left").withColumn("root", F.coalesce("root", "node"))
        tagged = materialise(tagged, "tagged")

    # the members outside a room's largest component meet all of it
    held = tagged.groupBy("room", "root").agg(F.count("*").alias("m"), F.sum("size").alias("w"))
    held = held.groupBy("room").agg(F.sum("m").alias("n"), F.sum("w").alias("weight"), F.count("*").alias("roots"), F.max_by(F.struct("root", "m", "w"), F.struct("m", "root")).alias("main"))
    held = held.where("roots > 1").select("room", F.col("main.root").alias("main"), parts("n", "weight").alias("columns"), F.expr("n - main.m").alias("n"), F.expr("weight - main.w").alias("weight"))
    held = materialise(held.withColumn("lines", parts("n", "weight")), "open-rooms")
    found = meet(_cells(tagged, held.where("lines = 1")))
    wide = held.where("lines > 1")
    if not wide.isEmpty():
        found = found.unionByName(meet(_wide_cells(tagged, wide, sets, percent)))
    links = materialise(found.unionByName(dealt) if dealt is not None else found, "links")
    discard(rooms, wanted, sets, large, tagged, held, *([dealt] if dealt is not None else []))
    return links


def _cells(tagged: DataFrame, held: DataFrame) -> DataFrame:
    """(room, cell, node, root, side): each member in one cell, the minor ones, one part of them, in every cell of their room."""
    met = tagged.join(held, "room")
    minor, column = F.col("root") != F.col("main"), _part(F.col("columns"), F.lit(3), "node")
    every = F.sequence(F.lit(0), F.greatest(F.col("columns"), F.lit(1)) - 1)
    cell = lambda j: F.struct(j.alias("cell"), (F.when(j == column, 2).otherwise(0) + F.when(minor, 1).otherwise(0)).alias("side"))
    cells = F.transform(F.when(minor, every).otherwise(F.array(column)), cell)
    return met.select("room", "node", "root", F.explode(cells).alias("x")).select("room", F.col("x.cell").cast("long").alias("cell"), "node", "root", "x.side")


#: Ratio of sizes in a part of a wide room.
SIZE_CLASS = 1.02


def _wide_cells(tagged: DataFrame, wide: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The same for rooms of more minor members than a part holds, where all would meet all.

    A set that is a component of its own can share with others only the elements that some other component of the room
    has as well: its use. Members are dealt over parts by size; a part is a node with its least size and largest use, and
    two parts meet only where these allow a link. Only rows of parts are paired, sets are sent for what is left. Members
    of one template, whose differences are their own, mostly have too little in use for any part.
    """
    members = materialise(tagged.join(wide.select("room", "main"), "room").select("room", "node", "root", "size", "main"), "wide-rooms")

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for room, root, raw in zip(*(c.to_pylist() for c in batch.columns)):
                e = np.frombuffer(raw, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(e), room)), pa.array(np.full(len(e), root)), pa.array(e)], names=["room", "root", "e"])

    own = members.join(sets, "node").select("room", "root", "set").mapInArrow(elements, "room long, root long, e long")
    own = own.groupBy("room", "e").agg(F.min("root").alias("root"), F.max("root").alias("last")).where("root = last").groupBy("room", "root").agg(F.count("*").alias("own"))
    single = members.where("root <> main").groupBy("room", "root").agg(F.count("*").alias("n")).where("n = 1").select("room", "root")
    used = members.join(own.join(single, ["room", "root"], "left_semi"), ["room", "root"], "left")
    used = used.withColumn("use", F.col("size") - F.coalesce("own", F.lit(0))).withColumn("class", F.floor(F.log("size") / F.log(F.lit(SIZE_CLASS))).cast("long"))
    used = materialise(used.drop("own"), "wide-members")
    parts = used.groupBy("room", "class").agg(F.greatest(F.ceil(F.count("*") / PART), F.ceil(F.sum("size") / PART_SHINGLES)).cast("int").alias("parts"))
    dealt = materialise(used.join(parts, ["room", "class"]).withColumn("part", F.struct("class", _part(F.col("parts"), F.lit(4), "node").alias("k"))).drop("parts"), "wide-parts")
    about = dealt.groupBy("room", "part").agg(F.min("size").alias("small"), F.max("use").alias("most"), F.bool_or(F.col("root") != F.col("main")).alias("minor"))
    about = materialise(about, "wide-nodes")
    a, b = (about.select("room", *[F.col(c).alias(f"{c}_{k}") for c in ("part", "small", "most", "minor")]) for k in "ab")
    fits = (100 + percent) * F.least("most_a", "most_b") >= percent * (F.col("small_a") + F.col("small_b"))
    pairs = a.join(b, "room").where((F.col("part_a") <= F.col("part_b")) & (F.col("minor_a") | F.col("minor_b")) & fits)
    pairs = materialise(pairs.select("room", "part_a", "part_b").withColumn("cell", F.monotonically_increasing_id()), "wide-pairs")
    same = F.col("part_a") == F.col("part_b")
    sides = F.when(same, F.array(F.struct(F.col("part_a").alias("part"), F.lit(3).alias("side")))).otherwise(F.array(F.struct(F.col("part_a").alias("part"), F.lit(1).alias("side")), F.struct(F.col("part_b").alias("part"), F.lit(2).alias("side"))))
    out = dealt.join(pairs.select("room", "cell", F.inline(sides)), ["room", "part"])
    return out.select("room", "cell", "node", "root", "side")


def _classes(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows as (doc_id, text_hash, size, node), node null for an empty set, and links between nodes.

    ``docs`` has doc_id and text. Rows of one set have one node, the least row number of them.
    """
    small_batches(docs.sparkSession)
    keys_of = (lambda s: segment_keys(s, percent)) if percent >= SEGMENTS_FROM else _prefixes(docs, n, percent)
    features = materialise(_features(docs, n, keys_of).withColumn("row", F.monotonically_increasing_id()), "features")
    nodes = features.where("size > 0").groupBy("k1", "k2").agg(F.min("row").alias("node"), F.min_by(F.struct("size", "keys", "doc_id", "text_hash"), "row").alias("x"))
    nodes = materialise(nodes.select("k1", "k2", "node", "x.*"), "nodes")
    links = _links(nodes, docs, n, percent)
    rows = features.where("size > 0").select("doc_id", "text_hash", "size", "k1", "k2").join(nodes.select("k1", "k2", "node"), ["k1", "k2"]).select("doc_id", "text_hash", "size", "node")
    empty = features.where("size = 0").select("doc_id", "text_hash", "size", F.lit(None).cast("long").alias("node"))
    rows = materialise(rows.unionByName(empty), "rows")
    discard(features, nodes)
    return rows, links


def _rooted(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` with the root of their node's component."""
    out = rows.join(components(links).withColumnRenamed("u", "node"), "node", "left")
    return materialise(out.withColumn("root", F.coalesce("root", "node")), "rooted")


def link(docs: DataFrame, *, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (least id reachable by links, itself included)."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows, links = _classes(docs.where("doc_id is not null"), n, percent)
    # the sets of one id are one document
    several = rows.groupBy("doc_id").agg(F.min("node").alias("v"), F.max("node").alias("last")).where("v <> last").select("doc_id", "v")
    several = materialise(several, "several")
    if not several.isEmpty():
        links = links.unionByName(rows.where("node is not null").join(several, "doc_id").select(F.col("node").alias("u"), "v"))
    rows = _rooted(rows, links)
    least = rows.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    out = rows.join(least, "root", "left").select("doc_id", F.col("size").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))
    if not several.isEmpty():  # rows of such ids that have no shingle belong to their document as well
        own = out.groupBy("doc_id").agg(F.min("component_id").alias("own"))
        out = out.join(own, "doc_id").select("doc_id", "n_shingles", F.col("own").alias("component_id"))
    nameless = docs.where("doc_id is null").mapInArrow(_sizes(n), "doc_id long, n_shingles long, component_id long")
    return out.unionByName(nameless)


def _sizes(n: int):
    """Rows without an id: their set sizes, no component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.array([len(shingles(t, n)) for t in batch.column(1).to_pylist()], pa.int64())
            none = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([none, sizes, none], names=["doc_id", "n_shingles", "component_id"])

    return run


def keep_one(docs: DataFrame, *, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are: of each component one, of least id (null last), then of least text hash.

    Rows are told apart by id and text, so ids may be null or shared by different texts; rows that repeat both are one.
    Rows without a word stay, once each if they repeat both. Nothing is decided by other columns.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows, links = _classes(own, n, percent)
    rows = _rooted(rows, links)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    chosen = rows.where("root is not null").groupBy("root").agg(F.min_by(F.struct("doc_id", "text_hash"), order).alias("c"))
    key = lambda: [F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")]
    later = rows.join(chosen, "root").where(~(F.col("doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("text_hash") == F.col("c.text_hash")))).select(*key()).distinct()
    again = materialise(rows.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1").select(*key()), "again")
    # other columns may have any name, so rows travel as one struct
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    same = F.col("_row")[id_col].cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(F.col("_row")[text_col]) == F.col("_hash"))
    kept = packed.join(materialise(later, "later"), same, "left_anti")
    if not again.isEmpty():
        one = kept.join(again, same, "left_semi").withColumns({"_id": F.col("_row")[id_col], "_hash": F.xxhash64(F.col("_row")[text_col])})
        kept = kept.join(again, same, "left_anti").unionByName(one.groupBy("_id", "_hash").agg(F.first("_row").alias("_row")).select("_row"))
    return kept.select("_row.*")


def query(docs: DataFrame) -> DataFrame:
    return link(docs, n=3, percent=90)


ORACLE = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 90 * (x.n + y.n - c)),
b AS (SELECT u, v FROM e UNION ALL SELECT v, u FROM e),
r AS (SELECT doc_id AS d, doc_id AS reached FROM documents UNION SELECT r.d, b.v FROM r JOIN b ON b.u = r.reached)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, x.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT d AS doc_id, min(reached) AS component_id FROM r GROUP BY 1) x USING (doc_id)
"""
