"""Language identification by nearest centroids.

A text's vector counts its character n-grams (1 to 3 letters, lower case, anything else as one blank) in ``DIM``
hashed places, damped by a logarithm, weighted by inverse document frequency and normalised. Each language has several
centroids from spherical k-means; the nearest centroid by cosine names the language. Clusters with less than
``MIN_SHARE`` of a language's sample are left out, as rows with a wrong label gather there. A text is rejected if its
cosine to the nearest centroid is below the floor of that language and the text's length class (half an octave of its
letters): ``MARGIN`` times the ``QUANTILE`` of the cosines of all training rows that are named as they are labelled.
Classes with fewer than ``MIN_ROWS`` such rows are merged with the nearest ones, shorter first, where the least floor
holds and those of longer texts are lowered by the root of the letters; languages that have fewer in all take the
merged classes of all languages; ``MIN_COSINE`` holds besides, and alone if the training rows are fewer still.

Document frequencies and floors come from all training rows. The centroids are fitted on a bounded sample: of each language
the rows of the least hashes of id and text, at most ``SAMPLE`` and about ``MAX_SAMPLE`` in all, eight at least if it has
them, so every language of the training rows has a centroid. ``max_languages`` is a parameter that bounds the broadcast
model; more languages than it says are an error, never left out.
Null texts and texts without a letter are ``und``, score 0, and rejected. With no training rows every text is ``und``.
Repeated rows, and rows that share an id, are rows of their own; those that repeat id and text are drawn once. Of languages
equally near the first in order of name is named. Nothing is predicted of an empty table. Columns besides id, text and
language are not read.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import discard, materialise, small_batches

DIM, CENTROIDS, ROUNDS = 4096, 4, 12
SAMPLE, MAX_SAMPLE, MAX_LANGUAGES = 500, 4_000, 1_000
#: Least cosine by number of letters: little text shares little with any centroid.
MIN_COSINE, FULL_LETTERS = 0.12, 200
QUANTILE, MARGIN, MIN_ROWS, CLASSES = 0.01, 0.9, 100, 64
MIN_SHARE = 0.03
SHARPNESS = 25.0
UND = "und"


@functools.cache
def _letters() -> np.ndarray:
    return np.frombuffer(bytes(map(str.isalpha, map(chr, range(sys.maxunicode + 1)))), np.bool_)


def counts(text: str) -> tuple[np.ndarray, int]:
    """Counts of the hashed n-grams of a whole text, and its letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    is_letter = _letters()[points]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # one blank behind each run of letters
    a = np.concatenate([[np.uint32(32)], np.where(is_letter, points, 32)[keep]]).astype(np.uint32)
    out, shift = np.zeros(DIM, np.int64), np.uint32(32 - DIM.bit_length() + 1)
    h = np.zeros(len(a), np.uint32)
    for n in range(3):
        h = (h[: len(a) - n] * np.uint32(0x01000193) + a[n:] + np.uint32(n)) if n else a
        out += np.bincount((h * np.uint32(0x9E3779B1)) >> shift, minlength=DIM)
    return out, int(is_letter.sum())


def length_class(letters: int) -> int:
    return min(CLASSES - 1, int(2 * np.log2(max(1, letters))))


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # languages * CENTROIDS x DIM, normalised
    owner: np.ndarray
    floors: np.ndarray | None = None  # languages x CLASSES

    def vector(self, found: np.ndarray) -> np.ndarray:
        v = np.log1p(found) * self.idf
        return v / (np.linalg.norm(v) or 1.0)

    def cosines(self, found: np.ndarray) -> np.ndarray:
        """Of each language, the cosine of its nearest centroid."""
        best = np.full(len(self.languages), -1.0)
        np.maximum.at(best, self.owner, self.centroids @ self.vector(found).astype(np.float32))
        return best

    def nearest(self, found: np.ndarray) -> tuple[str, float]:
        best = self.cosines(found)
        return self.languages[int(best.argmax())], float(best.max())

    def predict(self, text: str | None) -> tuple[str, float, float, bool]:
        """Language, score, cosine, rejected."""
        found, letters = counts(text or "")
        if not letters or not self.languages:
            return UND, 0.0, 0.0, True
        best = self.cosines(found)
        i = int(best.argmax())
        share = np.exp(SHARPNESS * (best - best[i]))
        floor = MIN_COSINE * min(1.0, letters / FULL_LETTERS)
        if self.floors is not None:
            floor = max(floor, self.floors[i, length_class(letters)])
        return self.languages[i], float(1 / share.sum()), float(best[i]), bool(best[i] < floor)


def _frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each place occurs, and the number of texts; each task sends one row for each place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(DIM + 1, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held[:DIM] += counts(text)[0] > 0
                held[DIM] += 1
        yield pa.RecordBatch.from_arrays([pa.array(range(DIM + 1), pa.int32()), pa.array(held)], names=["place", "n"])

    total = np.zeros(DIM + 1)
    for r in texts.mapInArrow(run, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect():
        total[r["place"]] = r["n"]
    return total[:DIM], int(total[DIM])


def cluster(vectors: np.ndarray, k: int = CENTROIDS) -> np.ndarray:
    """Spherical k-means; seeds are drawn by squared distance from those before, empty and very small clusters go."""
    rng, seeds = np.random.default_rng(0), [int((vectors @ vectors.mean(0)).argmax())]
    while len(seeds) < min(k, len(vectors)):
        far = np.maximum(0.0, 1 - (vectors @ vectors[seeds].T).max(1).astype(np.float64)) ** 2
        far[seeds] = 0
        if not far.any():
            break
        seeds.append(int(rng.choice(len(vectors), p=far / far.sum())))
    centres = vectors[seeds]
    for _ in range(ROUNDS):
        near = (vectors @ centres.T).argmax(1)
        sums = np.stack([vectors[near == i].sum(0) for i in range(len(centres)) if (near == i).any()])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    sizes = np.bincount((vectors @ centres.T).argmax(1), minlength=len(centres))
    return centres[sizes >= min(MIN_SHARE * len(vectors), sizes.max())]


def _merged(found: dict[int, tuple[int, float]]) -> np.ndarray | None:
    """The floor of every length class from (rows, cosine) of some, or null if these have too few rows in all."""
    if sum(n for n, _ in found.values()) < MIN_ROWS:
        return None
    out = np.empty(CLASSES)
    for c in range(CLASSES):
        rows, least = 0, 1.0
        for x in sorted(found, key=lambda x: (abs(x - c), x)):
            rows, least = rows + found[x][0], min(least, found[x][1] * 2 ** (min(0, c - x) / 4))
            if rows >= MIN_ROWS:
                break
        out[c] = MARGIN * least
    return out


def _floors(rows: DataFrame, model: Model) -> np.ndarray:
    """Least cosines by language and length class, from all training rows that are named as they are labelled."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = []
            for text, lang in zip(*(c.to_pylist() for c in batch.columns)):
                found, letters = counts(text)
                if letters and (p := shared.value.nearest(found))[0] == lang:
                    own.append((lang, length_class(letters), p[1]))
            lang, at, cosine = zip(*own) if own else ([],) * 3
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(at, pa.int32()), pa.array(cosine, pa.float64())], names=["lang", "at", "cosine"])

    own = rows.select("text", "lang").mapInArrow(run, "lang string, at int, cosine double")
    own = own.groupBy("lang", "at").agg(F.count("*").alias("n"), F.percentile_approx("cosine", QUANTILE, 5_000).alias("q")).collect()
    by_language, whole = {}, {}
    for r in own:
        by_language.setdefault(r["lang"], {})[r["at"]] = (r["n"], r["q"])
        n, q = whole.get(r["at"], (0, 1.0))
        whole[r["at"]] = (n + r["n"], min(q, r["q"]))
    whole = _merged(whole)
    none = np.zeros(CLASSES) if whole is None else whole
    floors = [_merged(by_language.get(lang, {})) for lang in model.languages]
    return np.stack([none if f is None else f for f in floors])


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_languages: int = MAX_LANGUAGES) -> Model:
    """Learns from all rows of ``docs`` with a language and a text; ``max_languages`` bounds the model, 64 kB for each."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(max_languages + 1).collect()}
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages: a model of more must be asked for by max_languages")
    df, n = _frequencies(rows.select("text"))
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    if not sizes:
        return Model([], idf, np.zeros((0, DIM), np.float32), np.zeros(0, np.int64))
    each = max(8, min(SAMPLE, MAX_SAMPLE // len(sizes)))
    rows = rows.withColumn("h", F.xxhash64(F.lit("langid"), "id", "text"))
    # of each language the rows of the least hashes, ranked among the few below a threshold
    ids = materialise(rows.select("lang", "h").distinct(), "language-rows")
    held = {r["lang"]: r["n"] for r in ids.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    share = F.create_map(*[F.lit(x) for lang, n in held.items() for x in (lang, min(1.0, 4 * each / n))])[F.col("lang")]
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    few = ids.where(F.col("h") / 2.0**64 + 0.5 < share).withColumn("place", place).where(F.col("place") <= each)
    chosen = materialise(few.select("lang", "h"), "languages")
    discard(ids)
    drawn = rows.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text")).select("text", "lang")
    base = Model([], idf, np.zeros((0, DIM), np.float32), np.zeros(0, np.int64))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [base.vector(counts(t)[0]).astype(np.float32).tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(raw, pa.binary()), batch.column(1)], names=["v", "lang"])

    def centres(own: pa.Table) -> pa.Table:
        """The centroids of one language from at most ``each`` vectors."""
        rows = [x.tobytes() for x in cluster(np.stack([np.frombuffer(v, np.float32) for v in sorted(own.column("v").to_pylist())]))]
        return pa.table({"lang": own.column("lang").slice(0, 1).to_pylist() * len(rows), "k": pa.array(range(len(rows)), pa.int32()), "v": pa.array(rows, pa.binary())})

    # only centroids reach the driver
    found = drawn.mapInArrow(vectors, "v binary, lang string").groupBy("lang").applyInArrow(centres, "lang string, k int, v binary").collect()
    found = sorted((r["lang"], r["k"], np.frombuffer(bytes(r["v"]), np.float32)) for r in found)
    discard(chosen)
    if not found:
        return base
    languages = sorted({lang for lang, _, _ in found})
    model = Model(languages, idf, np.stack([v for _, _, v in found]), np.asarray([languages.index(lang) for lang, _, _ in found]))
    return replace(model, floors=_floors(rows, model))


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, cosine and rejected of every text, from the text alone."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, cosine, rejected = zip(*map(shared.value.predict, batch.column(1).to_pylist())) if len(batch) else ([],) * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(cosine, pa.float64()), pa.array(rejected, pa.bool_())], names=["doc_id", "lang_pred", "score", "cosine", "rejected"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double, cosine double, rejected boolean")


def keep(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that are not rejected."""
    small_batches(docs.sparkSession)
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([not shared.value.predict(t)[3] for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def query(docs: DataFrame, folds: int = 4, out: int = 2) -> DataFrame:
    held = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds) == out
    return predict(docs, fit(docs.where(~held))).select("doc_id", held.alias("held_out"), "lang_pred", "score", "cosine", "rejected")
