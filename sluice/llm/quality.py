"""Text quality by positive-unlabelled learning.

Trusted good texts are the positives; any training text is unlabelled. Linear classifiers over measures of a whole text
(``measure``: shares of letters, cases, digits and of each ASCII sign, lengths of words and lines, repeated words, lines and
five-word windows) minimise the unbiased risk pi * R_p(+) + max(0, R_u(-) - pi * R_p(-)), kept non-negative as in
``toxicity.descend``; several, fitted on different parts of the sample, are averaged. Labels of bad texts are used for one
thing only: the share of good ones among the labels begins the estimate of the class prior pi. It is lowered to what the
scores of a first fit allow: no more of the unlabelled texts can be good than lie above a threshold, for the share of
positives that lie there. That share counts all training rows, as the means and spreads of the measures do. Only the gradient
steps use bounded samples in order of a hash of the id: at most ``MAX_POSITIVE`` positives and ``MAX_UNLABELLED`` unlabelled
texts, one text of an id (that of least hash).

Texts are read once; what follows reads the table of measures, some 200 bytes a row. Null and empty texts have all
measures zero. Without any positive every score is 0. Repeated label rows count as one, good if all say so; null labels and
null ids are left out, and rows with a null id are scored. Repeated rows are scored each. An empty table gives no rows.
Columns besides id, text and label are not read.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import discard, materialise, small_batches
from sluice.llm.jaccard import word_hashes
from sluice.llm.toxicity import CLASSIFIERS, _some, descend, fold

MAX_POSITIVE, MAX_UNLABELLED = 6_000, 12_000
THRESHOLD, WINDOW = 0.3, 5
#: Measures lie within so many spreads of the mean.
FAR = 5.0
SIGNS = np.asarray([c for c in range(33, 127) if not chr(c).isalnum()])
N_MEASURES = 13 + len(SIGNS)


@functools.cache
def _kinds() -> np.ndarray:
    """Of every code point: 1 capital letter, 2 other letter, 3 digit, 0 else."""
    return np.frombuffer(bytes(1 if c.isupper() else 2 if c.isalpha() else 3 if c.isdigit() else 0 for c in map(chr, range(sys.maxunicode + 1))), np.uint8)


def _repeats(keys: np.ndarray) -> tuple[int, int]:
    """Distinct keys, and how often the commonest occurs."""
    if not len(keys):
        return 0, 0
    _, n = np.unique(keys, return_counts=True)
    return len(n), int(n.max())


def measure(text: str | None) -> np.ndarray:
    """The measures of a whole text."""
    out = np.zeros(N_MEASURES, np.float32)
    if not text:
        return out
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    kinds = _kinds()[points]
    capital, other, digits = (np.count_nonzero(kinds == k) for k in (1, 2, 3))
    letters, size = capital + other, len(points)
    blank = (points == 32) | ((points >= 9) & (points <= 13))
    begins = np.flatnonzero(~blank & np.append(True, blank[:-1]))
    words = word_hashes(text.encode("utf-8", "replace").lower())
    n = max(1, len(words))
    lines = [x for line in text.split("\n") if (x := line.strip())]
    with np.errstate(over="ignore"):
        windows = np.zeros(max(0, len(words) - WINDOW + 1), np.uint64)
        for i in range(WINDOW):
            windows = windows * np.uint64(0x9E3779B97F4A7C15) + words[i : i + len(windows)]
    distinct, most = _repeats(words)
    with_letter = np.add.reduceat((kinds == 1) | (kinds == 2), begins).astype(bool).sum() if len(begins) else 0
    out[:13] = (
        np.log1p(len(words)), capital / max(1, letters), digits / size, letters / size, (size - blank.sum()) / n, distinct / n, 1 - len(set(lines)) / max(1, len(lines)),
        np.log1p(size / max(1, len(lines))), 1 - _repeats(windows)[0] / max(1, len(windows)), 1 - with_letter / n, np.log1p(len(lines)), np.count_nonzero(kinds[begins] == 1) / n, most / n,
    )
    out[13:] = np.log1p(1000 * np.bincount(points[points < 128], minlength=128)[SIGNS] / size)
    return out


def measured(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, a hash of the text and its measures as float32, for every row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = pa.array([measure(t).tobytes() for t in batch.column(2).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), raw], names=["doc_id", "text_hash", "x"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, x binary")


def matrix(raw) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, raw)), np.float32).reshape(-1, N_MEASURES)


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray  # classifiers x measures
    bias: np.ndarray
    prior: float = 0.0

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -FAR, FAR).astype(np.float32)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Mean probability of the classifiers."""
        if not len(self.bias):
            return np.zeros(len(x))
        return (1 / (1 + np.exp(-np.clip(self.scaled(x) @ self.weights.T + self.bias, -40, 40)))).mean(1)


def _summed(seen: DataFrame, of, width: int) -> np.ndarray:
    """``of(matrix)``, ``width`` numbers of each batch, added up over all rows; each task sends one row of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                held += of(matrix(batch.column(0).to_pylist()))
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(held)], names=["place", "v"])

    out = np.zeros(width)
    for r in seen.select("x").mapInArrow(run, "place int, v double").groupBy("place").agg(F.sum("v").alias("v")).collect():
        out[r["place"]] = r["v"]
    return out


def _moments(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])


def fit(seen: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", label_col: str = "quality") -> Model:
    """Fits on ``seen`` (of ``measured``) and ``labels``, which are training rows only."""
    marks = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y is not null").groupBy("doc_id").agg(F.min("y").alias("y"))
    share = marks.agg(F.avg("y")).first()[0]
    sums = _summed(seen, _moments, 2 * N_MEASURES + 1)
    n = max(1.0, sums[0])
    mean, square = sums[1 : N_MEASURES + 1] / n, sums[N_MEASURES + 1 :] / n
    spread = np.sqrt(np.maximum(0, square - mean**2))
    spread[spread < 1e-6] = 1.0
    none = Model(mean, spread, np.zeros((0, N_MEASURES)), np.zeros(0))
    ids = seen.select("doc_id").where("doc_id is not null")
    positive = _some(marks.where("y = 1").select("doc_id"), MAX_POSITIVE).withColumn("p", F.lit(True))
    chosen = materialise(positive.unionByName(_some(ids, MAX_UNLABELLED).withColumn("p", F.lit(False))), "quality-ids")  # a bounded number of rows
    rows = seen.join(F.broadcast(chosen), "doc_id").groupBy("p", "doc_id").agg(F.min_by("x", "text_hash").alias("x")).orderBy("p", "doc_id").collect()
    discard(chosen)
    good, any_ = ([r["x"] for r in rows if r["p"] is p] for p in (True, False))
    if not good or not any_:
        return none
    good, any_ = none.scaled(matrix(good)), none.scaled(matrix(any_))
    prior = float(np.clip(share, 0.05, 0.95))
    w, c = descend(good, any_, prior, CLASSIFIERS)
    first = Model(mean, spread, w[None], np.asarray([c]))
    own = good @ w + c
    at = np.quantile(own, np.linspace(0, 0.9, 19))
    above = _summed(seen, lambda x: np.append((first.scaled(x) @ w[:, None] + c >= at).sum(0), len(x)), len(at) + 1)
    part = above[:-1] / above[-1]
    # with a standard error of the share, for small tables
    possible = (part + np.sqrt(part * (1 - part) / above[-1]) + 1 / above[-1]) / (own[:, None] >= at).mean(0)
    prior = float(np.clip(min(prior, possible.min()), 0.05, 0.95))
    fits = [descend(good, any_, prior, seed) for seed in range(CLASSIFIERS)]
    return Model(mean, spread, np.stack([w for w, _ in fits]), np.asarray([c for _, c in fits]), prior)


def score(seen: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every measured row; the model has a few hundred numbers."""
    shared = seen.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.scores(matrix(batch.column(1).to_pylist())))], names=["doc_id", "score"])

    return seen.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")


def keep(docs: DataFrame, model: Model, threshold: float = THRESHOLD, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text scores ``threshold`` or more."""
    small_batches(docs.sparkSession)
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([measure(t) for t in batch.column(at).to_pylist()]) if batch.num_rows else np.zeros((0, N_MEASURES), np.float32)
            yield batch.filter(pa.array(shared.value.scores(x) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def query(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    seen = materialise(measured(docs), "measures")
    training = F.coalesce(fold("doc_id", folds) != 0, F.lit(False))
    model = fit(seen.where(training), labels.where(training))
    return score(seen, model).select("doc_id", (fold("doc_id", folds) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
