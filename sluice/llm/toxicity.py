"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; any training text is unlabelled. The class prior is the toxic share of the
labelled training rows, or what the scores of a first fit allow if that is less, as labels may be drawn otherwise
than the texts: no more of the unlabelled texts can be toxic than lie above a threshold, for the share of positives
that lie there. Linear classifiers over word presence minimise pi * R_p(+) + max(0, R_u(-) - pi * R_p(-)) with the
sigmoid loss, which is bounded: where the second term is negative the step goes the other way, as the method says, so
the flexible part of the model cannot drive the estimated risk of the negatives below zero. Several classifiers, fitted
on different parts of the sample, are averaged.

The words of the classifier are the ``MAX_TERMS`` whose shares among all positives and among all training texts differ most;
these counts cover every row. The gradient steps use bounded samples in order of a hash of the id: at most
``MAX_POSITIVE`` positives and ``MAX_UNLABELLED`` unlabelled texts, one text of an id (that of least hash). Null and empty texts
are scored by the words they lack. Without any positive every score is 0. Repeated label rows count as one, toxic if
any says so. Columns besides id, text and label are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import materialise, small_batches
from sluice.llm.urlfilter import passing

MAX_POSITIVE, MAX_UNLABELLED, MAX_TERMS = 4_000, 12_000, 400
CLASSIFIERS, STEPS, RATE, RIDGE = 3, 400, 0.05, 1e-4
#: Standard errors by which a word's share must differ between the samples; far beyond chance over all words.
MIN_STRENGTH = 5.0
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    terms: dict[str, int]
    weights: np.ndarray  # classifiers x terms
    bias: np.ndarray

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Mean probability of the classifiers for whole texts."""
        if not len(self.bias):
            return np.zeros(len(texts))
        known, out = self.terms.keys(), np.empty(len(texts))
        for i, text in enumerate(texts):
            found = [self.terms[w] for w in known & set(_WORD.findall((text or "").lower()))]
            out[i] = (1 / (1 + np.exp(-(self.weights[:, found].sum(1) + self.bias)))).mean()
        return out


def _some(ids: DataFrame, bound: int) -> DataFrame:
    """At most ``bound`` distinct ids, those of the smallest hashes; a threshold on the hash leaves little to order."""
    ids = ids.distinct()
    total = ids.count()
    ids = ids.withColumn("_h", F.xxhash64(F.lit("toxicity"), "doc_id"))
    if total > 2 * bound:
        ids = ids.where(F.col("_h") < -(2**63) + int(2**64 * 1.5 * bound / total))
    return ids.orderBy("_h", "doc_id").limit(bound).select("doc_id")


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fits on ``docs`` and ``labels``, which are training rows only."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    marks = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y is not null").groupBy("doc_id").agg(F.max("y").alias("y"))
    prior = marks.agg(F.avg("y")).first()[0] or 0.0
    positive = _some(marks.where("y = 1").select("doc_id"), MAX_POSITIVE).withColumn("p", F.lit(True))
    unlabelled = _some(docs.select("doc_id"), MAX_UNLABELLED).withColumn("p", F.lit(False))
    chosen = materialise(positive.unionByName(unlabelled), "toxicity-ids")  # at most MAX_POSITIVE + MAX_UNLABELLED rows

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(_WORD.findall((t or "").lower()))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], names=["p", "words"])

    # one text of each chosen id, whatever the number of its rows
    bags = docs.join(F.broadcast(chosen), "doc_id").groupBy("p", "doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    bags = materialise(bags.select("p", "text").mapInArrow(words, "p boolean, words array<string>"), "toxicity-words")
    sizes = {r["p"]: r["n"] for r in bags.groupBy("p").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(True) or not sizes.get(False) or not 0 < prior < 1:
        return Model({}, np.zeros((0, 0)), np.zeros(0))
    seen = materialise(_word_counts(docs, marks), "toxicity-counts")
    n_p, n_u = seen.where("w is null").select("a", "b").first()
    seen = seen.where("w is not null and a + b > 4")
    a, b = F.col("a") / n_p, F.col("b") / n_u
    # the words whose shares differ most for their spread
    strength = F.abs(a - b) / F.sqrt((F.col("a") + F.col("b") + 1) / (n_p + n_u) * (1 / n_p + 1 / n_u))
    terms = [r["w"] for r in seen.where(strength >= MIN_STRENGTH).orderBy(strength.desc(), "w").limit(MAX_TERMS).collect()]
    at = {w: i for i, w in enumerate(terms)}
    rows = bags.select("p", F.array_intersect("words", F.array(*map(F.lit, terms)) if terms else F.array().cast("array<string>")).alias("w")).collect()
    x, p = np.zeros((len(rows), len(terms)), np.float32), np.asarray([r["p"] for r in rows])
    for i, r in enumerate(rows):
        x[i, [at[w] for w in r["w"]]] = 1
    w, c = descend(x[p], x[~p], prior, CLASSIFIERS)
    prior = possible_prior(x[p] @ w + c, x[~p] @ w + c, prior)
    fits = [descend(x[p], x[~p], prior, seed) for seed in range(CLASSIFIERS)]
    return Model(at, np.stack([w for w, _ in fits]), np.asarray([c for _, c in fits]))


def _word_counts(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """In how many texts of positives (a) and of all rows (b) each word w occurs; the null word stands for all texts.

    Texts of all rows are counted where they are read. Of the positives only the texts that a bounded filter of their ids
    passes are exchanged.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Counter()
            for text in batch.column(0).to_pylist():
                found.update(set(_WORD.findall((text or "").lower())))
            yield pa.RecordBatch.from_arrays([pa.array([None, *found], pa.string()), pa.array([batch.num_rows, *found.values()], pa.int64())], names=["w", "n"])

    positive = materialise(marks.where("y = 1").select("doc_id"), "toxicity-positives")
    likely = passing(docs.withColumn("key", F.xxhash64("doc_id")), positive.select(F.xxhash64("doc_id").alias("key")), positive.count())
    of = lambda df: df.select("text").mapInArrow(count, "w string, n long")
    zero = F.lit(0).cast("long")
    toxic = of(likely.join(positive, "doc_id")).select("w", F.col("n").alias("a"), zero.alias("b"))
    every = of(docs).select("w", zero.alias("a"), F.col("n").alias("b"))
    return toxic.unionByName(every).groupBy("w").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def possible_prior(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> float:
    """``prior``, or less if the scores rule it out: the least share above a threshold of the unlabelled scores, with a
    standard error, over that of the positive ones. Thresholds have a tenth of the positives above them at least."""
    at = np.quantile(positive, np.linspace(0, 0.9, 19))
    above = lambda x: (x[:, None] >= at).mean(0)
    share = above(unlabelled)
    return float(min(prior, ((share + np.sqrt(share * (1 - share) / len(unlabelled)) + 1 / len(unlabelled)) / above(positive)).min()))


def descend(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int) -> tuple[np.ndarray, float]:
    """Weights and bias of one classifier with the sigmoid loss, by Adam on its own four fifths of the rows."""
    rng = np.random.default_rng(seed)
    part = lambda x: x[np.sort(rng.permutation(len(x))[: max(1, len(x) * 4 // 5)])]
    xp, xu = part(positive), part(unlabelled)
    w = np.zeros(positive.shape[1] + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    ends = lambda x, g: np.append(x.T @ g.astype(np.float32), g.sum()) / len(x)
    for step in range(1, STEPS + 1):
        sp, su = (sigmoid(x @ w[:-1].astype(np.float32) + w[-1]) for x in (xp, xu))
        towards_p, towards_u = ends(xp, sp * (1 - sp)), ends(xu, su * (1 - su))
        of_negatives = towards_u - prior * towards_p
        gradient = of_negatives - prior * towards_p if su.mean() >= prior * sp.mean() else -of_negatives
        gradient[:-1] += RIDGE * w[:-1]
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        w -= RATE * m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every text; the model is of bounded size and travels as a broadcast variable."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.scores(batch.column(1).to_pylist()))], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")


def keep(docs: DataFrame, model: Model, threshold: float = 0.5, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text scores below ``threshold``."""
    small_batches(docs.sparkSession)
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.scores(batch.column(at).to_pylist()) < threshold))

    return docs.mapInArrow(run, docs.schema)


def fold(id_col: str, n: int):
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def query(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    model = fit(docs.where(fold("doc_id", folds) != 0), labels.where(fold("doc_id", folds) != 0))
    return score(docs, model).select("doc_id", (fold("doc_id", folds) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
