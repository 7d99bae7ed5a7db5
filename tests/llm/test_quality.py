"""The positive-unlabelled quality classifier: held-out rows, odd rows, measures and the risk's descent beside plain ones."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from compare import DATA
from pyspark.sql import functions as F
from sluice.llm import quality, queries, toxicity


def good(rng):
    return "\n".join(" ".join("".join(rng.choices("abcdefghilmnorst", k=rng.randint(2, 8))) for _ in range(rng.randint(6, 14))).capitalize() + "." for _ in range(rng.randint(2, 9)))


def bad(rng, kind):
    text = good(rng)
    return text.upper().replace(" ", "!! ") if kind == 0 else text.replace(" ", " ### ") if kind == 1 else "\n".join(["buy now " * 4] * 30)


def test_learns_from_positives_and_unlabelled(spark):
    rng = random.Random(5)
    rows = [(i, bad(rng, i % 3) if i % 5 == 0 else good(rng), 1, "x") for i in range(900)]
    odd = [(2000, None, 1, "x"), (2001, "", 1, "x"), (2002, " \n\t", 1, "x"), (2003, "word " * 60_000, 1, "x"), (2004, rows[1][1], 1, "x"), (2004, rows[1][1], 1, "x"), (None, rows[2][1], 1, "x")]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, x int, p string").repartition(3)
    labels = [(i, int(i % 5 != 0)) for i in range(0, 700)] + [(3, None), (None, 1), (6, 1), (6, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    seen = quality.measured(df)
    model = quality.fit(seen.where("doc_id < 700"), labels)
    assert 0.6 < model.prior < 0.95
    got = quality.score(seen, model).toPandas()
    assert len(got) == len(rows) + len(odd) and got.score.between(0, 1).all()
    held = got[(got.doc_id >= 700) & (got.doc_id < 900)]
    assert ((held.score >= 0.3) == (held.doc_id % 5 != 0)).mean() > 0.97
    assert got[got.doc_id == 2004].score.nunique() == 1 and (got[got.doc_id.isin([2000, 2001, 2002])].score < 0.3).all()
    kept = quality.keep(df, model)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} >= {i for i in range(700, 900) if i % 5}
    # without positives, labels or rows
    none = quality.fit(seen, labels.withColumn("quality", F.lit(0)))
    assert {r.score for r in quality.score(seen, none).collect()} == {0.0}
    assert quality.score(seen.limit(0), quality.fit(seen.limit(0), labels.limit(0))).count() == 0


def test_labels_lang_and_source_are_no_inputs(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    base = {r.doc_id: r.score for r in quality.query(docs, labels).collect()}
    flipped = labels.withColumn("quality", F.when(toxicity.fold("doc_id", 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = quality.query(docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit(None).cast("string")), flipped)
    assert {r.doc_id: r.score for r in other.collect()} == base


def test_held_out_rows(spark):
    got = queries.queries()["op11_pu_quality"](spark, "/root/testdata/sf0.01").toPandas()
    labels = pd.read_parquet("/root/testdata/sf0.01/labels.parquet").drop_duplicates("doc_id")
    held = got[got.held_out].merge(labels, on="doc_id")
    assert list(got.columns) == ["doc_id", "held_out", "score", "predicted"] and ((got.score >= 0.3) == (got.predicted == 1)).all()
    best, worst = held[held.quality == 1].score, held[held.quality == 0].score
    assert np.mean([b > w for b in best for w in worst]) > 0.95 and (held.predicted == held.quality).mean() > 0.95


def test_measures_beside_plain_ones():
    text = "Ab cd cd\tEF\n\n x9 # ab cd cd ef x9 #\nab cd\nab cd"
    words, lines = text.lower().split(), [x.strip() for x in text.split("\n") if x.strip()]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    letters = sum(c.isalpha() for c in text)
    want = [math.log1p(len(words)), 3 / letters, 2 / len(text), letters / len(text), sum(map(len, words)) / len(words), len(set(words)) / len(words), 1 - len(set(lines)) / len(lines), math.log1p(len(text) / len(lines)),
            1 - len(set(windows)) / len(windows), 2 / len(words), math.log1p(len(lines)), 2 / len(words), max(map(words.count, words)) / len(words)]
    got = quality.measure(text)
    assert np.allclose(got[:13], want, atol=1e-6)
    assert math.isclose(got[13 + list(quality.SIGNS).index(ord("#"))], math.log1p(1000 * 2 / len(text)), rel_tol=1e-5)
    assert not quality.measure("").any() and not quality.measure(None).any()


@pytest.mark.parametrize("prior", [0.2, 0.8])
def test_descent_beside_numeric_gradients(monkeypatch, prior):
    """Both classifiers' steps follow the non-negative risk, differentiated here by small differences."""
    monkeypatch.setattr(toxicity, "STEPS", 25)
    rng = np.random.default_rng(3)
    positive, unlabelled = (rng.normal(m, 1, (40, 3)).astype(np.float32) for m in (1.0, 0.2))
    w, c = toxicity.descend(positive, unlabelled, prior, 7)
    draw = np.random.default_rng(7)
    part = lambda x: x[np.sort(draw.permutation(len(x))[: len(x) * 4 // 5])].astype(float)
    xp, xu = part(positive), part(unlabelled)
    sigmoid = lambda z: 1 / (1 + np.exp(-z))
    of_positives = lambda v: prior * np.mean(sigmoid(-(xp @ v[:-1] + v[-1])))
    of_negatives = lambda v: np.mean(sigmoid(xu @ v[:-1] + v[-1])) - prior * np.mean(sigmoid(xp @ v[:-1] + v[-1]))
    slope = lambda f, v: np.asarray([(f(v + e) - f(v - e)) / 2e-5 for e in np.eye(len(v)) * 1e-5])
    v = np.append(np.zeros(3), np.log(prior / (1 - prior)))
    m, s = np.zeros(4), np.zeros(4)
    for step in range(1, 26):
        g = slope(lambda u: of_positives(u) + of_negatives(u), v) if of_negatives(v) >= 0 else -slope(of_negatives, v)
        g[:-1] += toxicity.RIDGE * v[:-1]
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g**2
        v -= toxicity.RATE * m / (1 - 0.9**step) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    assert np.allclose(np.append(w, c), v, atol=2e-3)
