"""No language of the training rows is lost, whatever ids its rows have."""

import random

import pytest
from pyspark.sql import functions as F
from sluice.llm import langid


def texts(letters, n, seed):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(12)) for _ in range(n)]


@pytest.mark.parametrize("one_id", [7, 123456789])
def test_a_language_under_one_id(spark, one_id):
    """Most rows share one id, and another language has few rows; both are learnt whatever the hash of the id is."""
    rows = [(one_id, t, "aa") for t in texts("abcde", 4000, 1)] + [(1000 + i, t, "zz") for i, t in enumerate(texts("vwxyz", 80, 2))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = langid.fit(df)
    assert model.languages == ["aa", "zz"]
    fresh = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts("abcde", 30, 3) + texts("vwxyz", 30, 4))], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in langid.predict(fresh, model).orderBy("doc_id").collect()] == ["aa"] * 30 + ["zz"] * 30


def test_one_text_repeated(spark):
    """A language whose rows are all the same row, and one with a single row."""
    rows = [(1, texts("abcde", 1, 1)[0], "aa")] * 300 + [(2, texts("vwxyz", 1, 2)[0], "zz")] + [(10 + i, t, "mm") for i, t in enumerate(texts("klmno", 200, 5))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert model.languages == ["aa", "mm", "zz"]
    got = langid.predict(df, model).groupBy("lang_pred").count().collect()
    assert {r["lang_pred"]: r["count"] for r in got} == {"aa": 300, "zz": 1, "mm": 200}
    assert langid.predict(df.limit(0), model).count() == 0


def test_many_languages_share_the_sample(spark):
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i, t, f"l{k:02}") for k in range(13) for i, t in enumerate(texts(alphabet[2 * k : 2 * k + 2], 40, k))]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("h", F.lit(1)).withColumn("place", F.lit(1)))
    assert len(model.languages) == 13


def test_only_centroids_reach_the_driver(spark, monkeypatch):
    """Vectors are clustered in tasks: what the driver collects does not grow with the sample."""
    rows = [(i, t, lang) for lang, letters in (("aa", "abcde"), ("zz", "vwxyz")) for i, t in enumerate(texts(letters, 100, 6))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen, collect = [], type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: seen.append(collect(self)) or seen[-1])
    assert langid.fit(df).languages == ["aa", "zz"]
    held = sum(len(x) for found in seen for r in found for x in r if isinstance(x, (bytes, bytearray)))
    assert 0 < held <= 2 * langid.CENTROIDS * langid.DIM * 4
