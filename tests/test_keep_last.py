"""Keep-last as an aggregate joined back: a key that all rows share, null keys and orders, rows that were removed before."""

import pytest
from pyspark.sql import functions as F

from sluice.operators import lineage


@pytest.mark.parametrize("last", [True, False])
def test_one_key_in_all_rows(spark, last):
    df = lineage.start_tags(spark.range(0, 20_000, 1, 6).select(F.lit("hot").alias("k"), F.col("id").alias("seq"), F.repeat(F.lit("p"), 40).alias("payload")))
    out = lineage.remove_earlier(df, ["k"], [F.col("seq")], "earlier", last=last)
    assert out.columns == df.columns
    assert [r.seq for r in out.where(lineage.live()).collect()] == [19_999 if last else 0]
    assert out.where(F.array_contains(lineage.REASONS, "earlier")).count() == 19_999


@pytest.mark.parametrize(("last", "want"), [(True, {("a", 3), ("b", 2), (None, 1), (None, 2), ("n", 5)}), (False, {("a", 1), ("b", 2), (None, 1), (None, 2), ("n", 5)})])
def test_nulls_and_removed_rows(spark, last, want):
    rows = [("a", 1, True), ("a", 3, True), ("a", 9, False), ("b", 2, True), (None, 1, True), (None, 2, True), ("n", None, True), ("n", 5, True)]
    df = lineage.start_tags(spark.createDataFrame(rows, "k string, seq int, ok boolean"))
    out = lineage.remove_earlier(lineage.remove_unless(df, F.col("ok"), "bad"), ["k"], [F.col("seq")], "earlier", last=last)
    assert {(r.k, r.seq) for r in out.where(lineage.live()).collect()} == want
    assert {tuple(r[lineage.REASONS]) for r in out.where("seq = 9").collect()} == {("bad",)}
    tied = lineage.start_tags(spark.createDataFrame([("a", 1), ("a", 1), ("a", 1)], "k string, seq int"))
    assert lineage.remove_earlier(tied, ["k"], [F.col("seq")], "earlier", last=last).where(lineage.live()).count() == 1


def test_generated_code_of_all_processors_compiles(spark):
    """A plan whose code is too large falls back to interpretation with a message; none of the processors' does."""
    from sluice.plans import processors

    own = lambda r: sorted({c for c in (*r.doubles, *r.longs, *r.moments, *r.regions, *(r.review or ()), *(r.box or ()), *(x for p in r.pairs for x in p))})
    spark.conf.set("spark.sql.codegen.fallback", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "CODEGEN_ONLY")
    try:
        for name, rules in processors.CULTURE.items():
            raw = spark.range(3).select(F.col("id").alias("_ingest_seq"), *[F.col("id").cast("string").alias(c) for c in own(rules)])
            assert processors.process(f"culture_{name}", raw, allow_empty=True, drop_empty_columns=False).count() >= 0
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
        spark.conf.unset("spark.sql.codegen.factoryMode")
