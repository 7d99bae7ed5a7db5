"""Numbers, fills and as-of joins over sorted ranges, beside plain loops; hot keys, ties, nulls and several partition counts."""

import bisect
import random

import pytest
from pyspark.sql import functions as F

from sluice.operators import ranges


@pytest.fixture
def partitions(spark, request):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize("partitions", [3, 8, 64], indirect=True)
def test_numbers_lose_no_row(spark, partitions):
    n = 1_000_000 if partitions == 8 else 300_000
    df = spark.range(0, n, 1, 7).select((F.col("id") * 7919 % 1000).alias("k"), "id", F.sha2(F.col("id").cast("string"), 512).alias("payload"))
    out = ranges.with_surrogate(df, ["k", "id"], "number")
    # in order of (k, id) the number of a row follows from both
    found = out.agg(F.count("*").alias("n"), F.count_distinct("number").alias("d"), F.min("number").alias("a"), F.max("number").alias("b"), F.count_if(F.col("payload") != F.sha2(F.col("id").cast("string"), 512)).alias("bad")).first()
    assert tuple(found) == (n, n, 1, n, 0)
    from pyspark.sql import Window

    beside = Window.partitionBy("k").orderBy("number")
    wrong = out.where("k < 20").withColumn("before", F.lag("id").over(beside)).withColumn("step", F.col("number") - F.lag("number").over(beside)).where("before >= id or step <> 1")
    assert wrong.isEmpty()


@pytest.mark.parametrize("partitions", [3, 16], indirect=True)
def test_numbers_of_equal_rows(spark, partitions):
    same = spark.range(5000).select(F.lit("x").alias("k"), F.lit(None).cast("string").alias("v"))
    out = ranges.with_surrogate(same.repartition(4), ["k", "v"], "n")
    assert sorted(r.n for r in out.collect()) == list(range(1, 5001))
    assert ranges.with_surrogate(same.limit(0), ["k"], "n").count() == 0


@pytest.mark.parametrize("partitions", [2, 9], indirect=True)
def test_scan_both_ways(spark, partitions):
    rng = random.Random(partitions)
    # one key has most rows, with long gaps, others a few; a null key is one as well
    rows = [("hot", i, i if rng.random() < 0.01 else None) for i in range(1500)] + [(rng.choice(["a", "b", "c", None]), i, rng.choice([i, None, None])) for i in range(2000, 2200)]
    df = spark.createDataFrame(rows, "k string, t int, v int").repartition(5)
    got = {r.t: (r.b, r.a, r.v) for r in ranges.scan(df, ["k"], ["t"], before={"b": "v"}, after={"a": "v"}).collect()}
    for k in {r[0] for r in rows}:
        own = sorted((t, v) for key, t, v in rows if key == k)
        last = None
        for t, v in own:
            last = v if v is not None else last
            assert got[t][0] == last and got[t][2] == v
        first = None
        for t, v in reversed(own):
            first = v if v is not None else first
            assert got[t][1] == first
    filled = ranges.forward_fill(df, ["v"], ["k"], ["t"])
    assert filled.columns == df.columns and {r.t: r.v for r in filled.collect()} == {t: x[0] for t, x in got.items()}
    assert ranges.forward_fill(df.limit(0), ["v"], ["k"], ["t"]).count() == 0
    whole = ranges.scan(df.where("k = 'hot'"), [], ["t"], before={"b": "v"})
    assert {r.t: r.b for r in whole.collect()} == {t: got[t][0] for k, t, _ in rows if k == "hot"}


@pytest.mark.parametrize("partitions", [2, 11], indirect=True)
def test_neighbours(spark, partitions):
    rng = random.Random(partitions)
    rows = [(rng.choice("aab"), rng.randrange(0, 500, 5), rng.randint(0, 9)) for _ in range(400)] + [("a", None, 1), (None, 3, 1)]
    points = [(rng.choice("aaabz"), rng.randrange(-10, 520)) for _ in range(900)] + [("a", None), (None, 5)]
    left = spark.createDataFrame(points, "k string, t int")
    right = spark.createDataFrame(rows, "k string, t int, v int")
    got = {(r.k, r.t): (tuple(r.before) if r.before else None, tuple(r.after) if r.after else None) for r in ranges.neighbours(left, right, ["k"], "t", ["v"], [-F.col("v")]).collect()}
    assert set(got) == {p for p in points if None not in p}
    for (k, t), (before, after) in got.items():
        best = {}
        for key, u, v in rows:
            if key == k and u is not None:
                best[u] = max(v, best.get(u, -1))
        times = sorted(best)
        i, j = bisect.bisect_right(times, t) - 1, bisect.bisect_left(times, t)
        assert before == ((times[i], best[times[i]]) if i >= 0 else None)
        assert after == ((times[j], best[times[j]]) if j < len(times) else None)
