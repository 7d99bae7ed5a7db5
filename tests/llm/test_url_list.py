"""A large table of listed URLs goes through the filter and the exact join of the query."""

from pyspark.sql import functions as F

from sluice.llm import urlfilter


def test_listed_table(spark):
    n = 40_000
    host = F.concat(F.lit("bad"), "id", F.lit(".example.net"))
    listed = spark.range(n).select(host.alias("host"), F.when(F.col("id") % 2 == 0, "/").otherwise("/x/").alias("path"), F.lit("block").alias("verdict"))
    pages = spark.range(0, 2 * n, 7).select(F.col("id").alias("page_id"), F.concat(F.lit("http://www."), host, F.lit("/x/p?q")).alias("url"))
    pages = pages.union(spark.createDataFrame([(-1, "http://bad1.example.net/y"), (-2, "http://spam-farm.example.net/"), (-3, "http://bad2.example.net/"), (-4, "http://a.org/")], pages.schema))
    got = {r.page_id: (r.rule, r.verdict, r.listed) for r in urlfilter.query(pages, listed).collect()}
    assert len(got) == pages.count()
    for i in range(0, 2 * n, 7):
        assert got[i] == ((None, "block", f"bad{i}.example.net/" + ("" if i % 2 == 0 else "x/")) if i < n else (None, "allow", None))
    assert got[-1] == got[-2] == (None, "allow", None)
    assert got[-3] == (None, "block", "bad2.example.net/") and got[-4] == ("org/", "allow", None)
