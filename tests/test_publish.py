"""Publication, upserts and streams."""

import pytest
from pyspark.sql import functions as F

from sluice.plans.publish import Warehouse, merge, prepare_batch, record_run
from sluice.streaming.upsert import insert_only, upsert_stream, windowed_counts

OBS = "k string, t string, v long, seq long"


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "w"))


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_group_is_all_or_nothing(spark, warehouse):
    a = spark.createDataFrame([("x", 1)], "k string, v int")
    warehouse.replace("d", {"one": a, "two": a})
    with pytest.raises(ValueError, match="duplicate"):
        warehouse.replace("d", {"one": a.withColumn("v", F.lit(2)), "two": a.union(a)}, primary_keys={"two": ["k"]})
    assert rows(warehouse.read("d", "one")) == [("x", 1)] and rows(warehouse.read("d", "two")) == [("x", 1)]
    with pytest.raises(ValueError, match="empty"):
        warehouse.replace("d", {"one": a.limit(0)})
    with pytest.raises(ValueError, match="bad table"):
        warehouse.replace("d", {"One": a})
    assert warehouse.replace("d", {"one": a.limit(0)}, allow_empty=["one"]) == {"one": 0}
    assert set(warehouse.snapshot([("d", "one"), ("d", "two"), ("d", "no")])) == {"one", "two"}


def test_replay_and_correction(spark, warehouse):
    batch = lambda *r: spark.createDataFrame([(k, t, v, i) for i, (k, t, v) in enumerate(r)], OBS)
    load = lambda df: warehouse.upsert("obs", {"t": df}, {"t": ["k", "t"]}, order="seq")
    load(batch(("s", "09", 10)))
    load(batch(("s", "10", 20)))
    load(batch(("s", "10", 20), ("s", "10", 20)))
    load(batch(("s", "10", 20), ("s", "10", 99)))
    assert [(r[1], r[2]) for r in rows(warehouse.read("obs", "t"))] == [("09", 10), ("10", 99)]


def test_null_clearing_and_new_columns(spark):
    a = spark.createDataFrame([("x", 1)], "k string, v int")
    b = spark.createDataFrame([("x", 2, "e")], "k string, v int, extra string")
    c = merge(merge(a, b, ["k"]), a, ["k"])
    assert [r.asDict() for r in c.collect()] == [{"k": "x", "v": 1, "extra": None}]
    assert merge(b, a, ["k"], keep_absent=True).first().extra == "e"
    widened = merge(a, spark.createDataFrame([("y", "강수없음")], "k string, v string"), ["k"])
    assert rows(widened) == [("x", "1"), ("y", "강수없음")]


def test_batches_are_checked(spark):
    df = spark.createDataFrame([(None, 1)], "k string, v int")
    for bad, key in ((df, ["k"]), (df.limit(0), ["k"]), (df, ["absent"])):
        with pytest.raises(ValueError):
            prepare_batch(bad, key)


def test_history_and_copy(spark, warehouse, tmp_path):
    for status in ("FAILED", "SUCCESS"):
        record_run(warehouse, {"run_id": "r1", "job_id": "j", "run_status": status})
    assert [r.run_status for r in warehouse.read("monitoring", "run_history").collect()] == ["SUCCESS"]
    assert warehouse.copy_to(Warehouse(spark, str(tmp_path / "other")), "monitoring") == {"run_history": 1}


def test_stream_upsert(spark, warehouse, tmp_path):
    source = tmp_path / "in"
    for i, v in enumerate((1, 2, 2)):
        spark.createDataFrame([("s", "09", v, i)], OBS).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(OBS).parquet(str(source))
        upsert_stream(stream, warehouse, "live", "t", ["k", "t"], str(tmp_path / "c"), "seq").awaitTermination()
        assert [r.v for r in warehouse.read("live", "t").collect()] == [v]


def test_stream_plans(spark, tmp_path):
    spark.sql("select timestamp '2024-01-01 00:00:00' as ts, 'a' as k, 1.0D as value").write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema("ts timestamp, k string, value double").parquet(str(tmp_path / "e"))
    for name, df in (("once", insert_only(stream, ["k"], "ts")), ("windows", windowed_counts(stream, "ts", ["k"]))):
        q = df.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
        assert q.exception() is None
    assert spark.table("once").count() == 1
