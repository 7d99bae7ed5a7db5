"""The state of stations after each micro-batch beside what SQL says of all rows so far."""

import random

import pytest
from pyspark.sql import functions as F

from sluice.plans.publish import Warehouse
from sluice.streaming import current

SCHEMA = "region string, station string, measured timestamp, collected timestamp, pm10 double, pm25 double, arrived timestamp"

EXPECTED = """WITH clock AS (SELECT max(unix_millis(arrived)) AS now FROM {rows}),
last AS (SELECT region, station, max(struct(unix_millis(measured) AS measured, unix_millis(collected) AS collected, pm10, pm25)) AS x FROM {rows} WHERE region IS NOT NULL AND station IS NOT NULL AND measured IS NOT NULL GROUP BY ALL)
SELECT region, station, x.*, CASE WHEN now > x.measured + {age} * 60000 THEN 'STALE' ELSE 'CURRENT' END AS state FROM last CROSS JOIN clock"""


def test_after_each_batch(spark, tmp_path):
    rng, warehouse, source = random.Random(4), Warehouse(spark, str(tmp_path / "w")), str(tmp_path / "in")
    at = lambda minute: F.timestamp_seconds(F.lit(1_700_000_000) + F.col(minute) * 60)
    expired = corrected = 0
    for batch in range(4):
        rows = []
        for i in range(40):
            measured = batch * 60 + rng.randint(-150, 50)  # some are late by far
            rows.append((rng.choice(["a", "b", "c/ü"]), rng.choice("xyz"), measured, measured + rng.randint(0, 20), rng.choice([None, -1.0, 1.0 * i]), 2.0 * i, batch * 60 + rng.randint(0, 59)))
        if batch == 2:  # only one station speaks, the clock goes on, others grow old
            rows = [("a", "x", 125, 126, 7.0, 7.0, 125), ("a", "x", 30, 179, 99.0, 99.0, 179), ("c/ü", "new", -500, 1, 1.0, 1.0, 178), (None, "x", 1, 1, 1.0, 1.0, 170)]
        df = spark.createDataFrame(rows, "region string, station string, m int, c int, pm10 double, pm25 double, a int").select("region", "station", at("m").alias("measured"), at("c").alias("collected"), "pm10", "pm25", at("a").alias("arrived"))
        df.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        current.keep_current(stream, warehouse, "air", str(tmp_path / "state"), 90).awaitTermination()
        want = spark.sql(EXPECTED.replace("{age}", "90"), rows=spark.read.schema(SCHEMA).parquet(source))
        got = warehouse.read("air", "stations")
        assert sorted(map(tuple, got.select(want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
        regions = warehouse.read("air", "regions")
        assert sorted(map(tuple, regions.collect())) == sorted(map(tuple, current.roll_up(want).select(regions.columns).collect()))
        expired += got.where("state = 'STALE'").count()
        corrected += got.where("collected - measured > 0").count()
    assert expired and corrected


def test_replay_changes_nothing(spark, tmp_path):
    warehouse, source = Warehouse(spark, str(tmp_path / "w")), str(tmp_path / "in")
    spark.sql("SELECT 'a' AS region, 's' AS station, timestamp '2024-01-01 10:00:00' AS measured, timestamp '2024-01-01 10:01:00' AS collected, 1.0D AS pm10, 2.0D AS pm25, timestamp '2024-01-01 10:02:00' AS arrived").write.parquet(source)
    for state in ("one", "two"):  # a second stream from the beginning
        current.keep_current(spark.readStream.schema(SCHEMA).parquet(source), warehouse, "air", str(tmp_path / state), 90).awaitTermination()
        assert [r.state for r in warehouse.read("air", "stations").collect()] == ["CURRENT"]
