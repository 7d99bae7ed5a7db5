"""Cleaning expressions cell by cell."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluice.functions import clean, geo, text


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_null_tokens(spark):
    assert column(spark, ["", " NULL ", "-", "NaN", " valid ", "0", None, "　x\t"], clean.normalize) == [None, None, None, None, "valid", "0", None, "x"]
    assert column(spark, ["--", "a", None], clean.null_token) == [True, False, True]


def test_numbers(spark):
    assert column(spark, ["20", "-", "bad", "1,234", "1.5f", "1d", "nan", "inf", " 12 ", "1e3", "0x10", None], clean.number) == [20, None, None, 1234, None, None, None, float("inf"), 12, 1000, None, None]
    assert column(spark, ["1.5", "2.0", "1,234", "x", "inf"], clean.integer) == [None, 2, 1234, None, None]


def test_moments(spark):
    got = column(spark, ["00000101", "20210310", "20150400", "2021-08-11", "202609271200", "2026/09/26", "1234", "16991231", "2026-09-26T10:00:00+09:00", None], clean.moment)
    d = dt.datetime
    assert got == [None, d(2021, 3, 10), None, d(2021, 8, 11), d(2026, 9, 27, 12), d(2026, 9, 26), None, None, None, None]


def test_optional_pairs(spark):
    df = spark.createDataFrame([(1, None, 127.0), (2, None, 999.0), (3, 99.0, 127.0), (4, 37.5, 127.0)], "i int, lat double, lon double")
    assert [tuple(r) for r in clean.blank_pair(df, "lat", "lon").orderBy("i").collect()] == [(1, None, 127.0), (2, None, None), (3, None, None), (4, 37.5, 127.0)]


def test_regions_and_addresses(spark):
    assert column(spark, ["강원도 춘천시 x", None], lambda c: clean.mapped(clean.first_word(c, F.lit("서울 y")))) == ["강원특별자치도", "서울특별시"]
    assert column(spark, ["서울", "nowhere"], lambda c: clean.mapped(c, strict=True)) == ["서울특별시", None]


def test_area_json(spark):
    good = '{"type": "Polygon", "coordinates": [[[1, 2]]]}'
    got = column(spark, [good, '{"type": "Point", "coordinates": [1]}', '{"type": "Polygon", "coordinates": []}', "{", None], clean.area_json)
    assert got[0] and got[1:] == [None] * 4


def test_answers(spark):
    df = spark.createDataFrame([(429, None, "LIMITED_NUMBER_OF_SERVICE_REQUESTS_EXCEEDS_ERROR"), (204, "00", ""), (200, None, ""), (200, "0", ""), (200, "0000", ""), (429, None, ""), (503, None, ""), (200, "99", ""), (200, "03", ""), (200, "10", ""), (200, "30", ""), (400, None, ""), (200, "00", "")], "s int, c string, b string")
    assert [r[0] for r in df.select(clean.status_class(F.col("s"), F.col("c"), F.col("b"))).collect()] == ["global_stop", "permanent", "permanent", "ok", "ok", "transient", "transient", "transient", "empty", "unsupported", "global_stop", "permanent", "ok"]


@pytest.mark.parametrize(("lat", "lon", "cell"), [(37.5665, 126.9780, (60, 127)), (35.1796, 129.0756, (98, 76)), (33.4996, 126.5312, (53, 38)), (38.0, 126.0, (43, 136)), (91.0, 127.0, None), (0.0, 127.0, None), (37.0, None, None), (37.0, 181.0, None), (float("nan"), 127.0, None)])
def test_grid(spark, lat, lon, cell):
    row = spark.createDataFrame([(lat, lon)], "lat double, lon double").select(geo.grid(F.col("lat"), F.col("lon"))).first()[0]
    assert (tuple(row) if row else None) == cell


def test_distance(spark):
    row = spark.range(1).select(geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.01), F.lit(0.0)).alias("km")).select("km", geo.travel_minutes(F.col("km"))).first()
    assert abs(row[0] - 1.1119492664) < 1e-9 and row[1] == 22


def test_warning_bulletins(spark):
    df = spark.createDataFrame([(1, "강풍주의보: 서울특별시\no 없음이 아님", "(1) 풍랑 예비특보\no 09월 30일 밤 : 서해중부먼바다", "a")], "k int, t6 string, t7 string, tmEf string")
    active = text.active_warnings(df).collect()
    assert [(r.warning_type, r.warning_level, r.warning_status, r.area_type) for r in active] == [("강풍", "주의보", "ACTIVE", "LAND")]
    later = text.preliminary_warnings(df, "k").collect()
    assert [(r.warning_type, r.effective_time, r.area_type) for r in later] == [("풍랑", "09월 30일 밤", "SEA")]
    assert text.active_warnings(df.withColumn("t6", F.lit("o 없음"))).count() == 0


def test_empty_columns(spark):
    raw = spark.createDataFrame([("-", "x", None)], "a string, b string, needs_review string")
    assert clean.empty_columns(raw, clean.normalize_nulls(raw)) == ["a"]
    assert clean.empty_columns(raw.limit(0), raw.limit(0)) == []


def test_strip_takes_the_white_space_that_patterns_know(spark):
    """Every character of the basic plane at both ends, as the pattern ``\\s`` of Unicode has it; no pattern is run for a row."""
    odd = spark.range(1, 0xD800).union(spark.range(0xE000, 0x10000)).selectExpr("id", "decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE') AS c")
    odd = odd.selectExpr("id", "explode(array(c || 'a' || c, c || ' b' || c || c, c)) AS t")
    bad = odd.where(~clean.strip(F.col("t")).eqNullSafe(F.regexp_replace("t", r"(?U)^\s+|\s+$", "")))
    assert odd.count() == 3 * (0xD7FF + 0x2000) and bad.count() == 0
    assert "regexp" not in odd.select(clean.strip(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()


def test_rows_of_a_small_file_are_dealt_over_all_cores(spark):
    from sluice.plans import processors

    raw = spark.range(2000).coalesce(1).selectExpr("id AS _ingest_seq", "cast(id AS string) AS v")
    held = processors.dealt(raw).selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()
    assert len(held) >= spark.sparkContext.defaultParallelism and sum(r["count"] for r in held) == 2000
    assert processors.process("culture_base", raw).count() == 2000
