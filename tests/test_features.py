"""Opening hours, weather, air and candidates."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluice.functions import schedule
from sluice.plans import features

NTZ = "timestamp_ntz"


def at(text):
    return F.lit(text).cast(NTZ)


def feasible(spark, now, travel=0.0, rule="연중무휴", week=("06:00", "23:59"), weekend=("06:00", "23:59"), holidays=None):
    hours = dict(zip(("week_open", "week_close", "weekend_open", "weekend_close"), map(F.lit, (*week, *weekend))))
    known = tuple(F.lit(h) for h in holidays) if holidays else None
    return schedule.add_feasibility(spark.range(1), at(now), F.lit(travel), F.lit(rule), hours, known).first().feasibility


@pytest.mark.parametrize(("now", "travel", "usable", "state", "urgency"), [("20:00", 20.0, 219, "AVAILABLE", "AVAILABLE"), ("23:00", 20.0, 39, "AVAILABLE", "CLOSING_SOON"), ("23:30", 20.0, 9, "TOO_LATE", "TOO_LATE"), ("23:09", 20.0, 30, "AVAILABLE", "CLOSING_SOON"), ("22:39", 20.0, 60, "AVAILABLE", "CLOSING_SOON"), ("05:00", 20.0, None, "CLOSED", "CLOSED"), ("20:00", None, None, "UNKNOWN", "UNKNOWN"), ("20:00", -1.0, None, "UNKNOWN", "UNKNOWN")])
def test_urgency(spark, now, travel, usable, state, urgency):
    f = feasible(spark, f"2026-09-28 {now}:00", travel)
    assert (f.usable, f.state, f.urgency) == (usable, state, urgency)


def test_overnight_and_closings(spark):
    night = {"week": ("22:00", "02:00"), "weekend": ("-", "-")}
    f = feasible(spark, "2026-10-02 23:00:00", rule="월", **night)  # Friday
    assert f.open_now and f.closes_at == dt.datetime(2026, 10, 3, 2)
    f = feasible(spark, "2026-10-02 23:00:00", rule="토", **night)
    assert f.closes_at == dt.datetime(2026, 10, 3)
    f = feasible(spark, "2026-10-02 23:00:00", rule="공휴일", **night)
    assert f.open_now is None and f.state == "UNKNOWN"
    f = feasible(spark, "2026-10-02 23:00:00", rule="토+일+공휴일", holidays=(False, False, False), **night)
    assert f.open_now and f.closes_at == dt.datetime(2026, 10, 3)
    assert feasible(spark, "2026-10-02 12:00:00", rule="금요일").state == "CLOSED"
    assert feasible(spark, "2026-10-02 12:00:00", rule="첫째 주").open_now is None


def test_clock(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["06:00", "0600", "24:00", "2401", "9:5", "-", None])], "i int, v string")
    assert [r[0] for r in df.orderBy("i").select(schedule.clock(F.col("v"))).collect()] == [360, 360, 1440, None, None, None, None]


def test_combine(spark):
    say = lambda *s: spark.range(1).select(schedule.combine(F.array(*[F.lit(x) for x in s]).cast("array<string>"))).first()[0]
    assert [say("FAVORABLE", "CAUTION"), say("FAVORABLE", "FAVORABLE"), say("FAVORABLE", None), say()] == ["CAUTION", "FAVORABLE", "UNKNOWN", "UNKNOWN"]


FORECAST = "nx long, ny long, category string, baseDate string, baseTime string, fcstDate string, fcstTime string, fcstValue string, collected_at string"
OBSERVED = "nx long, ny long, category string, baseDate string, baseTime string, obsrValue string, collected_at string"


def forecasts(spark, *rows):
    return spark.createDataFrame([(60, 127, c, "20260928", issued, "20260928", valid, v, f"2026-09-28 {issued[:2]}:{issued[2:]}:00") for c, issued, valid, v in rows], FORECAST)


def places(spark, target="2026-09-28 12:50:00"):
    return spark.createDataFrame([("p", 60, 127)], "key string, nx long, ny long").select("key", F.struct("nx", "ny").alias("grid"), at(target).alias("target"))


def test_weather_choice_never_looks_ahead(spark):
    found = features.weather_rows(spark.createDataFrame([], OBSERVED), forecasts(spark, ("T1H", "1130", "1200", "10"), ("T1H", "1130", "1300", "21"), ("T1H", "1030", "1300", "19"), ("T1H", "1230", "1300", "99")))
    best = features.choose_weather(places(spark), found, "key", at("2026-09-28 12:00:00")).first()
    assert best.t1h.value == "21" and best.pty is None and "FUTURE_DATA" in best.rejected


def test_weather_states(spark):
    now = at("2026-09-28 12:00:00")

    def state(*rows):
        found = features.weather_rows(spark.createDataFrame([], OBSERVED), forecasts(spark, *rows))
        return features.weather_features(features.choose_weather(places(spark), found, "key", now), F.lit(True)).first()

    assert state(("T1H", "1130", "1300", "21"), ("PTY", "1130", "1300", "1")).weather_state == "CAUTION"
    assert state(("T1H", "1130", "1300", "21"), ("RN1", "1130", "1300", "강수없음")).weather_state == "FAVORABLE"
    odd = state(("T1H", "1130", "1300", "21"), ("RN1", "1130", "1300", "1mm 미만"))
    assert (odd.precipitation, odd.weather_state, odd.weather_availability) == (None, "UNKNOWN", "PARTIAL")
    assert state(("T1H", "0730", "1300", "21")).weather_availability == "STALE"


def test_air_uses_latest_station_and_worst_value(spark):
    schema = "sidoName string, stationName string, dataTime string, collected_at string, pm10Value string, pm25Value string"
    rows = [("서울", "중구", "2026-09-28 10:00:00", "2026-09-28 10:05:00", "999", "10"), ("서울", "중구", "2026-09-28 11:00:00", "2026-09-28 11:05:00", "20", "10"), ("서울특별시", "종로", "2026-09-28 11:00:00", "2026-09-28 11:05:00", "10", "40"), ("부산", "x", "2026-09-28 11:00:00", "2026-09-28 11:05:00", "500", "500")]
    df, now = spark.createDataFrame(rows, schema), at("2026-09-28 12:00:00")
    got = {r.region: r for r in features.air_by_region(df, now, now).collect()}["서울특별시"]
    assert (got.pm10, got.pm25, got.air_state, got.stations) == (20, 40, "CAUTION", 2)
    one = features.air_by_region(df.where("stationName = '중구'"), now, now).first()
    assert (one.air_state, one.air_availability) == ("FAVORABLE", "AVAILABLE")


def test_air_remembers_what_it_could_not_use(spark):
    schema = "sidoName string, stationName string, dataTime string, collected_at string, pm10Value string, pm25Value string"
    good = ("서울", "중구", "2026-09-28 11:00:00", "2026-09-28 11:05:00", "20", "10")
    now = at("2026-09-28 12:00:00")

    def region(*rows, **kw):
        return features.air_by_region(spark.createDataFrame([good, *rows], schema), now, now, **kw).first()

    for fault, time in (("FUTURE_DATA", "2026-09-28 13:00:00"), ("UNKNOWN_MEASUREMENT_TIME", None)):
        got = region(("서울", "종로", time, "2026-09-28 11:05:00", "1", "1"))
        assert (got.air_state, got.air_availability, got.air_rejected) == ("UNKNOWN", "PARTIAL", [fault])
    stale = features.air_by_region(spark.createDataFrame([("서울", "중구", "2026-09-28 01:00:00", "2026-09-28 01:05:00", "20", "10")], schema), now, now).first()
    assert (stale.air_availability, stale.air_rejected) == ("STALE", ["STALE"])
    nameless = region(("서울", " ", None, None, "1", "1"))
    assert (nameless.air_state, nameless.stations) == ("FAVORABLE", 1)
    verified = region(("서울", "종로", None, None, "1", "1"), station="중구")
    assert (verified.air_availability, verified.air_scope) == ("AVAILABLE", "VERIFIED_STATION")


@pytest.mark.parametrize("bad", [{"air_age": 0}, {"forecast_offset": -1}, {"pm10": float("nan")}, {"hot": float("inf")}, {"cold": 30.0}])
def test_limits_must_make_sense(bad):
    with pytest.raises(ValueError):
        features.EnvironmentConfig(**bad)


def test_exercise_features_end_to_end(spark):
    df = spark.createDataFrame([("a", 37.5665, 126.9780, "06:00", "22:00", "연중무휴", "서울", "OUTDOOR"), ("b", None, None, None, None, None, "x", "INDOOR")], "key string, latitude double, longitude double, weekdayOperOpenHhmm string, weekdayOperColseHhmm string, rstde string, sido_standard string, exposure string")
    weather = features.weather_rows(spark.createDataFrame([], OBSERVED), forecasts(spark, ("T1H", "1130", "1200", "21"), ("PTY", "1130", "1200", "0")))
    air = spark.createDataFrame([("서울", "중구", "2026-09-28 11:00:00", "2026-09-28 11:05:00", "20", "10")], "sidoName string, stationName string, dataTime string, collected_at string, pm10Value string, pm25Value string")
    got = {r.key: r for r in features.exercise_features(df, weather, air, at("2026-09-28 12:00:00"), "key", exposure="exposure").collect()}
    assert (got["a"].outdoor_suitability, got["a"].weather_availability, got["a"].air_availability) == ("FAVORABLE", "AVAILABLE", "AVAILABLE")
    assert (got["b"].outdoor_suitability, got["b"].weather_availability, got["b"].air_availability) == ("NOT_APPLICABLE", "UNLINKED", "UNLINKED")


def test_candidates_and_top_k(spark):
    first = spark.createDataFrame([("1", "gym", "", "실내", "서울", "중구", 37.5, 127.0)] * 2, "faci_cd string, faci_nm string, ftype_nm string, inout_gbn_nm string, cp_nm string, cpb_nm string, faci_lat double, faci_lot double").withColumns({"fcob_nm": F.lit("f"), "faci_road_addr": F.lit("road"), "faci_addr": F.lit(None).cast("string")})
    second = spark.createDataFrame([("court", "t", "addr", None, "서울", 37.6, 127.0), ("far", "t", "addr", None, "서울", None, None)], "openFcltyNm string, openFcltyType string, rdnmadr string, lnmadr string, sido_standard string, latitude double, longitude double")
    found = features.candidates(first, second, at("2026-09-28 12:00:00"))
    assert found.count() == 3
    near = features.nearest_facilities(found, 37.5, 127.0, 3, city="서울").collect()
    assert [r.facility_name for r in near] == ["gym", "court", "far"] and near[0].exposure == "INDOOR"


def test_config():
    with pytest.raises(ValueError):
        features.EnvironmentConfig(cold=40)
