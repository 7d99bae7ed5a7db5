"""Processors, lineage and audits on small frames."""

import pytest
from pyspark.sql import functions as F

from sluice.operators import dedup, lineage, profile
from sluice.plans import processors, specs
from sluice.plans.processors import SEQ, process


def frame(spark, columns, rows):
    schema = ", ".join(f"{c} string" for c in columns.split()) + f", {SEQ} long"
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], schema)


def facility(spark):
    return frame(spark, "faci_cd faci_stat_nm faci_lat faci_lot faci_gfa", [("A", "정상운영", "37.5", "127.0", "1,000"), ("B", "폐업", "37.5", "127.0", "1"), ("A", "정상운영", "999", "127.0", "x"), ("A", "정상운영", "37.6", "127.0", "bad")])


def test_facility_reasons_and_audit(spark):
    out, found = profile.audit("facility", facility(spark), processors.facility, SEQ, dedup_keys=["faci_cd"])
    assert found.status == "PASS"
    assert found.rows["removed_rows"] == 3 and found.rows["unexplained_rows"] == 0
    assert found.reasons == {"facility_status_not_normal_operation": 1, "facility_invalid_or_missing_korea_coordinates": 1, "facility_duplicate_faci_cd": 1}
    assert found.losses["lost_faci_gfa"] == 1
    rules = found.rules()
    assert {k: r["status"] for k, r in rules.items()} == {"row_tracking": "PASS", "row_reconciliation": "PASS", **{k: "NOT_APPLICABLE" for k in ("null_transition", "dedup", "needs_review", "column_profile")}}
    assert rules["row_reconciliation"]["expected"] == rules["row_reconciliation"]["observed"] == 1 and rules["null_transition"]["observed"] == {"conversion": 1}
    assert found.duplicates["duplicate_groups"] == 1
    assert out.count() == 1 and not [c for c in out.columns if c.startswith("_dq")]


def test_partition_count_does_not_matter(spark):
    raw = facility(spark)
    for n in (1, 8):
        rows = process("facility", raw.repartition(n)).collect()
        assert [(r.faci_cd, r.faci_lat) for r in rows] == [("A", 37.6)]


def test_weather_keeps_rain_text(spark):
    raw = frame(spark, "baseDate baseTime category fcstDate fcstTime fcstValue nx ny", [("20260927", "1200", "RN1", "20260927", "1300", "강수없음", "60", "127"), ("20260927", "1200", "T1H", "20260927", "1300", "21", "60", "127"), ("20260927", "1200", "T1H", "20260927", "1300", "22", "60", "127")])
    got = {r.category: r.fcstValue for r in process("weather", raw).collect()}
    assert got == {"RN1": "강수없음", "T1H": "22.0"}


def test_air_quality_identity(spark):
    columns = "sidoName stationName dataTime collected_at pm10Value pm25Value o3Value khaiValue"
    raw = frame(spark, columns, [("서울", "중구", None, "2026-09-29T12:00:00", "1", "2", "0.1", "3"), ("서울", "중구", "2026-09-29 11:00", "2026-09-29T12:00:00", "1", "2", "0.1", "-")])
    got = sorted((r.observation_time_key, r.needs_review) for r in process("air_quality", raw).collect())
    assert got == [("collected:2026-09-29T12:00:00", True), ("measured:2026-09-29T11:00:00", True)]
    with pytest.raises(Exception, match="no usable time"):
        process("air_quality", frame(spark, columns, [("서울", "중구", "bad-time", "2026-09-29T12:00:00", "1", "2", "3", "4")])).collect()


def test_open_facility_aed_and_culture(spark):
    raw = frame(spark, "openFcltyNm rdnmadr lnmadr latitude longitude", [("a", "강원도 춘천시", "-", "37.8", "127.7"), ("b", "", "", "37.8", "127.7")])
    got = {r.openFcltyNm: (r.sido_standard, r.needs_review) for r in process("public_open_facility", raw).collect()}
    assert got == {"a": ("강원특별자치도", False), "b": (None, True)}
    aed = frame(spark, "serialSeq wgs84Lat wgs84Lon", [("1", "37", "127"), ("1", "37.1", "127"), (None, "37", "127"), ("2", "10", "127")])
    assert process("aed", aed).count() == 2
    transport = frame(spark, "ALSFC_LA ALSFC_LO PBTRNSP_FCLTY_LA PBTRNSP_FCLTY_LO ALSFC_CTPRVN_NM ALSFC_NM", [("37", "127", "99", "127", "서울", "x")])
    row = process("culture_sports_facility_nearby_public_transport", transport, drop_empty_columns=False).first()
    assert (row.PBTRNSP_FCLTY_LA, row.ALSFC_CTPRVN_NM, row.needs_review) == (None, "서울특별시", False)


def test_warning_status(spark):
    raw = frame(spark, "t6 t7 tmEf tmFc tmSeq collected_at", [("o 없음", "o 없음", "202609271200", "202609271200", "1", "2026-09-27"), ("강풍주의보: 서울특별시", "(1) 풍랑 예비특보\no 밤 : 서해중부먼바다", "202609281200", "202609281200", "2", "2026-09-28")])
    got = sorted((r.warning_status, r.area_type) for r in process("weather_warning_status", raw, allow_empty=True).collect())
    assert got == [("ACTIVE", "LAND"), ("PRELIMINARY", "SEA")]


def test_keys_are_checked(spark):
    with pytest.raises(ValueError, match="duplicate"):
        process("trails", frame(spark, "routeIdx themeNm", [("1", "a"), ("1", "b")]))
    trails, segments = frame(spark, "routeIdx", [("R1",)]), frame(spark, "routeIdx crsIdx", [("R1", "1"), ("R2", "2")])
    with pytest.raises(ValueError, match="1 orphans"):
        specs.VALIDATORS["segments_have_trails"]({"durunubi_trails": trails, "durunubi_segments": segments})
    with pytest.raises(KeyError):
        process("unknown", trails)


def test_bicycle(spark):
    columns = "afos_fid afos_id expected_afos_id spot_nm request_year request_sido request_gugun lo_crd la_crd occrrnc_cnt geom_json collected_at"
    good = ("1", "7", "7", "spot", "2024", "11", "110", "127.0", "32.5", "3", '{"type": "Polygon", "coordinates": [[[1, 2]]]}', "2026-09-27T12:00:00+09:00")
    row = process("bicycle", frame(spark, columns, [good, good])).first()
    assert row.search_year == 2024 and row.polygon_valid and not row.needs_review
    for i, bad in ((9, "-3"), (9, "x"), (2, "8"), (3, "")):
        with pytest.raises(ValueError):
            process("bicycle", frame(spark, columns, [(*good[:i], bad, *good[i + 1 :])]))
    with pytest.raises(ValueError, match="conflicting"):
        process("bicycle", frame(spark, columns, [good, (*good[:9], "4", *good[10:])]))


def test_registry_covers_the_catalog():
    catalog = specs.Catalog()
    assert {t.processor for t in catalog.tables().values()} <= set(processors.PROCESSORS)
    assert len(catalog.tables()) == 19
    assert [d.name for d in catalog.phases()[-1]] == ["culture"]


def test_null_transitions_ignore_order(spark):
    before = lineage.add_lineage(frame(spark, "v", [("20",), ("10",), ("bad",)]), "x", SEQ)
    after = before.withColumn("v", F.col("v").try_cast("int")).orderBy("v")
    assert lineage.null_transitions(before, after, ["v"]).first()["lost_cells"] == 1
    assert lineage.null_transitions(before, before.orderBy("v"), ["v"]).first()["lost_cells"] == 0


def test_reconcile_frames(spark):
    raw = lineage.add_lineage(frame(spark, "v", [("a",), ("b",), ("c",), ("d",)]), "x", SEQ)
    reasons = raw.limit(1).select(lineage.ROW_ID, F.lit("r").alias("reason"))
    kept = raw.where("v in ('c', 'd')")
    got = lineage.reconcile_frames(raw, kept, raw.where("v = 'a'").select(lineage.ROW_ID, F.lit("r").alias("reason"))).first()
    assert (got.removed_rows, got.explained_rows, got.unexplained_rows, got.matches) == (2, 1, 1, True)
    assert reasons.count() == 1


def test_dedup_metrics(spark):
    df = spark.createDataFrame([("A", 1), ("A", 1), ("B", 1), ("B", 2), ("B", 3), (None, 1), (None, 1)], "k string, v int")
    assert tuple(dedup.metrics(df, ["k"], ["v"]).first()) == (2, 5, 3, 1, 1)
    empty = tuple(dedup.metrics(df.limit(0), ["k"], ["v"]).first())
    assert empty == (0, 0, 0, 0, 0)


def test_column_statistics(spark):
    rows = {r["column"]: r for r in profile.column_profiles(spark.createDataFrame([(1.0, ""), (float("inf"), "abc"), (None, None)], "n double, s string")).collect()}
    assert rows["n"]["infinite"] == 1 and rows["n"]["median"] == 1.0 and rows["s"]["blank"] == 1 and rows["s"]["max_length"] == 3


def test_both_profiles_count_values_once(spark, monkeypatch):
    labels, staged = [], profile.staged
    monkeypatch.setattr(profile, "staged", lambda df, label: labels.append(label) or staged(df, label))
    rows = [(1, -0.0, " ", "2024-01-05", [1]), (2, 0.0, "ab", "2023-12-31", None), (4, float("nan"), None, None, [1]), (9, 3.0, "ab", "2024-02-01", [2]), (None, 5.0, "abc", None, None)]
    df = spark.createDataFrame(rows, "n long, x double, s string, d string, a array<int>").withColumn("d", F.col("d").cast("date")).withColumn("_hidden", F.lit(1))
    got = {(r["frame"], r["column"]): r for r in profile.both_profiles(df, df.where("n > 1")).collect()}
    assert labels == ["counted-values"] and len(got) == 10
    pick = lambda frame, c, *names: tuple(got[frame, c][k] for k in names)
    assert pick("raw", "n", "rows", "nulls", "distinct", "minimum", "maximum", "mean", "median", "null_rate") == (5, 1, 4, 1.0, 9.0, 4.0, 3.0, 0.2)
    assert pick("processed", "n", "rows", "nulls", "distinct", "minimum", "median") == (3, 0, 3, 2.0, 4.0)
    assert pick("raw", "x", "distinct", "median", "infinite") == (4, 1.5, 0) and pick("processed", "x", "median", "mean") == (1.5, 1.5)
    assert pick("raw", "s", "nulls", "distinct", "min_length", "max_length", "blank", "median") == (1, 3, 1, 3, 1, None)
    assert pick("raw", "d", "earliest", "latest", "nulls", "infinite") == ("2023-12-31", "2024-02-01", 2, None)
    assert pick("raw", "a", "distinct", "nulls") == (2, 2)
    other = profile.both_profiles(df, df.select(F.col("n").cast("string"))).collect()
    assert [(r["column"], r["type"], r["distinct"]) for r in other if r["frame"] == "processed"] == [("n", "string", 4)]
    empty = profile.both_profiles(df, df.limit(0)).where("frame = 'processed' and column = 'n'").first()
    assert (empty["rows"], empty["nulls"], empty["distinct"], empty["median"], empty["null_rate"], empty["infinite"]) == (0, 0, 0, None, None, 0)
