"""Registered queries of the table processors, features and publication, beside the SQL that must give the same rows.

Each raw frame is one SELECT over a provided table, in SQL that Spark and DuckDB read alike; ``{t}`` is the table. It makes
unclean text of clean columns; the expected rows are SQL of their own over the same raw frame.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions import clean, schedule, text
from sluice.operators import dedup, lineage, profile, ranges, runs
from sluice.plans import features
from sluice.plans.processors import CULTURE, SEQ, process
from sluice.plans.publish import Warehouse, scratch
from sluice.sources import files
from sluice.streaming.upsert import insert_only, upsert_stream, windowed_counts

QUERIES: dict = {}
SQL: dict[str, str] = {}

TABLE = {"facility": "customer", "open": "supplier", "aed": "supplier", "air": "events", "weather": "events", "trails": "part", "warning": "orders", "hotspot": "customer", "culture": "part", "bulletin": "region"}
# Both engines read these alike.
RAW = {
    "facility": """SELECT CASE WHEN c_custkey % 50 = 0 THEN '-' ELSE 'F' || CAST(c_custkey % 90 AS STRING) END AS faci_cd, c_name AS faci_nm,
  CASE WHEN c_custkey % 11 = 0 THEN '폐업' WHEN c_custkey % 13 = 0 THEN NULL ELSE ' 정상운영 ' END AS faci_stat_nm,
  CASE WHEN c_custkey % 17 = 0 THEN 'x' ELSE CAST(32 + c_custkey % 8 AS STRING) || '.5' END AS faci_lat, CAST(123 + c_custkey % 10 AS STRING) || '.25' AS faci_lot,
  CASE WHEN c_custkey % 19 = 0 THEN 'abc' ELSE '1,' || lpad(CAST(c_custkey % 1000 AS STRING), 3, '0') END AS faci_gfa,
  CASE WHEN c_custkey % 23 = 0 THEN '20240230' ELSE '202401' || lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0') END AS base_ymd, c_custkey AS _ingest_seq FROM {t}""",
    "open": """SELECT s_name AS openFcltyNm, CASE WHEN s_suppkey % 5 = 0 THEN ' NULL ' WHEN s_suppkey % 3 = 0 THEN '서울 중구' ELSE '강원도  춘천시' END AS rdnmadr,
  CASE WHEN s_suppkey % 10 = 0 THEN '' ELSE '부산 해운대' END AS lnmadr, 'old' AS sido, CAST(30 + s_suppkey % 12 AS STRING) AS latitude, CAST(120 + s_suppkey % 15 AS STRING) AS longitude, s_suppkey AS _ingest_seq FROM {t}""",
    "aed": "SELECT CASE WHEN s_suppkey % 20 = 0 THEN NULL ELSE CAST(s_suppkey % 40 AS STRING) END AS serialSeq, CAST(32 + s_suppkey % 7 AS STRING) AS wgs84Lat, '127' AS wgs84Lon, s_suppkey AS _ingest_seq FROM {t}",
    "air": """SELECT CASE WHEN user_id % 2 = 0 THEN '서울' ELSE '부산' END AS sidoName, 'S' || CAST(user_id % 7 AS STRING) AS stationName,
  CASE WHEN event_id % 6 = 0 THEN '-' ELSE '2024-01-0' || CAST(1 + event_id % 5 AS STRING) || ' 10:00' END AS dataTime, '2024-01-0' || CAST(1 + event_id % 9 AS STRING) || 'T12:00:00' AS collected_at,
  CAST(event_id % 120 AS STRING) AS pm10Value, CASE WHEN event_id % 8 = 0 THEN '-' ELSE CAST(event_id % 50 AS STRING) END AS pm25Value, '0.05' AS o3Value, CASE WHEN event_id % 9 = 0 THEN '1.5' ELSE '70' END AS khaiValue, event_id AS _ingest_seq FROM {t}""",
    "weather": """SELECT '202401' || lpad(CAST(1 + event_id % 20 AS STRING), 2, '0') AS baseDate, lpad(CAST(event_id % 24 AS STRING), 2, '0') || '30' AS baseTime,
  CASE WHEN event_id % 3 = 0 THEN 'RN1' ELSE 'T1H' END AS category, '202401' || lpad(CAST(1 + event_id % 20 AS STRING), 2, '0') AS fcstDate, lpad(CAST(event_id % 24 AS STRING), 2, '0') || '00' AS fcstTime,
  CASE WHEN event_id % 3 = 0 THEN '강수없음' WHEN event_id % 7 = 0 THEN 'none' WHEN event_id % 11 = 0 THEN '1mm' ELSE CAST(event_id % 40 AS STRING) END AS fcstValue, CAST(55 + user_id % 5 AS STRING) AS nx, '127.0' AS ny, event_id AS _ingest_seq FROM {t}""",
    "trails": """SELECT 'R' || CAST(p_partkey AS STRING) AS routeIdx, CASE WHEN p_partkey % 7 = 0 THEN '--' ELSE p_name END AS themeNm, CASE WHEN p_partkey % 5 = 0 THEN '2024/1/5' ELSE '20240105101500' END AS createdtime,
  'C' || CAST(p_partkey AS STRING) AS crsIdx, p_type AS crsKorNm, CASE WHEN p_partkey % 9 = 0 THEN 'far' ELSE CAST(p_size AS STRING) || '.5' END AS crsDstnc, CASE WHEN p_partkey % 4 = 0 THEN '1.5' ELSE '2' END AS crsLevel, p_partkey AS _ingest_seq FROM {t}""",
    "warning": """SELECT CAST(o_custkey % 30 AS STRING) AS stnId, '2024010' || CAST(1 + o_orderkey % 8 AS STRING) || '0900' AS tmFc, CASE WHEN o_orderkey % 40 = 0 THEN NULL ELSE CAST(o_orderkey % 6 AS STRING) END AS tmSeq, o_orderpriority AS title, o_orderkey AS _ingest_seq FROM {t}""",
    "hotspot": """SELECT CAST(CASE WHEN c_custkey % 30 = 0 THEN c_custkey - 1 ELSE c_custkey END AS STRING) AS afos_fid, 'A1' AS afos_id, 'A1' AS expected_afos_id, '2024' AS request_year, '11' AS request_sido, '110' AS request_gugun, 'spot' AS spot_nm,
  CAST(31 + (CASE WHEN c_custkey % 30 = 0 THEN c_custkey - 1 ELSE c_custkey END) % 9 AS STRING) || '.5' AS la_crd, '127.25' AS lo_crd, '3' AS occrrnc_cnt, '0' AS dth_dnv_cnt,
  CASE WHEN (CASE WHEN c_custkey % 30 = 0 THEN c_custkey - 1 ELSE c_custkey END) % 4 = 0 THEN '{{"type":"Point"}}' ELSE '{{"type":"Polygon","coordinates":[[1,2]]}}' END AS geom_json, '2024-01-01T00:00:00+09:00' AS collected_at, c_custkey AS _ingest_seq FROM {t}""",
    "culture": """SELECT CAST(p_partkey AS STRING) AS row_key, CASE WHEN p_partkey % 9 = 0 THEN ' - ' ELSE p_name END AS g_text, CAST(32 + p_partkey % 9 AS STRING) || '.1' AS g_lat,
  CASE WHEN p_partkey % 21 = 0 THEN '' ELSE CAST(123 + p_partkey % 10 AS STRING) || '.5' END AS g_lon, CASE WHEN p_partkey % 14 = 0 THEN 'N/A' ELSE CAST(30 + p_partkey % 12 AS STRING) END AS g_lat2, CAST(126 + p_partkey % 9 AS STRING) AS g_lon2,
  CASE WHEN p_partkey % 8 = 0 THEN 'abc' ELSE '1,' || lpad(CAST(p_size AS STRING), 3, '0') END AS g_num, CASE WHEN p_partkey % 6 = 0 THEN CAST(p_size AS STRING) || '.5' ELSE CAST(p_size AS STRING) || '.0' END AS g_int,
  CASE WHEN p_partkey % 10 = 0 THEN '00000101' WHEN p_partkey % 3 = 0 THEN '2024-02-0' || CAST(1 + p_partkey % 9 AS STRING) ELSE '202402' || lpad(CAST(1 + p_partkey % 28 AS STRING), 2, '0') END AS g_date,
  CASE WHEN p_partkey % 4 = 0 THEN '서울' WHEN p_partkey % 4 = 1 THEN '전라북도' ELSE '해외' END AS g_region, p_partkey AS _ingest_seq FROM {t}""",
    "bulletin": """SELECT CASE WHEN r_regionkey = 3 THEN '없음' ELSE 'o 강풍주의보 : 서울, 부산' || chr(10) || 'O 풍랑경보 : 동해중부앞바다' || chr(10) || chr(10) || 'no colon' || chr(10) || 'o 폭염 : 대구' || chr(10) || 'o 호우경보 :  ' END AS t6,
  CASE WHEN r_regionkey = 2 THEN 'o 없음' ELSE '(1) 호우 예비특보' || chr(10) || 'o 01월 02일 오전 : 경기도' || chr(10) || 'text' || chr(10) || '(2) 태풍 예비특보' || chr(10) || '○ 밤 : 남해먼바다' END AS t7,
  '202401020900' AS tmEf, '20240101090' || CAST(r_regionkey % 2 AS STRING) AS tmFc, CAST(r_regionkey AS STRING) AS tmSeq, '2024-01-01T10:00:00' AS collected_at, r_regionkey AS _ingest_seq FROM {t}""",
}


def raw(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.sql(RAW[name], t=spark.read.parquet(f"{d}/{TABLE[name]}.parquet"))


def raw_sql(name: str) -> str:
    return f"raw AS ({RAW[name].format(t=TABLE[name])})"


def query(source: str | None, sql: str | None):
    """Registers a query; its SQL may name the raw frame of ``source`` as raw."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = f"WITH {raw_sql(source)}{',' if sql.lstrip().startswith('also ') else ''} {sql.lstrip().removeprefix('also ')}" if source else sql
        return f

    return register


# SQL of the expected side
_text = lambda c: f"CASE WHEN lower(trim({c})) NOT IN ('', '-', '--', 'null', 'none', 'n/a', 'na', 'nan') THEN trim({c}) END"
_num = lambda c: f"TRY_CAST(replace({c}, ',', '') AS DOUBLE)"
_int = lambda c: f"CASE WHEN {_num(c)} % 1 = 0 THEN CAST({_num(c)} AS BIGINT) END"
_day = lambda c: f"CASE WHEN {c} NOT LIKE '0000%' THEN strftime(coalesce(TRY_STRPTIME({c}, '%Y%m%d'), TRY_STRPTIME({c}, '%Y-%m-%d')), '%Y-%m-%d') END"
_box = lambda lat, lon, south="33": f"({lat} BETWEEN {south} AND 39.5 AND {lon} BETWEEN 124 AND 132)"
_region = lambda c: f"CASE {c} WHEN '서울' THEN '서울특별시' WHEN '전라북도' THEN '전북특별자치도' WHEN '부산' THEN '부산광역시' WHEN '강원도' THEN '강원특별자치도' ELSE {c} END"


def day(c: str):
    return F.date_format(c, "yyyy-MM-dd").alias(c)


@query("facility", f"""also v AS (SELECT *, {_num('faci_lat')} AS lat, {_num('faci_lot')} AS lot, nullif(faci_cd, '-') AS cd FROM raw WHERE trim(faci_stat_nm) = '정상운영')
SELECT cd AS faci_cd, faci_nm, lat AS faci_lat, lot AS faci_lot, {_num('faci_gfa')} AS faci_gfa, {_day('base_ymd')} AS base_ymd FROM v WHERE {_box('lat', 'lot')} QUALIFY cd IS NULL OR row_number() OVER (PARTITION BY cd ORDER BY _ingest_seq DESC) = 1""")
def process_facility(spark, d):
    return process("facility", raw(spark, d, "facility")).select("faci_cd", "faci_nm", "faci_lat", "faci_lot", "faci_gfa", day("base_ymd"))


@query("open", f"""also v AS (SELECT *, {_text('rdnmadr')} AS a, {_text('lnmadr')} AS b FROM raw WHERE {_box(_num('latitude'), _num('longitude'))})
SELECT openFcltyNm, split_part(coalesce(a, b), ' ', 1) AS sido_raw, {_region("split_part(coalesce(a, b), ' ', 1)")} AS sido_standard, true AS coordinate_valid, coalesce(a, b) IS NOT NULL AS address_valid, coalesce(a, b) IS NULL AS needs_review FROM v""")
def process_public_open_facility(spark, d):
    return process("public_open_facility", raw(spark, d, "open")).select("openFcltyNm", "sido_raw", "sido_standard", "coordinate_valid", "address_valid", "needs_review")


@query("aed", f"SELECT serialSeq, {_num('wgs84Lat')} AS wgs84Lat FROM raw WHERE {_box(_num('wgs84Lat'), _num('wgs84Lon'))} QUALIFY serialSeq IS NULL OR row_number() OVER (PARTITION BY serialSeq ORDER BY _ingest_seq DESC) = 1")
def process_aed(spark, d):
    return process("aed", raw(spark, d, "aed")).select("serialSeq", "wgs84Lat")


@query("air", f"""also k AS (SELECT *, CASE WHEN dataTime <> '-' THEN 'measured:' || replace(dataTime, ' ', 'T') || ':00' ELSE 'collected:' || collected_at END AS observation_time_key FROM raw)
SELECT sidoName, stationName, observation_time_key, {_int('pm10Value')} AS pm10Value, {_int('pm25Value')} AS pm25Value, {_int('khaiValue')} AS khaiValue,
  dataTime = '-' OR {_int('pm25Value')} IS NULL OR {_int('khaiValue')} IS NULL AS needs_review
FROM k QUALIFY row_number() OVER (PARTITION BY sidoName, stationName, observation_time_key ORDER BY _ingest_seq DESC) = 1""")
def process_air_quality(spark, d):
    return process("air_quality", raw(spark, d, "air")).select("sidoName", "stationName", "observation_time_key", "pm10Value", "pm25Value", "khaiValue", "needs_review")


@query("weather", f"""SELECT {_day('baseDate')} AS baseDate, baseTime, category, {_int('nx')} AS nx, {_int('ny')} AS ny,
  CASE WHEN category = 'RN1' THEN {_text('fcstValue')} ELSE CAST({_num('fcstValue')} AS VARCHAR) END AS fcstValue
FROM raw QUALIFY row_number() OVER (PARTITION BY baseDate, baseTime, fcstDate, fcstTime, nx, ny, category ORDER BY _ingest_seq DESC) = 1""")
def process_weather(spark, d):
    return process("weather", raw(spark, d, "weather")).select(day("baseDate"), "baseTime", "category", "nx", "ny", "fcstValue")


@query("trails", f"SELECT routeIdx, {_text('themeNm')} AS themeNm, CASE WHEN _ingest_seq % 5 = 0 THEN '2024-01-05 00:00:00' ELSE '2024-01-05 10:15:00' END AS createdtime, {_text('themeNm')} IS NULL AS needs_review FROM raw")
def process_trails(spark, d):
    out = process("trails", raw(spark, d, "trails").select("routeIdx", "themeNm", "createdtime", SEQ))
    return out.withColumn("createdtime", F.date_format("createdtime", "yyyy-MM-dd HH:mm:ss")).select("routeIdx", "themeNm", "createdtime", "needs_review")


@query("trails", f"SELECT routeIdx, crsIdx, {_num('crsDstnc')} AS crsDstnc, {_int('crsLevel')} AS crsLevel, {_num('crsDstnc')} IS NULL AS needs_review FROM raw")
def process_segments(spark, d):
    return process("segments", raw(spark, d, "trails").drop("themeNm")).select("routeIdx", "crsIdx", "crsDstnc", "crsLevel", "needs_review")


@query("warning", f"SELECT stnId, strftime(strptime(tmFc, '%Y%m%d%H%M'), '%Y-%m-%d %H:%M') AS tmFc, {_int('tmSeq')} AS tmSeq, title FROM raw QUALIFY tmSeq IS NULL OR row_number() OVER (PARTITION BY stnId, tmFc, tmSeq ORDER BY _ingest_seq DESC) = 1")
def process_weather_warning(spark, d):
    return process("weather_warning", raw(spark, d, "warning")).withColumn("tmFc", F.date_format("tmFc", "yyyy-MM-dd HH:mm")).select("stnId", "tmFc", "tmSeq", "title")


_ACTIVE = r"""a AS (SELECT *, trim(regexp_replace(split_part(line, ':', 1), '^[oO○]\s*', '')) AS head, trim(substr(line, strpos(line, ':') + 1)) AS area
  FROM (SELECT *, trim(unnest(string_split(t6, chr(10)))) AS line FROM {src} WHERE NOT regexp_matches(t6, '^[oO○]?\s*없음$')) WHERE contains(line, ':')),
active AS (SELECT CASE WHEN head LIKE '%주의보' THEN left(head, -3) WHEN head LIKE '%경보' THEN left(head, -2) ELSE head END AS warning_type, CASE WHEN head LIKE '%주의보' THEN '주의보' WHEN head LIKE '%경보' THEN '경보' END AS warning_level,
  'ACTIVE' AS warning_status, area AS area_name, CASE WHEN area LIKE '%앞바다%' OR area LIKE '%먼바다%' OR area LIKE '%해역%' THEN 'SEA' ELSE 'LAND' END AS area_type, NULL AS effective_time, tmSeq FROM a WHERE area <> '')"""
_PRELIMINARY = r"""l AS (SELECT *, trim(unnest(string_split(t7, chr(10)))) AS line, generate_subscripts(string_split(t7, chr(10)), 1) AS n FROM {src} WHERE NOT regexp_matches(t7, '^[oO○]?\s*없음$')),
h AS (SELECT *, last_value(CASE WHEN regexp_matches(line, '^\(\d+\)') AND contains(line, '예비특보') THEN trim(replace(regexp_replace(line, '^\(\d+\)\s*', ''), '예비특보', '')) END IGNORE NULLS) OVER (PARTITION BY _ingest_seq ORDER BY n) AS kind FROM l),
preliminary AS (SELECT kind AS warning_type, '예비특보' AS warning_level, 'PRELIMINARY' AS warning_status, trim(substr(line, strpos(line, ':') + 1)) AS area_name,
  CASE WHEN line LIKE '%앞바다%' OR line LIKE '%먼바다%' OR line LIKE '%해역%' THEN 'SEA' ELSE 'LAND' END AS area_type, trim(regexp_replace(split_part(line, ':', 1), '^[oO○]\s*', '')) AS effective_time, tmSeq
  FROM h WHERE regexp_matches(line, '^[oO○]\s*') AND contains(line, ':'))"""


@query("bulletin", "also " + _ACTIVE.replace("{src}", "raw") + " SELECT * FROM active")
def active_warnings(spark, d):
    return text.active_warnings(raw(spark, d, "bulletin")).select("warning_type", "warning_level", "warning_status", "area_name", "area_type", "effective_time", "tmSeq")


@query("bulletin", "also " + _PRELIMINARY.replace("{src}", "raw") + " SELECT * FROM preliminary")
def preliminary_warnings(spark, d):
    return text.preliminary_warnings(raw(spark, d, "bulletin"), SEQ).select("warning_type", "warning_level", "warning_status", "area_name", "area_type", "effective_time", "tmSeq")


@query("bulletin", "also newest AS (SELECT * FROM raw ORDER BY CAST(tmFc AS DOUBLE) DESC, CAST(tmSeq AS DOUBLE) DESC, _ingest_seq DESC LIMIT 1), " + (_ACTIVE + ", " + _PRELIMINARY).replace("{src}", "newest") + " SELECT warning_type, warning_level, warning_status, area_name, area_type, CAST(tmSeq AS BIGINT) AS tmSeq FROM (SELECT * FROM active UNION ALL SELECT * FROM preliminary)")
def process_weather_warning_status(spark, d):
    out = process("weather_warning_status", raw(spark, d, "bulletin"), drop_empty_columns=False)
    return out.select("warning_type", "warning_level", "warning_status", "area_name", "area_type", "tmSeq")


@query("hotspot", f"""SELECT afos_fid, CAST(request_year AS BIGINT) AS search_year, request_sido AS si_do, {_num('la_crd')} AS latitude, geom_json LIKE '%Polygon%' AS polygon_valid, false AS needs_review
FROM raw WHERE {_box(_num('la_crd'), _num('lo_crd'), '32')} QUALIFY row_number() OVER (PARTITION BY afos_fid ORDER BY _ingest_seq) = 1""")
def process_bicycle(spark, d):
    return process("bicycle", raw(spark, d, "hotspot")).select("afos_fid", "search_year", "si_do", "latitude", "polygon_valid", "needs_review")


def _culture(name: str) -> None:
    rules, of = CULTURE[name], {}
    for i, c in enumerate(rules.box or ()):
        of[c] = ("g_lat", "g_lon")[i]
    for pair in rules.pairs:
        of |= dict(zip(pair, ("g_lat2", "g_lon2")))
    for columns, generic in ((rules.doubles, "g_num"), (rules.longs, "g_int"), (rules.moments, "g_date"), (rules.regions, "g_region"), (rules.review or (), "g_text")):
        of = {c: generic for c in columns} | of
    inside = f"NOT {_box(_num('g_lat2'), _num('g_lon2'))}"
    value = {
        "g_text": _text("g_text"), "g_lat": _num("g_lat"), "g_lon": _num("g_lon"), "g_num": _num("g_num"), "g_int": _int("g_int"), "g_date": _day("g_date"), "g_region": _region("g_region"),
        "g_lat2": f"CASE WHEN {inside} THEN NULL ELSE {_num('g_lat2')} END", "g_lon2": f"CASE WHEN {inside} THEN NULL ELSE {_num('g_lon2')} END",
    }
    review = " OR ".join(f"({value[of[c]]}) IS NULL" for c in rules.review)
    where = f" WHERE {_box(_num('g_lat'), _num('g_lon'))}" if rules.box else ""
    columns = sorted(of)

    def run(spark, d):
        base = raw(spark, d, "culture")
        out = process(f"culture_{name}", base.select("row_key", SEQ, *[F.col(of[c]).alias(c) for c in columns]), drop_empty_columns=False)
        return out.select("row_key", "needs_review", *[day(c) if of[c] == "g_date" else c for c in columns])

    run.__name__ = f"process_culture_{name}"
    query("culture", f"SELECT row_key, {review} AS needs_review, " + ", ".join(f'{value[of[c]]} AS "{c}"' for c in columns) + f" FROM raw{where}")(run)


for _name in CULTURE:
    _culture(_name)


@query("culture", f"SELECT row_key, {_text('g_text')} AS g_text, {_text('g_lat2')} AS g_lat2 FROM raw")
def process_culture_base(spark, d):
    return process("culture_base", raw(spark, d, "culture")).select("row_key", "g_text", "g_lat2")


# audits and profiles


@query("facility", f"""also v AS (SELECT *, trim(coalesce(faci_stat_nm, '')) = '정상운영' AS a, coalesce({_box(_num('faci_lat'), _num('faci_lot'))}, false) AS b FROM raw),
w AS (SELECT *, a AND b AND faci_cd <> '-' AND row_number() OVER (PARTITION BY a AND b, faci_cd ORDER BY _ingest_seq DESC) > 1 AS c FROM v)
SELECT 'facility_status_not_normal_operation' AS reason, count(*) AS rows FROM w WHERE NOT a UNION ALL SELECT 'facility_invalid_or_missing_korea_coordinates', count(*) FROM w WHERE a AND NOT b
UNION ALL SELECT 'facility_duplicate_faci_cd', count(*) FROM w WHERE c UNION ALL SELECT 'kept', count(*) FROM w WHERE a AND b AND NOT c
UNION ALL SELECT 'lost faci_gfa', count(*) FROM w WHERE a AND b AND NOT c AND {_num('faci_gfa')} IS NULL""")
def audit_facility(spark, d):
    from sluice.plans.processors import facility

    _, found = profile.audit("facility", raw(spark, d, "facility"), facility, SEQ, dedup_keys=["faci_cd"])
    rows = [*found.reasons.items(), ("kept", found.rows["processed_rows"]), ("lost faci_gfa", found.losses["lost_faci_gfa"])]
    return spark.createDataFrame(rows, "reason string, rows long")


@query(None, "SELECT count(*) FILTER (event_id % 10 = 0)::BIGINT AS missing_ids, count(*) FILTER (event_id % 15 = 1)::BIGINT AS unknown_ids, count(*) FILTER (event_id % 7 = 3 AND event_id % 10 <> 0 AND event_id % 15 <> 1)::BIGINT AS duplicate_ids, count(*) FILTER (event_id % 10 = 0)::BIGINT AS null_ids, false AS passed FROM events WHERE NOT (event_id % 10 = 0 AND event_id % 15 = 1)")
def lineage_audit_faults(spark, d):
    """Ids that are lost, made up, repeated and null; every kind must be counted."""
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id").where("not (event_id % 10 = 0 and event_id % 15 = 1)")
    before = lineage.add_lineage(e.where("event_id % 15 <> 1"), "events", "event_id")
    after = lineage.add_lineage(e, "events", "event_id").withColumn(lineage.ROW_ID, F.when(F.col("event_id") % 10 != 0, F.col(lineage.ROW_ID)))
    twice = after.where("event_id % 7 = 3 and event_id % 10 <> 0 and event_id % 15 <> 1")
    return lineage.audit_ids(before, after.unionByName(twice))


@query("air", "SELECT count(*) AS rows, count(*) FILTER (pm25Value = '-') AS null_pm25Value, 0::BIGINT AS null_pm10Value FROM raw")
def null_cells(spark, d):
    return lineage.null_cells(clean.normalize_nulls(raw(spark, d, "air")), ["pm25Value", "pm10Value"])


@query("air", f"also r AS (SELECT dataTime = '-' OR {_int('pm25Value')} IS NULL AS flag FROM raw) SELECT count(*) AS rows, count(*) FILTER (flag) AS review_rows, round(count(*) FILTER (flag) / count(*), 6) AS review_rate FROM r")
def review_metrics(spark, d):
    df = raw(spark, d, "air").select(clean.moment(F.col("dataTime")).alias("a"), clean.integer(F.col("pm25Value")).alias("b"))
    return profile.review_metrics(df.withColumn("needs_review", clean.any_null(df, ["a", "b"]))).withColumn("review_rate", F.round("review_rate", 6))


@query("aed", "also g AS (SELECT serialSeq, count(*) AS n, count(DISTINCT wgs84Lat) AS p FROM raw WHERE serialSeq IS NOT NULL GROUP BY 1 HAVING count(*) > 1) SELECT count(*) AS duplicate_groups, coalesce(sum(n), 0)::BIGINT AS duplicate_rows, coalesce(sum(n - 1), 0)::BIGINT AS removed_rows, count(*) FILTER (p = 1) AS identical_groups, count(*) FILTER (p > 1) AS conflicting_groups FROM g")
def dedup_metrics_found(spark, d):
    return dedup.metrics(raw(spark, d, "aed"), ["serialSeq"], ["wgs84Lat"])


# cleaning helpers that no other query covers


@query("culture", f"SELECT row_key, ({_text('g_text')}) IS NULL AS is_null FROM raw")
def null_mask(spark, d):
    return raw(spark, d, "culture").select("row_key", clean.null_token(F.col("g_text")).alias("is_null"))


@query(None, "SELECT event_id, strftime(ts - INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') AS instant FROM events")
def utc_instants(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    return e.select("event_id", F.date_format(clean.instant(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+09:00"))), "yyyy-MM-dd HH:mm:ss").alias("instant"))


@query("open", f"SELECT openFcltyNm, coalesce(trim(CASE WHEN rdnmadr = ' NULL ' THEN '' ELSE rdnmadr END), '') = '' OR coalesce(trim(lnmadr), '') = '' AS blank FROM raw")
def any_blank(spark, d):
    df = raw(spark, d, "open").withColumn("rdnmadr", clean.normalize(F.col("rdnmadr")))
    return df.select("openFcltyNm", clean.any_blank(["rdnmadr", "lnmadr"]).alias("blank"))


@query(None, "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_type ELSE split_part(p_name || ' > ' || p_brand, ' > ', 2) END AS filled FROM part")
def fill_blank_fields(spark, d):
    from sluice.operators.select import fill_blanks

    p = spark.read.parquet(f"{d}/part.parquet")
    df = p.select("p_partkey", F.when(F.col("p_partkey") % 3 == 0, F.col("p_type")).otherwise(" ").alias("filled"))
    offered = p.select("p_partkey", clean.last_segment(F.concat_ws(" > ", "p_name", "p_brand")).alias("filled"))
    return fill_blanks(df, offered, "p_partkey", ["filled"])


@query(None, "SELECT event_id, CASE WHEN value BETWEEN -90 AND 90 THEN value END AS degrees FROM events")
def coordinate_guard(spark, d):
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", clean.coordinate(F.col("value"), 90).alias("degrees"))


@query(None, """SELECT event_id, CASE event_id % 13 WHEN 0 THEN 'global_stop' WHEN 1 THEN 'transient' WHEN 2 THEN 'transient' WHEN 3 THEN 'permanent' WHEN 4 THEN 'permanent' WHEN 5 THEN 'empty' WHEN 6 THEN 'transient'
  WHEN 7 THEN 'unsupported' WHEN 8 THEN 'global_stop' WHEN 9 THEN 'ok' WHEN 10 THEN 'ok' WHEN 11 THEN 'permanent' ELSE 'global_stop' END AS answer FROM events""")
def answer_classes(spark, d):
    at = F.col("event_id") % 13
    pick = lambda *values: F.get(F.array(*map(F.lit, values)), at.cast("int"))
    status = pick(429, 429, 503, 404, 302, 200, 200, 200, 200, 200, 200, 200, 429)
    code = F.when(at == 11, None).otherwise(pick("00", "00", "00", "00", "00", "03", "99", "10", "31", "0", "0000", "", "00"))
    body = pick("LIMITED_NUMBER_OF_SERVICE_REQUESTS_EXCEEDS_ERROR", "slow down", *[""] * 10, '{"returnReasonCode":"22"}')
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", clean.status_class(status, code, body).alias("answer"))


@query(None, "SELECT event_id, event_id % 6 IN (0, 1, 4) AS retry FROM events")
def transient_errors(spark, d):
    said = F.get(F.array(*map(F.lit, ["HTTP 503 bad gateway", "Read TIMED OUT", "HTTP 429 LIMITED_NUMBER_OF_SERVICE_REQUESTS_EXCEEDS_ERROR", "row 503 is bad", "요청 최종 실패", "KeyError"])), (F.col("event_id") % 6).cast("int"))
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", runs.transient(said).alias("retry"))


# features


@query(None, "SELECT event_id, strftime(ts - INTERVAL 1 HOUR, '%Y%m%d%H') || '00' AS observed, CASE WHEN minute(ts) >= 45 THEN strftime(ts, '%Y%m%d%H') ELSE strftime(ts - INTERVAL 1 HOUR, '%Y%m%d%H') END || '30' AS forecast FROM events")
def base_times(spark, d):
    a, b = schedule.observation_base(F.col("ts")), schedule.forecast_base(F.col("ts"))
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", F.concat(*a).alias("observed"), F.concat(*b).alias("forecast"))


@query("weather", "SELECT _ingest_seq, strftime(strptime(baseDate || CASE WHEN _ingest_seq % 5 = 0 THEN NULL ELSE baseTime END, '%Y%m%d%H%M'), '%Y-%m-%d %H:%M') AS at FROM raw")
def weather_times(spark, d):
    clock = F.when(F.col(SEQ) % 5 == 0, "2460").otherwise(F.col("baseTime"))
    return raw(spark, d, "weather").select(SEQ, F.date_format(features.weather_time(F.col("baseDate"), clock), "yyyy-MM-dd HH:mm").alias("at"))


_AIR_NOW = "TIMESTAMP '2024-01-05 11:00:00'"


@query("air", f"""also r AS (SELECT {_region('sidoName')} AS region, stationName AS station, CASE WHEN dataTime <> '-' THEN strptime(dataTime, '%Y-%m-%d %H:%M') END AS measured, strptime(collected_at, '%Y-%m-%dT%H:%M:%S') - INTERVAL 4 DAY AS collected,
  {_num('pm10Value')} AS pm10, {_num('pm25Value')} AS pm25 FROM raw),
f AS (SELECT *, CASE WHEN measured IS NULL THEN 'UNKNOWN_MEASUREMENT_TIME' WHEN measured > {_AIR_NOW} OR collected > {_AIR_NOW} THEN 'FUTURE_DATA' END AS fault FROM r),
s AS (SELECT region, station, max(row(measured, collected, pm10, pm25)) FILTER (fault IS NULL) AS x FROM f GROUP BY ALL),
v AS (SELECT region, x IS NOT NULL AND date_diff('minute', x[1], {_AIR_NOW}) BETWEEN 0 AND 120 AS fresh, x[3] AS pm10, x[4] AS pm25 FROM s)
SELECT region, max(pm10) FILTER (fresh) AS pm10, max(pm25) FILTER (fresh) AS pm25, count(*) FILTER (fresh) AS stations,
  CASE WHEN max(pm10) FILTER (fresh) >= 81 OR max(pm25) FILTER (fresh) >= 36 THEN 'CAUTION' ELSE 'UNKNOWN' END AS air_state, CASE WHEN count(*) FILTER (fresh) > 0 THEN 'PARTIAL' ELSE 'STALE' END AS air_availability FROM v GROUP BY 1""")
def air_regions(spark, d):
    """Some readings of every region have no time, so no region is complete."""
    now = F.lit("2024-01-05 11:00:00").cast("timestamp_ntz")
    air = raw(spark, d, "air").withColumns({"dataTime": clean.moment(F.col("dataTime")), "collected_at": clean.moment(F.regexp_replace("collected_at", "T", " ")) - F.expr("INTERVAL 4 DAY")})
    return features.air_by_region(air, now, now).select("region", "pm10", "pm25", "stations", "air_state", "air_availability")


# Weather of seven cells from events, in minutes from now: of one everything is old, of one all valid times are far off, of one
# only temperatures are of use. Some rows are of the future, some have no time of capture. Both engines read this alike.
_WEATHER = """SELECT 55 + event_id % 7 AS nx, 127 AS ny, CASE event_id % 21 // 7 WHEN 0 THEN 'T1H' WHEN 1 THEN 'PTY' ELSE 'RN1' END AS category, event_id % 42 >= 21 OR event_id % 7 = 6 AS forecast,
  CASE event_id % 21 // 7 WHEN 0 THEN CAST(event_id % 45 AS STRING) WHEN 1 THEN CASE event_id % 7 WHEN 4 THEN '4' ELSE CAST(event_id % 5 AS STRING) END
    ELSE CASE WHEN event_id % 7 = 4 OR event_id % 5 = 2 THEN '1mm' WHEN event_id % 5 < 2 THEN '강수없음' ELSE CAST(event_id % 4 AS STRING) END END AS value,
  CASE event_id % 7 WHEN 6 THEN -5 - CAST(event_id * 13 % 150 AS INT) WHEN 5 THEN -200 - CAST(event_id * 13 % 400 AS INT) ELSE 10 - CAST(event_id * 13 % 400 AS INT) END AS issued,
  CAST(event_id * 29 % 300 AS INT) - 30 + CASE event_id % 7 WHEN 6 THEN 900 ELSE 0 END AS ahead, CASE WHEN event_id % 97 <> 0 THEN CAST(event_id % 3 AS INT) END AS delay FROM {t}"""


@query(None, f"""WITH w AS ({_WEATHER.format(t='events')}),
r AS (SELECT *, CASE WHEN forecast THEN issued + ahead ELSE issued END AS valid, issued + delay AS collected FROM w),
t AS (SELECT DISTINCT 55 + c_custkey % 8 AS nx, CAST(c_custkey % 100 AS INT) AS target FROM customer),
p AS (SELECT *, CASE WHEN collected IS NULL THEN 'INVALID_TIME' WHEN issued > 0 OR collected > 0 OR (NOT forecast AND valid > 0) THEN 'FUTURE_DATA' WHEN -issued > CASE WHEN forecast THEN 180 ELSE 90 END THEN 'STALE'
  WHEN CASE WHEN forecast THEN valid < issued OR abs(target - valid) > 60 ELSE NOT target - valid BETWEEN 0 AND 90 END THEN 'TIME_MISMATCH' END AS reason FROM t JOIN r USING (nx)),
b AS (SELECT * FROM p WHERE reason IS NULL QUALIFY row_number() OVER (PARTITION BY nx, target, category ORDER BY abs(target - valid), CASE WHEN target > 0 THEN NOT forecast ELSE forecast END, issued DESC, collected DESC, forecast, value) = 1),
c AS (SELECT nx, target, max(value) FILTER (category = 'T1H') AS t1h, max(value) FILTER (category = 'PTY') AS pty, max(value) FILTER (category = 'RN1') AS rn1, string_agg(CASE WHEN category = 'T1H' THEN CASE WHEN forecast THEN 'FORECAST' ELSE 'OBSERVATION' END END) AS kind FROM b GROUP BY ALL),
j AS (SELECT nx, target, array_to_string(list_sort(list(DISTINCT reason) FILTER (reason IS NOT NULL)), ',') AS reasons FROM p GROUP BY ALL),
v AS (SELECT c_custkey AS place, CAST(t1h AS DOUBLE) AS temperature, CASE WHEN rn1 = '강수없음' THEN 0.0 ELSE TRY_CAST(rn1 AS DOUBLE) END AS precipitation, CASE WHEN pty IN ('0', '1', '2', '3') THEN pty <> '0' END AS by_kind,
  coalesce(t1h, pty, rn1) IS NOT NULL AS any_chosen, kind, reasons FROM customer LEFT JOIN c ON c.nx = 55 + c_custkey % 8 AND c.target = c_custkey % 100 LEFT JOIN j ON j.nx = 55 + c_custkey % 8 AND j.target = c_custkey % 100),
x AS (SELECT *, CASE WHEN by_kind OR precipitation > 0 THEN true ELSE coalesce(by_kind, precipitation > 0) END AS wet FROM v)
SELECT place, temperature, precipitation, wet, kind, reasons, CASE WHEN NOT temperature BETWEEN 5 AND 30 OR wet THEN 'CAUTION' WHEN temperature IS NOT NULL AND NOT wet THEN 'FAVORABLE' ELSE 'UNKNOWN' END AS weather_state,
  CASE WHEN temperature IS NOT NULL AND wet IS NOT NULL THEN 'AVAILABLE' WHEN any_chosen THEN 'PARTIAL' WHEN contains(reasons, 'STALE') THEN 'STALE' WHEN contains(reasons, 'TIME_MISMATCH') THEN 'TIME_MISMATCH' ELSE 'MISSING' END AS weather_availability FROM x""")
def weather_of_places(spark, d):
    """All components of both kinds for every place; every availability occurs."""
    now = F.lit("2024-01-10 12:00:00").cast("timestamp_ntz")
    w = spark.sql(_WEATHER.replace("//", "div"), t=spark.read.parquet(f"{d}/events.parquet"))
    at = lambda m: now + F.make_dt_interval(mins=m)
    valid = F.col("issued") + F.when(F.col("forecast"), F.col("ahead")).otherwise(0)
    w = w.select("nx", "ny", "category", F.when(F.col("forecast"), "FORECAST").otherwise("OBSERVATION").alias("kind"), "value", at(F.col("issued")).alias("issued"), at(valid).alias("valid"), at(F.col("issued") + F.col("delay")).alias("collected"))
    k = F.col("c_custkey")
    places = spark.read.parquet(f"{d}/customer.parquet").select(k.alias("place"), F.struct((55 + k % 8).alias("nx"), F.lit(127).cast("long").alias("ny")).alias("grid"), at((k % 100).cast("int")).alias("target"))
    chosen = places.select("place").join(features.choose_weather(places, w, "place", now), "place", "left")
    out = features.weather_features(chosen, F.lit(True))
    return out.select("place", "temperature", "precipitation", "wet", F.col("t1h.kind").alias("kind"), F.array_join("rejected", ",").alias("reasons"), "weather_state", "weather_availability")


# Readings of a network from events, in minutes from now; some have no time, one region only old ones.
_READINGS = """SELECT CASE event_id % 4 WHEN 0 THEN '서울' WHEN 1 THEN '부산' WHEN 2 THEN '전라북도' ELSE '강원도' END AS sidoName, 'S' || CAST(event_id % 12 // 4 AS STRING) AS stationName,
  CASE WHEN event_id % 4 = 3 AND event_id % 24 < 8 THEN NULL ELSE -CAST(event_id * 17 % 500 AS INT) - CASE event_id % 4 WHEN 2 THEN 400 ELSE 0 END - CASE WHEN event_id % 12 // 4 = 1 THEN 60 ELSE 0 END END AS measured,
  CAST(event_id % 5 AS INT) AS delay, CASE WHEN event_id % 31 = 0 THEN '-' ELSE CAST(event_id % 110 AS STRING) END AS pm10Value, CAST(event_id % 45 AS STRING) AS pm25Value FROM {t}"""


@query(None, f"""WITH r AS (SELECT {_region('sidoName')} AS region, stationName AS station, measured, measured + delay AS collected, TRY_CAST(pm10Value AS DOUBLE) AS pm10, CAST(pm25Value AS DOUBLE) AS pm25 FROM ({_READINGS.format(t='events')})),
f AS (SELECT *, CASE WHEN measured IS NULL THEN 'UNKNOWN_MEASUREMENT_TIME' WHEN measured > 0 OR collected > 0 THEN 'FUTURE_DATA' END AS fault FROM r),
s AS (SELECT region, station, arg_max(row(measured, collected, pm10, pm25), row(measured, collected, coalesce(pm10, -1), coalesce(pm25, -1))) FILTER (fault IS NULL) AS x, list(DISTINCT fault) FILTER (fault IS NOT NULL) AS faults FROM f GROUP BY ALL),
p AS (SELECT c_custkey AS place, CASE c_custkey % 5 WHEN 0 THEN '서울특별시' WHEN 1 THEN '부산광역시' WHEN 2 THEN '전북특별자치도' WHEN 3 THEN '강원특별자치도' ELSE '제주특별자치도' END AS region, CASE WHEN c_custkey % 3 = 0 THEN 'S' || CAST(c_custkey % 4 AS VARCHAR) END AS station, c_custkey % 130 AS target FROM customer),
q AS (SELECT p.place, p.station IS NOT NULL AS verified, x IS NOT NULL AND target - x[1] <= 120 AS fresh, x IS NOT NULL AND target - x[1] > 120 AS stale, x[3] AS pm10, x[4] AS pm25, faults FROM p JOIN s ON s.region = p.region AND (p.station IS NULL OR p.station = s.station)),
a AS (SELECT place, max(pm10) FILTER (fresh) AS pm10, max(pm25) FILTER (fresh) AS pm25, count(*) FILTER (fresh) AS stations, bool_and(pm10 IS NOT NULL AND pm25 IS NOT NULL) FILTER (fresh) AS complete, bool_or(stale) AS stale, list_distinct(flatten(list(coalesce(faults, [])))) AS faults FROM q GROUP BY 1),
z AS (SELECT *, array_to_string(list_sort(CASE WHEN stale THEN list_append(faults, 'STALE') ELSE faults END), ',') AS reasons FROM a),
y AS (SELECT *, stations > 0 AND complete AND reasons = '' AS whole FROM z)
SELECT p.place, pm10, pm25, stations, reasons, CASE WHEN pm10 >= 81 OR pm25 >= 36 THEN 'CAUTION' WHEN whole THEN 'FAVORABLE' ELSE 'UNKNOWN' END AS air_state,
  CASE WHEN whole THEN 'AVAILABLE' WHEN stations > 0 THEN 'PARTIAL' WHEN contains(reasons, 'STALE') THEN 'STALE' ELSE 'MISSING' END AS air_availability, CASE WHEN p.station IS NOT NULL THEN 'VERIFIED_STATION' ELSE 'REGIONAL_PROXY' END AS air_scope
FROM y JOIN p USING (place)""")
def air_of_places(spark, d):
    """Air at every place's own region, verified station and time of arrival."""
    now = F.lit("2024-01-10 12:00:00").cast("timestamp_ntz")
    at = lambda m: now + F.make_dt_interval(mins=m)
    air = spark.sql(_READINGS.replace("//", "div"), t=spark.read.parquet(f"{d}/events.parquet"))
    air = air.withColumns({"dataTime": at(F.col("measured")), "collected_at": at(F.col("measured") + F.col("delay"))})
    k = F.col("c_custkey")
    region = F.get(F.array(*map(F.lit, ["서울특별시", "부산광역시", "전북특별자치도", "강원특별자치도", "제주특별자치도"])), (k % 5).cast("int"))
    places = spark.read.parquet(f"{d}/customer.parquet").select(k.alias("place"), region.alias("region"), F.when(k % 3 == 0, F.concat(F.lit("S"), (k % 4).cast("string"))).alias("station"), at((k % 130).cast("int")).alias("target"))
    found = features.air_at_targets(places, air, now)
    found = found.select(*[F.col(c).alias(f"_{c}") for c in ("region", "station", "target")], "pm10", "pm25", "stations", F.array_join("air_rejected", ",").alias("reasons"), "air_state", "air_availability", "air_scope")
    same = (F.col("region") == F.col("_region")) & F.col("station").eqNullSafe(F.col("_station")) & (F.col("target") == F.col("_target"))
    return places.join(found, same).select("place", "pm10", "pm25", "stations", "reasons", "air_state", "air_availability", "air_scope")


_CANDIDATES = f"""c AS (SELECT 'processed.facility' AS source_table, nullif(faci_cd, '-') AS code, faci_nm AS facility_name, '운동 시설' AS facility_type, CASE WHEN abs({_num('faci_lat')}) <= 90 THEN {_num('faci_lat')} END AS latitude, CASE _ingest_seq % 3 WHEN 0 THEN 'INDOOR' WHEN 1 THEN 'OUTDOOR' END AS exposure,
  CASE _ingest_seq % 4 WHEN 0 THEN '서울' WHEN 1 THEN '부산' WHEN 2 THEN '강원도' ELSE '' END AS city FROM raw
UNION ALL SELECT 'processed.public_open_facility', NULL, s_name, 'hall', CAST(30 + s_suppkey % 12 AS DOUBLE), NULL, CASE s_suppkey % 3 WHEN 0 THEN '전라북도' WHEN 1 THEN '강원도' ELSE '해외' END FROM supplier)"""


def _candidate_sources(spark, d):
    """Every row of both sources, with the columns that candidates are made of."""
    df = clean.normalize_nulls(raw(spark, d, "facility")).withColumn("inout_gbn_nm", F.when(F.col(SEQ) % 3 == 0, "실내").when(F.col(SEQ) % 3 == 1, "실외"))
    for c in ("ftype_nm", "fcob_nm", "faci_road_addr", "faci_addr", "cpb_nm"):
        df = df.withColumn(c, F.lit("").cast("string"))
    pick = lambda n, *names: F.get(F.array(*map(F.lit, names)), (F.col(SEQ) % n).cast("int"))
    df = df.withColumn("cp_nm", pick(4, "서울", "부산", "강원도", ""))
    return df, raw(spark, d, "open").withColumns({"openFcltyType": F.lit("hall"), "sido_standard": pick(3, "전라북도", "강원도", "해외"), "weekdayOperOpenHhmm": F.lit("09:00"), "weekdayOperColseHhmm": F.lit("18:00"), "rstde": F.lit("연중무휴")})


@query("facility", f"also {_CANDIDATES} SELECT source_table, code, facility_name, facility_type, latitude, exposure FROM c")
def place_candidates(spark, d):
    """All rows of both sources."""
    out = features.candidates(*_candidate_sources(spark, d), F.lit("2024-01-01").cast("timestamp"))
    code = F.get_json_object("source_row", "$.faci_cd")
    return out.select("source_table", code.alias("code"), "facility_name", "facility_type", "latitude", "exposure")


@query("facility", f"""also {_CANDIDATES}, r AS (SELECT {_region('sidoName')} AS region, stationName AS station, measured, measured + delay AS collected, TRY_CAST(pm10Value AS DOUBLE) AS pm10, CAST(pm25Value AS DOUBLE) AS pm25 FROM ({_READINGS.format(t='events')}) WHERE measured + delay BETWEEN -180 AND 0),
s AS (SELECT region, station, arg_max(row(measured, pm10, pm25), row(measured, collected, coalesce(pm10, -1), coalesce(pm25, -1))) FILTER (measured <= 0) AS x, bool_or(measured > 0) AS future FROM r GROUP BY ALL),
a AS (SELECT region, max(x[2]) FILTER (x[1] >= -120) AS pm10, max(x[3]) FILTER (x[1] >= -120) AS pm25, count(*) FILTER (x[1] >= -120) AS stations, bool_and(x[2] IS NOT NULL) FILTER (x[1] >= -120) AS complete, bool_or(x[1] < -120) AS stale, bool_or(future) AS future FROM s GROUP BY 1),
y AS (SELECT *, stations > 0 AND complete AND NOT coalesce(stale, false) AND NOT future AS whole FROM a),
z AS (SELECT c.*, pm10, pm25, CASE WHEN {_region('city')} NOT IN ('서울특별시', '부산광역시', '강원특별자치도', '전북특별자치도') THEN 'UNLINKED' WHEN y.region IS NULL THEN 'MISSING' WHEN whole THEN 'AVAILABLE' WHEN stations > 0 THEN 'PARTIAL' WHEN stale THEN 'STALE' ELSE 'MISSING' END AS air,
  CASE WHEN pm10 >= 81 OR pm25 >= 36 THEN 'CAUTION' WHEN whole THEN 'FAVORABLE' ELSE 'UNKNOWN' END AS air_state FROM c LEFT JOIN y ON y.region = {_region('city')})
SELECT source_table, code, facility_name, pm10, pm25, air, air_state, CASE exposure WHEN 'INDOOR' THEN 'NOT_APPLICABLE' WHEN 'OUTDOOR' THEN CASE WHEN air_state = 'CAUTION' THEN 'CAUTION' ELSE 'UNKNOWN' END ELSE 'UNKNOWN' END AS outdoor,
  CASE WHEN source_table = 'processed.facility' THEN 'UNKNOWN' ELSE 'OPEN' END AS hours FROM z""")
def candidate_features(spark, d):
    """The stored features of every candidate, read from their JSON; no weather was collected within the limits."""
    now = F.lit("2024-01-10 12:00:00").cast("timestamp_ntz")
    at = lambda m: now + F.make_dt_interval(mins=m)
    air = spark.sql(_READINGS.replace("//", "div"), t=spark.read.parquet(f"{d}/events.parquet"))
    air = air.withColumns({"dataTime": at(F.col("measured")), "collected_at": at(F.col("measured") + F.col("delay"))})
    none = lambda schema: spark.createDataFrame([], schema)
    grid = "nx long, ny long, category string, baseDate string, baseTime string, collected_at string, "
    environment = features.read_environment(none(grid + "obsrValue string"), none(grid + "fcstDate string, fcstTime string, fcstValue string"), air, now)
    out = features.candidates(*_candidate_sources(spark, d), now, environment)
    told = lambda path, kind="string": F.get_json_object("features", f"$.{path}").cast(kind)
    code = F.get_json_object("source_row", "$.faci_cd").alias("code")
    hours = F.when(told("feasibility.open_now", "boolean"), "OPEN").otherwise("UNKNOWN").alias("hours")
    return out.select("source_table", code, "facility_name", told("pm10", "double").alias("pm10"), told("pm25", "double").alias("pm25"), told("air_availability").alias("air"), told("air_state").alias("air_state"), told("outdoor_suitability").alias("outdoor"), hours)


_ROUND = """SELECT * EXCLUDE (ll, ss, cs, sg, sa, ca, cm, k), l0 + (1 - k) * f * sa * (sg + k * ss * (cm + k * cs * (2 * cm * cm - 1))) AS ll, ss, cs, sg, sa, ca, cm, k FROM (SELECT * EXCLUDE (k, cm), cs - 2 * s1 * s2 / ca AS cm, f / 16 * ca * (4 + f * (4 - 3 * ca)) AS k FROM
  (SELECT * EXCLUDE (sa, ca, sg), atan2(ss, cs) AS sg, c1 * c2 * sin(ll) / ss AS sa, 1 - pow(c1 * c2 * sin(ll) / ss, 2) AS ca FROM (SELECT * EXCLUDE (ss, cs), sqrt(pow(c2 * sin(ll), 2) + pow(c1 * s2 - s1 * c2 * cos(ll), 2)) AS ss, s1 * s2 + c1 * c2 * cos(ll) AS cs FROM {x})))"""


@query(None, f"""WITH p AS (SELECT c_name, 33 + c_custkey % 600 / 100.0::DOUBLE AS lat, 125 + c_custkey % 500 / 100.0::DOUBLE AS lon, 1 / 298.257223563 AS f FROM customer),
u AS (SELECT *, atan((1 - f) * tan(radians(37.5))) AS u1, atan((1 - f) * tan(radians(lat))) AS u2, radians(lon - 127.0) AS l0 FROM p WHERE NOT (lat = 37.5 AND lon = 127.0)),
r0 AS (SELECT *, sin(u1) AS s1, cos(u1) AS c1, sin(u2) AS s2, cos(u2) AS c2, l0 AS ll, 0.0::DOUBLE AS ss, 0.0::DOUBLE AS cs, 0.0::DOUBLE AS sg, 0.0::DOUBLE AS sa, 0.0::DOUBLE AS ca, 0.0::DOUBLE AS cm, 0.0::DOUBLE AS k FROM u),
{", ".join(f"r{i + 1} AS ({_ROUND.format(x=f'r{i}')})" for i in range(6))},
e AS (SELECT *, ca * (pow(6378137.0, 2) / pow(6378137.0 * (1 - f), 2) - 1) AS q FROM r6),
m AS (SELECT *, 1 + q / 16384 * (4096 + q * (-768 + q * (320 - 175 * q))) AS a, q / 1024 * (256 + q * (-128 + q * (74 - 47 * q))) AS b FROM e),
d AS (SELECT c_name, 6378.137 * (1 - f) * a * (sg - b * ss * (cm + b / 4 * (cs * (2 * cm * cm - 1) - b / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))) AS km FROM m UNION ALL SELECT c_name, 0 FROM p WHERE lat = 37.5 AND lon = 127.0)
SELECT c_name AS facility_name, round(km, 6) AS km FROM d ORDER BY km, facility_name LIMIT 25""")
def nearest_places(spark, d):
    """The nearest by the way on the ellipsoid, to the millimetre."""
    k = F.col("c_custkey")
    df = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_name").alias("facility_name"), (33 + k % 600 / 100).alias("latitude"), (125 + k % 500 / 100).alias("longitude"), F.lit("").alias("source_key"))
    return features.nearest_facilities(df, 37.5, 127.0, 25).select("facility_name", F.round("distance_km", 6).alias("km"))


@query(None, """WITH e AS (SELECT event_id, date_trunc('second', ts) AS now, date_trunc('day', ts) AS day, 540 + (event_id % 4) * 60 AS a, (1080 + (event_id % 6) * 120) % 1440 AS b, (event_id % 500) * 6000 AS travel FROM events),
i AS (SELECT *, day + to_minutes(a) AS s0, day + to_minutes(CASE WHEN b < a THEN b + 1440 ELSE b END) AS e0, day - INTERVAL 1 DAY + to_minutes(CASE WHEN b < a THEN b + 1440 ELSE b END) AS e1, day - INTERVAL 1 DAY + to_minutes(a) AS s1 FROM e),
o AS (SELECT *, now >= s1 AND now < e1 AS ran, now >= s0 AND now < e0 AS running FROM i),
u AS (SELECT *, ran OR running AS is_open, (date_diff('millisecond', now, CASE WHEN ran THEN e1 ELSE e0 END) - travel) / 60000.0 AS usable FROM o)
SELECT event_id, CASE WHEN NOT is_open THEN 'CLOSED' WHEN greatest(0, usable) < 30 THEN 'TOO_LATE' ELSE 'AVAILABLE' END AS state, CASE WHEN is_open THEN round(greatest(0, usable), 3) END AS usable FROM u""")
def schedule_over_midnight(spark, d):
    k = F.col("event_id")
    text_of = lambda m: F.concat(F.lpad(F.floor(m / 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((m % 60).cast("string"), 2, "0"))
    a, b = text_of(540 + k % 4 * 60), text_of((1080 + k % 6 * 120) % 1440)
    hours = {"week_open": a, "week_close": b, "weekend_open": a, "weekend_close": b}
    e = spark.read.parquet(f"{d}/events.parquet").withColumn("ts", F.date_trunc("second", "ts").cast("timestamp_ntz"))
    e = schedule.add_feasibility(e, F.col("ts"), (k % 500) / 10, F.lit("연중무휴"), hours)
    return e.select("event_id", "feasibility.state", F.round("feasibility.usable", 3).alias("usable"))


@query(None, """SELECT event_id, CASE event_id % 6 WHEN 0 THEN false WHEN 1 THEN isodow(ts) = 1 WHEN 2 THEN isodow(ts) >= 6 WHEN 3 THEN isodow(ts) = 3 OR NULL WHEN 4 THEN NULL ELSE isodow(ts) IN (2, 4) END AS closed FROM events""")
def closing_days(spark, d):
    rule = F.get(F.array(*map(F.lit, ["연중무휴", "월요일", "주말", "수, 공휴일", "모름", "화+목"])), (F.col("event_id") % 6).cast("int"))
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", schedule.closed_on(rule, F.col("ts").cast("date")).alias("closed"))


# publication, sources and streams, through the shared scratch folder


@query("aed", "SELECT serialSeq, max(_ingest_seq) AS _ingest_seq FROM raw WHERE serialSeq IS NOT NULL GROUP BY 1")
def warehouse_upserts(spark, d):
    """Two batches and a replay of the first half of keys; the later row of a key wins."""
    w, key = Warehouse(spark, scratch(spark, "warehouse")), {"aed": ["serialSeq"]}
    df = raw(spark, d, "aed").where("serialSeq is not null").select("serialSeq", SEQ)
    low = df.where(f"{SEQ} <= 20")
    w.upsert("aed", {"aed": low}, key, order=SEQ)
    w.upsert("aed", {"aed": df}, key, order=SEQ)
    return w.read("aed", "aed")


@query("aed", f"""also v AS (SELECT * FROM raw WHERE {_box(_num('wgs84Lat'), _num('wgs84Lon'))} QUALIFY serialSeq IS NULL OR row_number() OVER (PARTITION BY serialSeq ORDER BY _ingest_seq DESC) = 1)
SELECT 'SUCCESS' AS run_status, 'PASSED' AS dq_status, NULL AS failure_stage, (SELECT count(*) FROM v) AS rows UNION ALL SELECT 'FAILED', NULL, 'process', NULL""")
def dataset_job(spark, d):
    """A job from RAW to the published table, and one whose RAW table is empty: both are in the history."""
    from sluice.plans.job import run_job
    from sluice.plans.publish import HISTORY
    from sluice.plans.specs import Catalog

    w, spec = Warehouse(spark, scratch(spark, "job")), next(s for s in Catalog().datasets() if s.name == "aed")
    df = raw(spark, d, "aed")
    run_job(spec, lambda _: df, w)
    try:
        run_job(spec, lambda _: df.limit(0), w)
    except ValueError:
        pass
    history = w.read("monitoring", "run_history", HISTORY)
    published = F.get_json_object("results", "$.aed.rows").cast("long")
    return history.select("run_status", "dq_status", "failure_stage", published.alias("rows"))


@query("facility", "SELECT faci_cd, faci_nm, _ingest_seq FROM raw WHERE _ingest_seq % 2 = 0")
def warehouse_replaces(spark, d):
    """A snapshot replaced by another, copied to a second warehouse."""
    w, other = Warehouse(spark, scratch(spark, "warehouse")), Warehouse(spark, scratch(spark, "copy"))
    df = raw(spark, d, "facility").select("faci_cd", "faci_nm", SEQ)
    w.replace("facility", {"facility": df})
    w.replace("facility", {"facility": df.where(f"{SEQ} % 2 = 0")}, primary_keys={"facility": [SEQ]})
    w.copy_to(other, "facility")
    return other.read("facility", "facility")


@query("culture", "SELECT row_key, g_text, nullif(g_lon, '') AS g_lon FROM raw")
def csv_round_trip(spark, d):
    path = scratch(spark, "csv")
    raw(spark, d, "culture").select("row_key", "g_text", "g_lon").write.csv(path, header=True, escape="\\", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return files.read_csv(spark, path)


@query("culture", "SELECT row_key, CASE WHEN _ingest_seq % 3 = 0 THEN g_text ELSE g_text || chr(10) || 'more' END AS g_text, CASE WHEN _ingest_seq % 3 = 0 THEN 2 ELSE 1 END AS batch FROM raw")
def csv_places(spark, d):
    """Three folders of files of unlike size, of which one has line breaks in its fields; the last row of a key is that of the last file."""
    path, rows = scratch(spark, "csv-places"), raw(spark, d, "culture")
    text = F.concat("g_text", F.lit("\nmore"))
    for i, part in enumerate((rows.withColumn("g_text", F.lit("old")), rows.withColumn("g_text", text), rows.where(f"{SEQ} % 3 = 0"))):
        out = part.select("row_key", "g_text", F.lit(i).cast("string").alias("batch"))
        out.repartition(1 + i, "row_key").write.csv(f"{path}/{i}", header=True, escape="\\", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    found = files.read_csv(spark, f"{path}/*", sequence=True)
    return dedup.keep_last(found, ["row_key"], [F.col(SEQ)]).select("row_key", "g_text", F.col("batch").cast("int").alias("batch"))


@query(None, "SELECT n_regionkey AS scope, n_name AS name, n_nationkey AS code, (count(*) OVER (PARTITION BY n_regionkey))::BIGINT AS total FROM nation")
def json_envelopes(spark, d):
    n = spark.read.parquet(f"{d}/nation.parquet")
    item = F.struct(F.col("n_name").alias("name"), F.col("n_nationkey").alias("code"))
    body = n.groupBy("n_regionkey").agg(F.collect_list(item).alias("item"), F.count("*").alias("n"))
    nested = F.to_json(F.struct(F.struct(F.struct(F.struct("item").alias("items"), F.col("n").alias("totalCount")).alias("body")).alias("response")))
    flat = F.to_json(F.struct(F.struct("item").alias("items"), F.col("n").alias("totalCount")))
    answers = body.select("n_regionkey", F.when(F.col("n_regionkey") % 2 == 0, nested).otherwise(flat).alias("answer"))
    rows = files.envelope_items(answers, "answer", "struct<name:string,code:int>")
    return rows.select(F.col("n_regionkey").alias("scope"), "name", "code", F.col("_total").alias("total"))


@query(None, "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY event_id % 500 ORDER BY event_id DESC) = 1) GROUP BY 1")
def stream_upsert(spark, d):
    """Batches of files are read as a stream and merged by key; the second stream finds nothing new to do."""
    source, state = scratch(spark, "stream-source"), scratch(spark, "stream-state")
    e = spark.read.parquet(f"{d}/events.parquet").select((F.col("event_id") % 500).alias("key"), "event_id", "event_type", "value")
    e.repartition(3).write.parquet(source)
    w = Warehouse(spark, scratch(spark, "warehouse"))
    for _ in range(2):
        stream = spark.readStream.schema(e.schema).parquet(source)
        upsert_stream(stream, w, "events", "events", ["key"], state, "event_id").awaitTermination()
    return w.read("events", "events").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


def _streamed(spark, d, label, transform):
    """The rows that a stream of ``events`` appends; all of them are one batch, so their order is of no account."""
    source, sink, state = (scratch(spark, f"{label}-{k}") for k in ("source", "sink", "state"))
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), "value")
    last = e.agg(F.date_add(F.max("ts").cast("date"), 30).cast("timestamp").alias("ts")).select(F.lit(-1).cast("long").alias("event_id"), F.lit(-1).cast("long").alias("user_id"), F.lit("end").alias("event_type"), "ts", F.lit(0.0).alias("value"))
    e.write.parquet(source)
    for part in (None, last):  # the second batch moves the watermark past all windows
        if part is not None:
            part.select(*[F.col(f.name).cast(f.dataType) for f in e.schema]).write.mode("append").parquet(source)
        out = transform(spark.readStream.schema(e.schema).parquet(source))
        out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(sink)


@query(None, "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def stream_windows(spark, d):
    out = _streamed(spark, d, "windows", lambda s: windowed_counts(s, "ts", ["event_type"])).where("event_type <> 'end'")
    return out.select(F.date_format("start", "yyyy-MM-dd HH").alias("hour"), "event_type", "n", F.round("total", 4).alias("total"))


@query(None, "SELECT DISTINCT user_id, event_type FROM events")
def stream_first_arrivals(spark, d):
    return _streamed(spark, d, "first", lambda s: insert_only(s, ["user_id", "event_type"], "ts", "60 days")).where("event_type <> 'end'").select("user_id", "event_type")


@query(None, "SELECT n_nationkey, n_name, (row_number() OVER (ORDER BY n_name, n_nationkey))::BIGINT AS id FROM nation")
def surrogate_keys(spark, d):
    return ranges.with_surrogate(spark.read.parquet(f"{d}/nation.parquet").select("n_nationkey", "n_name"), ["n_name", "n_nationkey"], "id")


@query(None, "SELECT *, row_number() OVER (ORDER BY l_shipdate, l_extendedprice, l_orderkey, l_linenumber) AS id FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_returnflag, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate FROM lineitem)")
def surrogate_lines(spark, d):
    """Every row of the largest table with all its payload, in an order whose first columns repeat often."""
    lines = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", F.col("l_shipdate").cast("date").cast("string").alias("l_shipdate"))
    return ranges.with_surrogate(lines, ["l_shipdate", "l_extendedprice", "l_orderkey", "l_linenumber"], "id")
