"""The registered queries: each operator on the provided tables, beside the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions import clean, geo, schedule, text
from sluice.operators import dedup, lineage, profile, ranges, runs, select, terms
from sluice.plans.publish import Warehouse, merge, scratch
from sluice.sources import files
from sluice.plans import dataset_queries
from sluice.streaming.upsert import upsert_stream

QUERIES: dict = dict(dataset_queries.QUERIES)
SQL: dict[str, str] = dict(dataset_queries.SQL)


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# Expressions that make unclean text of clean columns, written alike on both sides.


def _mark() -> Column:
    return F.when(F.col("event_id") % 7 == 0, " NULL ").when(F.col("event_id") % 11 == 0, "-").when(F.col("event_id") % 13 == 0, "").otherwise(F.concat(F.lit("  "), F.col("event_type"), F.lit(" ")))


_MARK_SQL = "CASE WHEN event_id % 7 = 0 THEN ' NULL ' WHEN event_id % 11 = 0 THEN '-' WHEN event_id % 13 = 0 THEN '' ELSE '  ' || event_type || ' ' END"


def _num() -> Column:
    key = F.get_json_object("props", "$.k")
    return F.when(F.col("event_id") % 5 == 0, F.concat(key, F.lit(".5"))).when(F.col("event_id") % 9 == 0, F.lit("1,234")).when(F.col("event_id") % 8 == 0, F.lit("12abc")).when(F.col("event_id") % 17 == 0, F.lit("nan")).otherwise(key)


_NUM_SQL = "CASE WHEN event_id % 5 = 0 THEN json_extract_string(props, '$.k') || '.5' WHEN event_id % 9 = 0 THEN '1,234' WHEN event_id % 8 = 0 THEN '12abc' WHEN event_id % 17 = 0 THEN 'nan' ELSE json_extract_string(props, '$.k') END"
_CLEAN_SQL = r"CASE WHEN regexp_matches(replace({0}, ',', ''), '^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$') THEN TRY_CAST(replace({0}, ',', '') AS DOUBLE) END"


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem WHERE l_quantity > 45 AND l_discount < 0.02")
def scan_project_filter(spark, d):
    return t(spark, d, "lineitem").where("l_quantity > 45 and l_discount < 0.02").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")


@query("SELECT event_id, user_id FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-05 12:00:00'")
def time_range_scan(spark, d):
    return t(spark, d, "events").where("ts between timestamp_ntz '2024-01-05 00:00:00' and timestamp_ntz '2024-01-05 12:00:00'").select("event_id", "user_id")


@query(f"WITH r AS (SELECT event_id, {_MARK_SQL} AS raw FROM events) SELECT event_id, CASE WHEN lower(trim(raw)) NOT IN ('', '-', '--', 'null', 'none', 'n/a', 'na', 'nan') THEN trim(raw) END AS cleaned FROM r")
def normalize_nulls(spark, d):
    return clean.normalize_nulls(t(spark, d, "events").select("event_id", _mark().alias("cleaned")))


@query(f"WITH r AS (SELECT event_id, {_NUM_SQL} AS raw FROM events), n AS (SELECT *, {_CLEAN_SQL.format('raw')} AS as_double FROM r) SELECT event_id, as_double, CASE WHEN as_double % 1 = 0 THEN CAST(as_double AS BIGINT) END AS as_long FROM n")
def safe_numeric(spark, d):
    return t(spark, d, "events").select("event_id", clean.number(_num()).alias("as_double"), clean.integer(_num()).alias("as_long"))


@query("""
WITH r AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y%m%d') WHEN 1 THEN strftime(o_orderdate, '%Y%m%d%H%M')
  WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 3 THEN '20150400' WHEN 4 THEN '00000101' ELSE '123' END AS raw FROM orders)
SELECT o_orderkey, CAST(CASE o_orderkey % 6 WHEN 0 THEN TRY_STRPTIME(raw, '%Y%m%d') WHEN 1 THEN TRY_STRPTIME(raw, '%Y%m%d%H%M') WHEN 2 THEN TRY_STRPTIME(raw, '%Y-%m-%d') END AS VARCHAR) AS moment FROM r
""")
def safe_datetime(spark, d):
    k, at = F.col("o_orderkey") % 6, lambda fmt: F.date_format("o_orderdate", fmt)
    raw = F.when(k == 0, at("yyyyMMdd")).when(k == 1, at("yyyyMMddHHmm")).when(k == 2, at("yyyy-MM-dd")).when(k == 3, "20150400").when(k == 4, "00000101").otherwise("123")
    return t(spark, d, "orders").select("o_orderkey", F.date_format(clean.moment(raw), "yyyy-MM-dd HH:mm:ss").alias("moment"))


@query("SELECT d.doc_id, l.quality IS NULL OR l.toxic IS NULL AS needs_review FROM documents d LEFT JOIN labels l USING (doc_id)")
def needs_review(spark, d):
    df = t(spark, d, "documents").select("doc_id").join(t(spark, d, "labels"), "doc_id", "left")
    return df.select("doc_id", clean.any_null(df, ["quality", "toxic", "absent"]).alias("needs_review"))


@query("WITH r AS (SELECT CASE WHEN event_id % 3 = 0 THEN NULL ELSE ' - ' END AS nothing, CASE WHEN event_id = 17 THEN 'x' ELSE 'NULL' END AS something, CASE WHEN event_id < 0 THEN props END AS never FROM events), n AS (SELECT 'nothing' AS dropped, count(*) FILTER (trim(nothing) <> '-') AS n FROM r UNION ALL SELECT 'something', count(*) FILTER (something <> 'NULL') FROM r UNION ALL SELECT 'never', count(never) FROM r) SELECT dropped FROM n WHERE n = 0")
def fully_empty_columns(spark, d):
    k = F.col("event_id")
    raw = t(spark, d, "events").select("event_id", F.when(k % 3 != 0, " - ").alias("nothing"), F.when(k == 17, "x").otherwise("NULL").alias("something"), F.when(k < 0, F.col("props")).alias("never"))
    return spark.createDataFrame([(c,) for c in clean.empty_columns(raw, clean.normalize_nulls(raw))], "dropped string")


@query("SELECT n_nationkey, CASE n_name WHEN 'NATION_1' THEN 'first' WHEN 'NATION_2' THEN 'second' ELSE n_name END AS standard, CASE n_name WHEN 'NATION_1' THEN 'first' WHEN 'NATION_2' THEN 'second' END AS known FROM nation")
def map_standardize(spark, d):
    names = {"NATION_1": "first", "NATION_2": "second"}
    return t(spark, d, "nation").select("n_nationkey", clean.mapped(F.col("n_name"), names).alias("standard"), clean.mapped(F.col("n_name"), names, strict=True).alias("known"))


_PLACE = f"(SELECT c_custkey, CAST(CASE WHEN c_custkey % 10 <> 0 THEN 32 + c_custkey % 9 END AS DOUBLE) AS lat, CAST(CASE WHEN c_custkey % 15 <> 0 THEN 122 + c_custkey % 12 END AS DOUBLE) AS lon FROM customer)"


def _places(spark, d):
    lat, lon = F.when(F.col("c_custkey") % 10 != 0, 32 + F.col("c_custkey") % 9), F.when(F.col("c_custkey") % 15 != 0, 122 + F.col("c_custkey") % 12)
    return t(spark, d, "customer").select("c_custkey", lat.cast("double").alias("lat"), lon.cast("double").alias("lon"))


@query(f"SELECT * FROM {_PLACE} WHERE lat BETWEEN 33 AND 39.5 AND lon BETWEEN 124 AND 132")
def bbox_filter(spark, d):
    return _places(spark, d).where(clean.in_box(F.col("lat"), F.col("lon")))


@query(f"SELECT c_custkey, CASE WHEN NOT (lat BETWEEN 33 AND 39.5 AND lon BETWEEN 124 AND 132) THEN NULL ELSE lat END AS lat, CASE WHEN NOT (lat BETWEEN 33 AND 39.5 AND lon BETWEEN 124 AND 132) THEN NULL ELSE lon END AS lon FROM {_PLACE}")
def bbox_optional_null(spark, d):
    return clean.blank_pair(_places(spark, d), "lat", "lon")


@query("SELECT c_custkey, split_part(trim(coalesce(CASE WHEN c_custkey % 3 <> 0 THEN c_name || ' ' || c_mktsegment END, c_mktsegment || ' x')), ' ', 1) AS word FROM customer")
def first_token_coalesce(spark, d):
    first = F.when(F.col("c_custkey") % 3 != 0, F.concat_ws(" ", "c_name", "c_mktsegment"))
    return t(spark, d, "customer").select("c_custkey", clean.first_word(first, F.concat("c_mktsegment", F.lit(" x"))).alias("word"))


@query(f"WITH r AS (SELECT event_id, event_type, {_NUM_SQL} AS raw FROM events) SELECT event_id, CASE WHEN event_type = 'error' THEN raw ELSE CAST({_CLEAN_SQL.format('raw')} AS VARCHAR) END AS value FROM r")
def category_conditional_cast(spark, d):
    number = clean.number(_num()).cast("string")
    return t(spark, d, "events").select("event_id", F.when(clean.equals(F.col("event_type"), "error"), _num()).otherwise(number).alias("value"))


@query("SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN 'measured:' ELSE 'collected:' END || strftime(ts, '%Y-%m-%dT%H:%M:%S') AS observation_key FROM events")
def observation_key(spark, d):
    return t(spark, d, "events").select("event_id", clean.observation_key(F.when(F.col("event_id") % 4 != 0, F.col("ts")), F.col("ts")).alias("observation_key"))


_SHAPE_SQL = """CASE event_id % 5 WHEN 0 THEN '{"type": "Point", "coordinates": [1, 2]}' WHEN 1 THEN '{"type": "Polygon", "coordinates": [[[1, 2]]]}' WHEN 2 THEN '{"type": "MultiPolygon", "coordinates": []}' WHEN 3 THEN '{"coordinates": [1], "type": "MultiPolygon"}' ELSE '{broken' END"""


@query(f"WITH s AS (SELECT event_id, {_SHAPE_SQL} AS shape FROM events) SELECT event_id, CASE WHEN json_valid(shape) THEN coalesce(json_extract_string(shape, '$.type') IN ('Polygon', 'MultiPolygon') AND json_array_length(shape, '$.coordinates') > 0, false) ELSE false END AS valid FROM s")
def json_validate(spark, d):
    return t(spark, d, "events").select("event_id", clean.area_json(F.expr(_SHAPE_SQL)).isNotNull().alias("valid"))


@query("SELECT event_id, user_id, event_type, CAST(ts AS DATE)::VARCHAR AS day FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY event_id DESC) = 1")
def dedup_keep_last(spark, d):
    df = t(spark, d, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("date").cast("string").alias("day"))
    return dedup.keep_last(df, ["user_id", "event_type", "day"], [F.col("event_id")], null_keys="group")


@query("WITH e AS (SELECT event_id, CASE WHEN event_id % 6 <> 0 THEN user_id END AS user_id, event_type FROM events) SELECT * FROM e WHERE user_id IS NULL UNION ALL (SELECT * FROM e WHERE user_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1)")
def dedup_null_key_passthrough(spark, d):
    df = t(spark, d, "events").select("event_id", F.when(F.col("event_id") % 6 != 0, F.col("user_id")).alias("user_id"), "event_type")
    return dedup.keep_last(df, ["user_id", "event_type"], [F.col("event_id")])


@query("WITH g AS (SELECT count(*) AS n, count(DISTINCT (l_partkey, l_quantity)) AS p FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) SELECT count(*) AS duplicate_groups, coalesce(sum(n), 0)::BIGINT AS duplicate_rows, coalesce(sum(n - 1), 0)::BIGINT AS removed_rows, count(*) FILTER (p = 1) AS identical_groups, count(*) FILTER (p > 1) AS conflicting_groups FROM g")
def dedup_conflict_metrics(spark, d):
    return dedup.metrics(t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_quantity"])


@query("SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(DISTINCT (l_partkey, l_quantity)) > 1")
def dedup_conflicts(spark, d):
    return dedup.conflicts(t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_quantity"]).select("l_orderkey", "l_linenumber")


@query("SELECT DISTINCT md5(text) AS content FROM documents")
def content_hash_dedup(spark, d):
    return dedup.distinct_content(t(spark, d, "documents").select("text")).select(F.md5("text").alias("content"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 9 <> 0 AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment <> 'BUILDING')")
def orphan_anti_join(spark, d):
    child = t(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_custkey")).alias("key"))
    return select.orphans(child, t(spark, d, "customer").where("c_mktsegment <> 'BUILDING'"), "key", "c_custkey").select("o_orderkey")


@query("SELECT doc_id FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND toxic = 1)")
def semi_join(spark, d):
    return t(spark, d, "documents").select("doc_id").join(t(spark, d, "labels").where("toxic = 1"), "doc_id", "left_semi")


@query(f"WITH r AS (SELECT {_NUM_SQL} AS raw, {_MARK_SQL} AS mark FROM events), c AS (SELECT raw IS NOT NULL AND {_CLEAN_SQL.format('raw')} IS NULL AS a, lower(trim(mark)) IN ('', '-', 'null') AS b FROM r) SELECT count(*) FILTER (a) AS lost_num, count(*) FILTER (b) AS lost_mark, count(*) FILTER (a OR b) AS affected_rows, count(*) FILTER (a) + count(*) FILTER (b) AS lost_cells FROM c")
def null_transitions(spark, d):
    before = lineage.add_lineage(t(spark, d, "events").select("event_id", _num().alias("num"), _mark().alias("mark")), "events", "event_id")
    after = before.withColumns({"num": clean.number(F.col("num")), "mark": clean.normalize(F.col("mark"))})
    return lineage.null_transitions(before, after, ["num", "mark"])


def _tagged(spark, d):
    df = lineage.add_lineage(t(spark, d, "events").select("event_id", "user_id", "event_type", _num().alias("num")), "events", "event_id")
    df = lineage.remove_unless(lineage.start_tags(df), F.col("event_type") != "error", "error_event")
    df = lineage.convert(df, "num", clean.number(F.col("num")))
    return lineage.remove_earlier(df, ["user_id", "event_type"], [F.col("event_id")], "earlier")


@query("WITH e AS (SELECT *, event_type <> 'error' AS keep, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS k FROM events) SELECT count(*) AS raw_rows, count(*) FILTER (keep AND k = 1) AS processed_rows, count(*) FILTER (NOT (keep AND k = 1)) AS removed_rows, count(*) FILTER (NOT (keep AND k = 1)) AS explained_rows, 0::BIGINT AS unexplained_rows, true AS matches FROM e")
def row_reconciliation(spark, d):
    return lineage.reconcile(_tagged(spark, d))


@query("WITH e AS (SELECT event_type <> 'error' AS keep, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS k FROM events) SELECT CASE WHEN NOT keep THEN 'error_event' ELSE 'earlier' END AS reason, count(*) AS rows FROM e WHERE NOT keep OR k > 1 GROUP BY 1")
def removal_reasons(spark, d):
    return lineage.reason_counts(_tagged(spark, d))


@query("SELECT 0::BIGINT AS missing_ids, 0::BIGINT AS unknown_ids, 0::BIGINT AS duplicate_ids, 0::BIGINT AS null_ids, count(*) >= 0 AS passed FROM events")
def lineage_audit(spark, d):
    raw = lineage.add_lineage(t(spark, d, "events").select("event_id"), "events", "event_id")
    return lineage.audit_ids(raw, _tagged(spark, d))


_ORDERS = {"o_orderkey": "number", "o_custkey": "number", "o_orderstatus": "text", "o_totalprice": "number", "o_orderdate": "time", "o_orderpriority": "text"}


def _profile_sql(column: str, kind: str) -> str:
    only = lambda k, e: e if k == kind else "NULL"
    low, high, middle = (only("number", f"round({f}({column})::DOUBLE, 4)") for f in ("min", "max", "median"))
    return f"""SELECT '{column}' AS "column", count(*) AS rows, count(*) FILTER ({column} IS NULL) AS nulls, count(DISTINCT {column}) AS "distinct", {low} AS minimum, {high} AS maximum, {middle} AS median,
      {only("text", f"min(length({column}))")}::BIGINT AS min_length, {only("text", f"max(length({column}))")}::BIGINT AS max_length, {only("time", f"strftime(min({column}), '%Y-%m-%d')")} AS earliest FROM orders"""


_LINES = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate".split()


@query(" UNION ALL ".join(
    f"""SELECT '{frame}' AS frame, '{c}' AS "column", count(*) AS rows, count(DISTINCT v) AS "distinct", {f"round(median(v)::DOUBLE, 4)" if c[2:] not in ("returnflag", "linestatus", "shipdate") else "NULL"} AS median FROM (SELECT {c} AS v FROM lineitem{where})"""
    for frame, where in (("raw", ""), ("processed", " WHERE l_returnflag <> 'R'")) for c in _LINES))
def both_profiles(spark, d):
    """All columns of the largest table before and after some rows have gone."""
    lines = t(spark, d, "lineitem").select(*_LINES)
    out = profile.both_profiles(lines, lines.where("l_returnflag <> 'R'"))
    return out.select("frame", "column", "rows", "distinct", F.round("median", 4).alias("median"))


@query(" UNION ALL ".join(_profile_sql(c, k) for c, k in _ORDERS.items()))
def column_profile(spark, d):
    out = profile.column_profiles(t(spark, d, "orders"), list(_ORDERS))
    rounded = [F.round(c, 4).alias(c) for c in ("minimum", "maximum", "median")]
    return out.select("column", "rows", "nulls", "distinct", *rounded, "min_length", "max_length", F.substring("earliest", 1, 10).alias("earliest"))


_BATCHES = "WITH a AS (SELECT user_id, event_type, max(event_id) AS event_id, max(value) AS value FROM events WHERE event_id % 2 = 0 GROUP BY ALL), b AS (SELECT user_id, event_type, max(event_id) AS event_id, max(value) AS value FROM events WHERE event_id % 2 = 1 AND event_type <> 'view' GROUP BY ALL) "


def _batches(spark, d):
    one = lambda df: df.groupBy("user_id", "event_type").agg(F.max("event_id").alias("event_id"), F.max("value").alias("value"))
    e = t(spark, d, "events")
    return one(e.where("event_id % 2 = 0")), one(e.where("event_id % 2 = 1 and event_type <> 'view'"))


@query(_BATCHES + "SELECT * FROM b UNION ALL SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.user_id = a.user_id AND b.event_type = a.event_type)")
def upsert_merge(spark, d):
    return merge(*_batches(spark, d), ["user_id", "event_type"])


@query(_BATCHES + "SELECT user_id, event_type, event_id, NULL::DOUBLE AS value FROM b UNION ALL SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.user_id = a.user_id AND b.event_type = a.event_type)")
def upsert_null_clear(spark, d):
    a, b = _batches(spark, d)
    return merge(a, b.drop("value"), ["user_id", "event_type"])


@query(_BATCHES + "SELECT b.user_id, b.event_type, b.event_id, a.value FROM b LEFT JOIN a ON b.user_id = a.user_id AND b.event_type = a.event_type UNION ALL SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.user_id = a.user_id AND b.event_type = a.event_type)")
def upsert_keep_absent(spark, d):
    a, b = _batches(spark, d)
    return merge(a, b.drop("value"), ["user_id", "event_type"], keep_absent=True)


@query(_BATCHES + "SELECT * FROM b UNION ALL SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.user_id = a.user_id AND b.event_type = a.event_type)")
def stream_replay(spark, d):
    """Batches arrive as files, one after another, and each stream merges what is new; a stream without news changes nothing."""
    source, state = scratch(spark, "replay-source"), scratch(spark, "replay-state")
    warehouse = Warehouse(spark, scratch(spark, "replay"))
    a, b = _batches(spark, d)
    for batch in (a, b, None):
        if batch is not None:
            batch.write.mode("append").parquet(source)
        stream = spark.readStream.schema(a.schema).parquet(source)
        upsert_stream(stream, warehouse, "events", "latest", ["user_id", "event_type"], state, "event_id").awaitTermination()
    return warehouse.read("events", "latest")


@query("""
SELECT p.event_id, v.event_id AS view_id FROM events p LEFT JOIN events v
ON p.user_id = v.user_id AND v.event_type = 'view' AND v.ts <= p.ts AND v.ts >= p.ts - INTERVAL 6 HOUR
WHERE p.event_type = 'purchase' QUALIFY row_number() OVER (PARTITION BY p.event_id ORDER BY v.ts DESC, v.event_id) = 1
""")
def asof_nearest(spark, d):
    e = t(spark, d, "events").select("event_id", "user_id", "event_type", "ts")
    views = e.where("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts"))
    buys = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    fits = (F.col("view_ts") <= F.col("ts")) & (F.col("view_ts") >= F.col("ts") - F.expr("INTERVAL 6 HOUR"))
    out = select.nearest(buys, views, ["user_id"], fits, [F.timestamp_diff("MICROSECOND", F.col("view_ts"), F.col("ts")), F.col("view_id")], ["event_id"])
    return out.select("event_id", "view_id")


@query("WITH l AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1) SELECT event_type, max(value) AS highest, bool_and(value IS NOT NULL) AS complete, count(*) AS users FROM l GROUP BY 1")
def latest_per_group_max(spark, d):
    last = select.latest_per(t(spark, d, "events").select("user_id", "event_type", "value", "ts", "event_id"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")])
    return last.groupBy("event_type").agg(F.max("value").alias("highest"), F.bool_and(F.col("value").isNotNull()).alias("complete"), F.count("*").alias("users"))


@query("WITH u AS (SELECT p_brand, p_type, p_size, min(p_partkey) AS partner FROM part WHERE p_partkey % 2 = 0 GROUP BY ALL HAVING count(*) = 1) SELECT p.p_partkey, u.partner FROM part p LEFT JOIN u ON p.p_brand IS NOT DISTINCT FROM u.p_brand AND p.p_type IS NOT DISTINCT FROM u.p_type AND p.p_size IS NOT DISTINCT FROM u.p_size")
def unique_match_attach(spark, d):
    p = t(spark, d, "part")
    right = p.where("p_partkey % 2 = 0").select("p_brand", "p_type", "p_size", F.col("p_partkey").alias("partner"))
    return select.attach_unique(p, right, ["p_brand", "p_type", "p_size"]).select("p_partkey", "partner")


_RUNS = "(SELECT event_id, user_id::VARCHAR AS job_id, CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'click' THEN 'WARNING' ELSE 'SUCCESS' END AS run_status, CASE WHEN event_id % 3 = 0 THEN 'FAILED' WHEN event_id % 3 = 1 THEN 'PASSED' END AS dq_status, value AS elapsed_seconds, event_type AS failure_stage, ts FROM events)"


def _runs(spark, d):
    kind = F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "click", "WARNING").otherwise("SUCCESS")
    dq = F.when(F.col("event_id") % 3 == 0, "FAILED").when(F.col("event_id") % 3 == 1, "PASSED")
    return t(spark, d, "events").select("event_id", F.col("user_id").cast("string").alias("job_id"), kind.alias("run_status"), dq.alias("dq_status"), F.col("value").alias("elapsed_seconds"), F.col("event_type").alias("failure_stage"), F.col("ts").alias("finished_at"))


@query(f"""
SELECT count(*) AS total_runs, count(*) FILTER (run_status = 'SUCCESS') AS succeeded, count(*) FILTER (run_status = 'WARNING') AS warned, count(*) FILTER (run_status = 'FAILED') AS failed,
  count(*) FILTER (dq_status = 'PASSED') AS dq_passed, count(*) FILTER (dq_status = 'FAILED') AS dq_failed, round(avg(elapsed_seconds), 4) AS avg_seconds, max(elapsed_seconds) AS max_seconds,
  arg_max(job_id, (elapsed_seconds, job_id)) AS slowest_job, array_to_string(list_sort(list(DISTINCT job_id) FILTER (run_status = 'FAILED')), ',') AS failed_jobs,
  array_to_string(list_sort(list(DISTINCT failure_stage) FILTER (run_status = 'FAILED')), ',') AS failure_stages
FROM {_RUNS} WHERE ts >= TIMESTAMP '2024-01-10 17:00:00' AND ts < TIMESTAMP '2024-01-12 09:15:00'
""")
def ops_summary(spark, d):
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    out = runs.operations(_runs(spark, d), at("2024-01-10 17:00:00"), at("2024-01-12 09:15:00"))
    return out.drop("dq_failed_jobs").withColumns({"avg_seconds": F.round("avg_seconds", 4), "failed_jobs": F.array_join("failed_jobs", ","), "failure_stages": F.array_join("failure_stages", ",")})


@query(f"""WITH d AS (SELECT DISTINCT CAST(ts AS DATE) + i AS day FROM events, (SELECT unnest([0, 1]) AS i)),
p AS (SELECT 'night' AS label, day - INTERVAL 1 DAY + INTERVAL 17 HOUR AS s, day + INTERVAL 555 MINUTE AS e FROM d UNION SELECT 'day', day + INTERVAL 555 MINUTE, day + INTERVAL 17 HOUR FROM d)
SELECT label, strftime(s, '%Y-%m-%d %H:%M') AS start, count(*) AS total_runs, count(*) FILTER (run_status = 'FAILED') AS failed, count(*) FILTER (dq_status = 'PASSED') AS dq_passed, max(elapsed_seconds) AS max_seconds, round(sum(elapsed_seconds), 2) AS seconds,
  coalesce(array_to_string(list_sort(list(DISTINCT job_id) FILTER (run_status = 'FAILED')), ','), '') AS failed_jobs FROM {_RUNS} r JOIN p ON r.ts >= s AND r.ts < e GROUP BY ALL""")
def ops_by_period(spark, d):
    """Every run in the one report period that it belongs to."""
    found = _runs(spark, d)
    days = found.select(F.explode(F.array(F.col("finished_at").cast("date"), F.date_add(F.col("finished_at").cast("date"), 1))).alias("day"))
    out = runs.by_period(found, runs.report_periods(days))
    return out.select("label", F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "total_runs", "failed", "dq_passed", "max_seconds", F.round(F.col("avg_seconds") * F.col("total_runs"), 2).alias("seconds"), F.array_join("failed_jobs", ",").alias("failed_jobs"))


_TERMS = "regexp_extract(text, '^[A-Za-z]+ [a-z]+', 0)"


@query(f"""WITH t AS (SELECT DISTINCT {_TERMS} AS term FROM benchmark), r AS (SELECT string_agg(term, '|' ORDER BY length(term) DESC, term) AS p FROM t WHERE term <> ''),
x AS (SELECT page_id, regexp_replace(html, '<[^>]*>', ' ', 'g') AS text FROM pages)
SELECT page_id, regexp_extract(text, p, 0) AS first_term, array_to_string(regexp_extract_all(text, '[^.!?\n]{{0,80}}(?:' || p || ')[^.!?\n]{{0,120}}')[:20], '|') AS passages FROM x, r WHERE regexp_matches(text, p)""")
def term_lookup(spark, d):
    """The beginnings of all benchmark texts, looked for in all pages."""
    terms_of = t(spark, d, "benchmark").select(F.regexp_extract("text", "^[A-Za-z]+ [a-z]+", 0).alias("term"))
    pages = t(spark, d, "pages").select("page_id", F.regexp_replace("html", "<[^>]*>", " ").alias("text"))
    out = terms.find_terms(pages, terms_of, "page_id", "text", "term")
    return out.select("page_id", "first_term", F.array_join("passages", "|").alias("passages"))


@query(f"SELECT job_id, CASE WHEN count(dq_status) = 0 THEN NULL WHEN bool_and(dq_status = 'PASSED') THEN 'PASSED' ELSE 'FAILED' END AS dq_status FROM {_RUNS} GROUP BY 1")
def dq_rollup(spark, d):
    return runs.dq_rollup(_runs(spark, d), "job_id")


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 5 <> 0 THEN s_acctbal END AS balance FROM supplier ORDER BY balance NULLS LAST, s_name, s_suppkey LIMIT 20")
def topk_nulls_last(spark, d):
    df = t(spark, d, "supplier").withColumn("balance", F.when(F.col("s_suppkey") % 5 != 0, F.col("s_acctbal")))
    return select.top(df, [F.asc_nulls_last("balance"), F.col("s_name"), F.col("s_suppkey")], 20).select("s_suppkey", "balance")


@query("SELECT event_id, last_value(CASE WHEN event_id % 3 = 0 THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM events")
def forward_fill(spark, d):
    df = t(spark, d, "events").select("event_id", "user_id", F.when(F.col("event_id") % 3 == 0, F.col("event_type")).alias("filled"))
    return ranges.forward_fill(df, ["filled"], ["user_id"], ["event_id"]).select("event_id", "filled")


@query("WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n FROM documents) SELECT doc_id, count(*) AS lines, max(n)::INTEGER AS last_line, sum(length(trim(line)))::BIGINT AS chars FROM l WHERE trim(line) <> '' GROUP BY 1")
def explode_lines(spark, d):
    lines = text.numbered_lines(t(spark, d, "documents").select("doc_id", "text"), "text")
    return lines.groupBy("doc_id").agg(F.count("*").alias("lines"), F.max("_line").alias("last_line"), F.sum(F.length("_raw")).alias("chars"))


@query("SELECT n_nationkey, y AS year, CASE n_nationkey WHEN 3 THEN 33 ELSE n_nationkey END AS code FROM nation, (SELECT unnest(range(2012, 2025)) AS y)")
def cross_scope(spark, d):
    years = spark.range(2012, 2025).select(F.col("id").alias("year"))
    out = files.scopes(years, t(spark, d, "nation").select("n_nationkey", F.col("n_nationkey").cast("string").alias("code")), {"3": "33"})
    return out.select("n_nationkey", "year", F.col("code").cast("int").alias("code"))


@query("SELECT r_name AS name, r_regionkey AS k, NULL::INTEGER AS extra FROM region UNION ALL BY NAME SELECT n_name AS name, n_nationkey AS k, n_regionkey AS extra FROM nation")
def union_by_name(spark, d):
    a = t(spark, d, "region").select(F.col("r_name").alias("name"), F.col("r_regionkey").alias("k"))
    return a.unionByName(t(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("extra")), allowMissingColumns=True)


@query("SELECT c_custkey AS k, 'difference' AS kind FROM customer EXCEPT SELECT o_custkey, 'difference' FROM orders UNION ALL (SELECT c_custkey AS k, 'common' AS kind FROM customer INTERSECT SELECT o_custkey, 'common' FROM orders)")
def set_difference(spark, d):
    c, o = t(spark, d, "customer").select(F.col("c_custkey").alias("k")), t(spark, d, "orders").select(F.col("o_custkey").alias("k"))
    return c.subtract(o).withColumn("kind", F.lit("difference")).union(c.intersect(o).withColumn("kind", F.lit("common")))


_GEO = "(SELECT c_custkey, 33 + (c_custkey * 37 % 600) / 100.0::DOUBLE AS lat, 125 + (c_custkey * 53 % 500) / 100.0::DOUBLE AS lon FROM customer)"


def _geo(spark, d):
    return t(spark, d, "customer").select("c_custkey", (33 + (F.col("c_custkey") * 37 % 600) / 100).alias("lat"), (125 + (F.col("c_custkey") * 53 % 500) / 100).alias("lon"))


@query(f"""
WITH c AS (SELECT 6371.00877 / 5.0::DOUBLE AS re, radians(30) AS p1, radians(60) AS p2, radians(38) AS p0, radians(126) AS l0),
k AS (SELECT *, ln(cos(p1) / cos(p2)) / ln(tan(pi() / 4 + p2 / 2) / tan(pi() / 4 + p1 / 2)) AS n FROM c),
f AS (SELECT *, re * pow(tan(pi() / 4 + p1 / 2), n) * cos(p1) / n AS s FROM k),
g AS (SELECT *, s / pow(tan(pi() / 4 + p0 / 2), n) AS r0 FROM f)
SELECT c_custkey, floor(s / pow(tan(pi() / 4 + radians(lat) / 2), n) * sin(n * (radians(lon) - l0)) + 43.5)::BIGINT AS nx,
  floor(r0 - s / pow(tan(pi() / 4 + radians(lat) / 2), n) * cos(n * (radians(lon) - l0)) + 136.5)::BIGINT AS ny FROM {_GEO}, g
""")
def grid_projection(spark, d):
    return _geo(spark, d).select("c_custkey", geo.grid(F.col("lat"), F.col("lon")).alias("g")).select("c_custkey", "g.nx", "g.ny")


_HAVERSINE = "2 * 6371.0 * atan2(sqrt(a), sqrt(1 - a))"


@query(f"WITH h AS (SELECT c_custkey, pow(sin(radians(lat - 37.5) / 2), 2) + cos(radians(37.5)) * cos(radians(lat)) * pow(sin(radians(lon - 127.0) / 2), 2) AS a FROM {_GEO}) SELECT c_custkey, round({_HAVERSINE}, 6) AS km FROM h")
def haversine(spark, d):
    return _geo(spark, d).select("c_custkey", F.round(geo.haversine_km(F.lit(37.5), F.lit(127.0), F.col("lat"), F.col("lon")), 6).alias("km"))


@query("SELECT p_partkey, CAST(round_even(CAST(p_size AS DOUBLE) / 40 * 20, 0) AS BIGINT) AS minutes FROM part")
def bankers_round(spark, d):
    return t(spark, d, "part").select("p_partkey", geo.travel_minutes(F.col("p_size") / 40).alias("minutes"))


def _clock() -> Column:
    raw = F.when(F.col("o_orderkey") % 7 == 0, "24:00").when(F.col("o_orderkey") % 11 == 0, "9:5").when(F.col("o_orderkey") % 13 == 0, "2575").otherwise(F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"))
    return F.when(F.length(raw) == 2, F.concat(raw, F.lit(":"), F.lpad((F.col("o_orderkey") % 60).cast("string"), 2, "0"))).otherwise(raw)


@query("SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 7 = 0 THEN 1440 WHEN o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 THEN NULL ELSE (o_orderkey % 24) * 60 + o_orderkey % 60 END AS INTEGER) AS minutes FROM orders")
def clock_parse(spark, d):
    return t(spark, d, "orders").select("o_orderkey", schedule.clock(_clock()).alias("minutes"))


@query("""
WITH e AS (SELECT event_id, ts, date_trunc('day', ts) + INTERVAL 9 HOUR AS a, date_trunc('day', ts) + INTERVAL 18 HOUR AS b, ts + to_minutes(CAST(event_id % 50 AS INTEGER)) AS arrival FROM events),
o AS (SELECT *, ts >= a AND ts < b AS is_open FROM e),
u AS (SELECT *, CASE WHEN is_open THEN greatest(0, date_diff('second', arrival, b) / 60.0) END AS usable FROM o)
SELECT event_id, CASE WHEN NOT is_open THEN 'CLOSED' WHEN date_diff('second', arrival, b) / 60.0 < 30 THEN 'TOO_LATE' ELSE 'AVAILABLE' END AS state,
  CASE WHEN NOT is_open THEN 'CLOSED' WHEN date_diff('second', arrival, b) / 60.0 < 30 THEN 'TOO_LATE' WHEN date_diff('second', arrival, b) / 60.0 <= 60 THEN 'CLOSING_SOON' ELSE 'AVAILABLE' END AS urgency FROM u
""")
def schedule_state(spark, d):
    lit = F.lit
    hours = {"week_open": lit("0900"), "week_close": lit("18:00"), "weekend_open": lit("09:00"), "weekend_close": lit("1800")}
    e = t(spark, d, "events").withColumn("ts", F.date_trunc("second", "ts").cast("timestamp_ntz"))
    e = schedule.add_feasibility(e, F.col("ts"), (F.col("event_id") % 50).cast("double"), lit("연중무휴"), hours)
    return e.select("event_id", "feasibility.state", "feasibility.urgency")


@query("""
WITH s AS (SELECT user_id, CASE event_type WHEN 'view' THEN 'FAVORABLE' WHEN 'click' THEN 'FAVORABLE' WHEN 'error' THEN 'CAUTION' END AS state, event_id FROM events)
SELECT user_id, CASE WHEN bool_or(state = 'CAUTION') THEN 'CAUTION' WHEN bool_and(coalesce(state = 'FAVORABLE', false)) THEN 'FAVORABLE' ELSE 'UNKNOWN' END AS combined FROM s GROUP BY 1
""")
def three_valued_combine(spark, d):
    state = F.when(F.col("event_type").isin("view", "click"), "FAVORABLE").when(F.col("event_type") == "error", "CAUTION")
    return combine_by(t(spark, d, "events"), "user_id", state)


def combine_by(df: DataFrame, key: str, state: Column) -> DataFrame:
    """The combined state of each key over all rows of ``df``; a key's group is held as its distinct states."""
    states = df.groupBy(key).agg(F.collect_set(F.coalesce(state, F.lit("UNKNOWN"))).alias("s"))
    return states.select(key, schedule.combine(F.col("s")).alias("combined"))


@query("SELECT page_id, least(20, len(regexp_extract_all(html, '(?s)href=\".{0,20}'))) AS links, regexp_extract(html, '(?s)href=\".{0,20}') AS first_link FROM pages")
def regex_evidence(spark, d):
    found = text.evidence(F.col("html"), 'href="', before=0, after=20)
    return t(spark, d, "pages").select("page_id", F.size(found).cast("long").alias("links"), F.coalesce(F.get(found, F.lit(0)), F.lit("")).alias("first_link"))


@query("SELECT event_type, count(*) AS events, count(*) FILTER (value IS NULL) AS null_values, round(sum(value), 4) AS total FROM events GROUP BY 1 ORDER BY 1")
def value_counts(spark, d):
    return t(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("events"), F.count_if(F.col("value").isNull()).alias("null_values"), F.round(F.sum("value"), 4).alias("total")).orderBy("event_type")


@query(f"""
WITH r AS (SELECT event_id, user_id, CAST(ts AS DATE)::VARCHAR AS day, {_MARK_SQL} AS raw, {_NUM_SQL} AS num FROM events),
c AS (SELECT event_id, user_id, day, CASE WHEN lower(trim(raw)) NOT IN ('', '-', 'null') THEN trim(raw) END AS kind, {_CLEAN_SQL.format('num')} AS amount FROM r),
k AS (SELECT * FROM c QUALIFY kind IS NULL OR row_number() OVER (PARTITION BY user_id, kind, day ORDER BY event_id DESC) = 1)
SELECT kind, count(*) AS rows, count(*) FILTER (kind IS NULL OR amount IS NULL) AS review_rows, round(sum(amount), 4) AS amount FROM k GROUP BY 1
""")
def observation_summary(spark, d):
    return flagship(spark, d)


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Scan, null tokens, guarded numbers, last observation of a key, review flags, summary."""
    raw = t(spark, d, "events").select("event_id", "user_id", F.col("ts").cast("date").cast("string").alias("day"), _mark().alias("kind"), _num().alias("amount"))
    df = clean.normalize_nulls(raw).withColumn("amount", clean.number(F.col("amount")))
    df = dedup.keep_last(df, ["user_id", "kind", "day"], [F.col("event_id")])
    df = df.withColumn("review", clean.any_null(df, ["kind", "amount"]))
    return df.groupBy("kind").agg(F.count("*").alias("rows"), F.count_if(F.col("review")).alias("review_rows"), F.round(F.sum("amount"), 4).alias("amount"))
