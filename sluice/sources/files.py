"""Files and messages as DataFrames. Row order is kept as a place column written at ingest."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators import ranges

SEQ = "_ingest_seq"


def table_if_exists(spark: SparkSession, name: str, schema: T.StructType | str) -> DataFrame:
    return spark.table(name) if spark.catalog.tableExists(name) else spark.createDataFrame([], schema)


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file; empty, repeated and HTML ones are errors."""
    line = spark.read.text(path).limit(1).collect()
    first = line[0][0].lstrip("﻿") if line else ""
    if re.match(r"\s*<(!doctype|html)", first, re.I):
        raise ValueError(f"{path} is HTML")
    names = [n.strip() for n in next(csv.reader([first], escapechar="\\"), [])]
    if not names or not all(names) or len(set(names)) != len(names):
        raise ValueError(f"{path}: bad header {names}")
    return names


def _by_line_breaks(spark: SparkSession, path: str | Sequence[str]) -> dict[bool, list[str]]:
    """The files of ``path`` by whether a quoted field of theirs holds a line break: some line has an odd number of quotes."""
    lines = spark.read.text(path)
    odd = F.regexp_count("value", F.lit(r'(?<!\\)"')) % 2 == 1
    broken = {unquote(r[0]) for r in lines.where(odd).select("_metadata.file_path").distinct().collect()}
    every = sorted(unquote(f) for f in lines.inputFiles())
    plain = lambda f: re.sub(r"^file:/+", "/", f)
    broken = {plain(f) for f in broken}
    return {True: [f for f in every if plain(f) in broken], False: [f for f in every if plain(f) not in broken]}


def read_csv(spark: SparkSession, path: str | Sequence[str], *, sequence: bool = False) -> DataFrame:
    """All columns as text, empty fields null, everything else verbatim; rows of another width or with NUL are errors.

    Files are split over tasks; only those with line breaks in quoted fields are read whole, one in a task. With ``sequence`` a
    place column (``_ingest_seq``, from 0, without gaps) says where each row came, on which every keep-last depends: by the
    file's name, the split's offset in it and the row in the split, so it does not depend on how files are dealt over tasks.
    The rows are written for it once. Malformed rows raise where they are read, so the check costs no pass of its own.
    """
    names = header(spark, path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names] + [T.StructField("_bad", T.StringType())])
    out = None
    for whole, found in _by_line_breaks(spark, path).items():
        if not found:
            continue
        rows = spark.read.csv(found, schema=schema, header=True, escape="\\", multiLine=whole, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, encoding="UTF-8", enforceSchema=True)
        nul = F.lit(False)
        for n in names:
            nul = nul | F.coalesce(F.contains(F.col(f"`{n}`"), F.lit("\0")), F.lit(False))
        fault = F.when(F.col("_bad").isNotNull() | nul, F.raise_error(F.lit(f"{path}: a row of another width or with NUL")).cast("string"))
        place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_offset"), F.monotonically_increasing_id().alias("_row")] if sequence else []
        rows = rows.select(*[F.coalesce(fault, F.nullif(F.col(f"`{n}`"), F.lit(""))).alias(n) for n in names], *place)
        out = rows if out is None else out.unionByName(rows)
    if not sequence:
        return out
    return ranges.with_surrogate(out, ["_file", "_offset", "_row"], SEQ).withColumn(SEQ, F.col(SEQ) - 1).drop("_file", "_offset", "_row")


def csv_report(df: DataFrame) -> dict[str, int]:
    """Rows and empty fields; no rows are an error."""
    empty = F.lit(0).cast("long")
    for c in df.columns:
        empty = empty + F.col(f"`{c}`").isNull().cast("long")
    found = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(empty), F.lit(0)).alias("empty_fields")).first().asDict()
    if not found["rows"]:
        raise ValueError("no rows")
    return found


def file_for(names: Sequence[str], stem: str) -> str:
    """The file of a stem and a month (``STEM_YYYYMM.csv``): the latest, which must be one."""
    found = [(m[1], n) for n in names if (m := re.fullmatch(rf"(?:.*/)?{re.escape(stem)}_(\d{{6}})\.csv", n))]
    if not found:
        raise FileNotFoundError(stem)
    latest = max(month for month, _ in found)
    last = [n for month, n in found if month == latest]
    if len(last) > 1:
        raise ValueError(f"{stem}: {last} are both of {latest}")
    return last[0]


def latest_version(df: DataFrame, name: Column) -> DataFrame:
    """Rows whose name ends in the latest (YYYYMM) of all; several latest names are an error."""
    month = F.regexp_extract(name, r"\((\d{6})\)$", 1)
    dated = df.withColumn("_month", month).where("_month <> ''")
    names = dated.groupBy("_month").agg(F.count_distinct(name).alias("n")).orderBy(F.desc("_month")).limit(1).collect()
    if names and names[0]["n"] > 1:
        raise ValueError(f"{names[0]['n']} versions of {names[0]['_month']}")
    return dated.join(dated.agg(F.max("_month").alias("_month")), "_month").drop("_month")


def read_xml(spark: SparkSession, path: str, tag: str, schema: T.StructType | str) -> DataFrame:
    """Rows of an XML file: one for each element ``tag``, its children's text by name."""
    return spark.read.schema(schema).format("xml").option("rowTag", tag).load(path)


def read_delimited_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines with their damaged ones left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def envelope_items(df: DataFrame, column: str, item: str) -> DataFrame:
    """Rows of a JSON answer's items: nested or flat body, a list or a single object; other shapes give none."""
    body = F.coalesce(F.get_json_object(column, "$.response.body"), F.get_json_object(column, "$.body"), F.col(column))
    items = F.coalesce(F.get_json_object(body, "$.items.item"), F.get_json_object(body, "$.items"))
    many = F.when(F.substring(F.trim(items), 1, 1) == "[", F.from_json(items, f"array<{item}>"))
    one = F.when(F.substring(F.trim(items), 1, 1) == "{", F.array(F.from_json(items, item)))
    total = F.coalesce(F.get_json_object(body, "$.totalCount"), F.lit("0")).try_cast("long")
    rows = df.select("*", F.coalesce(many, one).alias("_items"), total.alias("_total"))
    return rows.select(*df.columns, "_total", F.posexplode("_items").alias("_at", "_item")).select(*df.columns, "_total", "_at", "_item.*")


def require_total(rows: DataFrame, scope: Sequence[str], total: str = "_total") -> None:
    """Each scope must have as many rows as its answers said."""
    bad = rows.groupBy(*scope).agg(F.count("*").alias("n"), F.max(total).alias("t")).where("n <> t").limit(5).collect()
    if bad:
        raise ValueError(f"incomplete scopes: {[r.asDict() for r in bad]}")


def with_scope(df: DataFrame, values: dict[str, object], wanted: Sequence[str] | None = None) -> DataFrame:
    """Adds constant columns of a request and projects to the wanted ones, missing ones null."""
    df = df.withColumns({k: F.lit(v) for k, v in values.items()})
    return df if wanted is None else df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in wanted])


def scopes(years: DataFrame, districts: DataFrame, remap: dict[str, str] | None = None, code: str = "code") -> DataFrame:
    """Every year with every district, former codes replaced; the years travel as one row."""
    held = years.agg(*[F.collect_set(c).alias(c) for c in years.columns])
    out = districts.crossJoin(held)
    for c in years.columns:
        out = out.withColumn(c, F.explode(c))
    return out if not remap else out.withColumn(code, F.coalesce(F.create_map(*[F.lit(x) for kv in remap.items() for x in kv])[F.col(code)], F.col(code)))


CHECKPOINT = "type string, key string, status string, unit string, records array<string>, saved_at string, meta string"


def completed_units(lines: DataFrame, order: str) -> DataFrame:
    """The last state of each unit of a checkpoint; damaged lines are no units, a missing meta line is an error."""
    parsed = lines.select(order, F.from_json("value", CHECKPOINT, {"mode": "PERMISSIVE"}).alias("x")).select(order, "x.*")
    if parsed.where("type = 'meta'").limit(1).count() == 0:
        raise ValueError("the checkpoint has no meta line")
    units = parsed.where("type = 'unit' and key is not null")
    return units.groupBy("key").agg(F.max_by(F.struct("status", "records", "saved_at"), order).alias("x")).select("key", "x.*")


def pending(units: DataFrame, done: DataFrame, key: str = "key") -> DataFrame:
    """Units that a resumed run still has to do."""
    return units.join(done.where("status = 'done'").select(key), key, "left_anti")


def fingerprint(units: DataFrame, key: str = "key") -> DataFrame:
    """SHA-256 over the sorted keys of a run's units, which are scopes of one job and few."""
    return units.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(key)), "\n"), 256).alias("fingerprint"))


def first_present(df: DataFrame, names: dict[str, Sequence[str]]) -> DataFrame:
    """Columns by their new name, each the first value that is not null of the source columns that exist.

    Sources spell their keys in different cases (``citycode``, ``cityCode``); a column without any source is null.
    """
    have = set(df.columns)
    pick = lambda sources: F.coalesce(*[F.col(f"`{c}`") for c in sources if c in have], F.lit(None).cast("string"))
    return df.select(*[pick(sources).alias(name) for name, sources in names.items()])


def require_values(df: DataFrame, column: str, expected: Sequence) -> None:
    """Raises unless the distinct values of a column are exactly the expected ones; one row reaches the driver."""
    wanted = F.array(*map(F.lit, expected))
    held = df.where(F.col(column).isin(*expected)).agg(F.array_sort(F.collect_set(column)).alias("held"))
    other = df.where(F.col(column).isNull() | ~F.col(column).isin(*expected)).select(column).limit(1).collect()
    missing = held.select(F.array_except(wanted, "held").alias("missing")).first()["missing"]
    if missing or other:
        raise ValueError(f"{column}: missing {missing}, unexpected {[r[0] for r in other]}")


def catalog_columns(spark: SparkSession, database: str | None = None) -> DataFrame:
    """A row for each column of the session's tables: table_name, column_name, data_type, nullable, place."""
    names = [t.name for t in spark.catalog.listTables(database)]
    rows = [(t, f.name, f.dataType.simpleString(), f.nullable, i) for t in names for i, f in enumerate(spark.table(t if database is None else f"{database}.{t}").schema)]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, nullable boolean, place int")


def start_checkpoint(spark: SparkSession, path: str, meta: str) -> None:
    """Begins a checkpoint with its meta line; an old one at the path goes."""
    line = spark.range(1).select(F.to_json(F.struct(F.lit("meta").alias("type"), F.lit(meta).alias("meta"))).alias("value"))
    line.write.mode("overwrite").text(path)


def append_units(units: DataFrame, path: str) -> None:
    """Appends units (key, status, records, saved_at) as JSON lines; a write is seen as a whole or not at all."""
    names = [c for c in ("key", "status", "unit", "records", "saved_at") if c in units.columns]
    units.select(F.to_json(F.struct(F.lit("unit").alias("type"), *names)).alias("value")).write.mode("append").text(path)


def read_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """The last state of each unit of a written checkpoint, by the time it was saved."""
    lines = spark.read.text(path).withColumn("order", F.coalesce(F.get_json_object("value", "$.saved_at"), F.lit("")))
    return completed_units(lines, "order")


def write_report(df: DataFrame, path: str) -> None:
    """A report as JSON lines and as CSV with a header, under ``path``; skipped scopes and failures are written alike."""
    df.write.mode("overwrite").json(f"{path}/json")
    flat = [F.to_json(f.name).alias(f.name) if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) else F.col(f"`{f.name}`") for f in df.schema]
    df.select(*flat).write.mode("overwrite").csv(f"{path}/csv", header=True, escape='"')
