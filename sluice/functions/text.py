"""Generators over text: warning bulletins, lines, evidence around keywords."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.clean import strip
from sluice.functions.values import ADVISORY, BULLET, NO_WARNING, PRELIMINARY, SEA_WORDS, WARNING

_CARRIED = ("tmEf", "tmFc", "tmSeq", "collected_at")


def area_type(area: Column) -> Column:
    return F.when(area.rlike("|".join(SEA_WORDS)), "SEA").when(area.isNotNull(), "LAND")


def numbered_lines(df: DataFrame, text: str) -> DataFrame:
    """A row for each trimmed line with something in it, with its place ``_line``."""
    return df.select("*", F.posexplode(F.split(F.col(text), r"\R")).alias("_line", "_raw")).withColumn("_raw", strip(F.col("_raw"))).where("_raw <> ''")


def _said(text: str) -> Column:
    body = strip(F.col(text))
    return body.isNotNull() & (body != "") & ~body.rlike(NO_WARNING)


def _rows(lines: DataFrame, kind: Column, level: Column, status: str, area: Column, effective: Column, extra: list[str]) -> DataFrame:
    return lines.select(
        kind.alias("warning_type"), level.alias("warning_level"), F.lit(status).alias("warning_status"), area.alias("area_name"), area_type(area).alias("area_type"), effective.alias("effective_time"),
        *[F.col(c) for c in _CARRIED if c in lines.columns], *extra,
    )


def active_warnings(df: DataFrame, text: str = "t6", extra: tuple[str, ...] = ()) -> DataFrame:
    """A row for each line ``type+level: areas``."""
    lines = numbered_lines(df.where(_said(text)), text).where(F.contains("_raw", F.lit(":")))
    halves = F.split("_raw", ":", 2)
    left, area = strip(F.regexp_replace(halves[0], BULLET, "")), strip(halves[1])
    level = F.when(left.endswith(ADVISORY), ADVISORY).when(left.endswith(WARNING), WARNING)
    kind = F.when(level.isNotNull(), strip(F.substring(left, F.lit(1), F.length(left) - F.length(level)))).otherwise(left)
    return _rows(lines.where(area != ""), kind, level, "ACTIVE", area, F.lit(None).cast("string"), list(extra))


def preliminary_warnings(df: DataFrame, key: str, text: str = "t7", extra: tuple[str, ...] = ()) -> DataFrame:
    """A row for each bullet ``time: areas``, under the type of the last header ``(n) ...`` of its document ``key``."""
    lines = numbered_lines(df.where(_said(text)), text)
    header = F.contains("_raw", F.lit(PRELIMINARY)) & F.col("_raw").rlike(r"^\(\d+\)")
    name = strip(F.regexp_replace(F.regexp_replace("_raw", r"^\(\d+\)\s*", ""), PRELIMINARY, ""))
    so_far = Window.partitionBy(key).orderBy("_line").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("_kind", F.last(F.when(header, name), ignorenulls=True).over(so_far)).where(~header & F.col("_raw").rlike(BULLET) & F.contains("_raw", F.lit(":")))
    halves = F.split("_raw", ":", 2)
    area = strip(halves[1])
    return _rows(lines.where(area != ""), F.col("_kind"), F.lit(PRELIMINARY), "PRELIMINARY", area, strip(F.regexp_replace(halves[0], BULLET, "")), list(extra))


def evidence(text: Column, keyword: str, before: int = 80, after: int = 120, most: int = 20) -> Column:
    """Up to ``most`` passages around a keyword (a pattern), left to right without overlap."""
    return F.slice(F.regexp_extract_all(text, F.lit(rf"(?s)(.{{0,{before}}}(?:{keyword}).{{0,{after}}})"), F.lit(1)), 1, most)


def table_rows(html: Column) -> Column:
    """Cells' text of each ``<li class=tr>`` row of an HTML fragment."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<li[^>]*class=[\"']?tr[\"']?[^>]*>(.*?)</li>"), F.lit(1))
    return F.transform(rows, lambda r: strip(F.regexp_replace(F.regexp_replace(r, r"<[^>]*>", " "), r"\s+", " ")))
