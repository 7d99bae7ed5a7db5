"""Duplicates. Every operator that keeps one of several rows takes its order; equal orders must not matter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _any_null(keys: Sequence[str]) -> Column:
    found = F.lit(False)
    for k in keys:
        found = found | F.col(k).isNull()
    return found


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column], *, null_keys: str = "keep") -> DataFrame:
    """The last row of each key by ascending ``order``.

    ``null_keys``: "keep" lets all rows with a null key survive, "group" treats null as a value. An aggregate, so each task
    sends one row of a key at most and a hot key is no burden; rows with a null key are not exchanged at all.
    """
    if null_keys == "keep":
        closed = keep_last(df.where(~_any_null(keys)), keys, order, null_keys="group")
        return df.where(_any_null(keys)).unionByName(closed)
    row = F.struct(*[F.col(f"`{c}`").alias(c) for c in df.columns])
    by = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    return df.groupBy(*keys).agg(F.max_by(row, by).alias("_row")).select("_row.*")


def conflicts(df: DataFrame, keys: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """Keys whose rows differ in the payload, null being a value of its own."""
    whole = F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("<NULL>")).alias(c) for c in payload])
    return df.groupBy(*keys).agg(F.count_distinct(whole).alias("payloads")).where("payloads > 1")


def keep_first_agreeing(df: DataFrame, keys: Sequence[str], payload: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key; rows of a key that differ in the payload are an error."""
    if bad := conflicts(df, keys, payload).limit(5).collect():
        raise ValueError(f"conflicting duplicates: {[tuple(r[k] for k in keys) for r in bad]}")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*[c.asc_nulls_last() for c in order]))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def content_key(columns: Sequence[str]) -> Column:
    """SHA-256 of the row's content as JSON with sorted names and explicit nulls."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def distinct_content(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row for each content, with its ``content_key``; equal contents are interchangeable."""
    return df.withColumn("content_key", content_key(columns or df.columns)).dropDuplicates(["content_key"])


def metrics(df: DataFrame, keys: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """One row: groups with several rows, their rows, rows to remove, groups of identical and of conflicting payloads."""
    groups = df.where(~_any_null(keys)).groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct(F.struct(*payload)).alias("p")).where("n > 1")
    return groups.agg(
        F.count("*").alias("duplicate_groups"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("removed_rows"),
        F.count_if(F.col("p") == 1).alias("identical_groups"),
        F.count_if(F.col("p") > 1).alias("conflicting_groups"),
    )
