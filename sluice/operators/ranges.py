"""Rows in sorted ranges: gapless numbers, the nearest values before and after each row, and as-of joins built on these.

Rows are sorted over ranges of all tasks, ties included, and written once. What a range needs of the others is a row for
each range, so neither a key that all rows share nor a table without keys is ever sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.operators.staging import staged

_RANGE, _AT, _TIE = "_range", "_at", "_tie"


def sorted_ranges(df: DataFrame, by: Sequence[str], label: str = "ranges") -> DataFrame:
    """The rows in ascending order of ``by``, with ``_range`` and ``_at``, which grow with it. Equal rows are interchangeable."""
    names = [F.col(f"`{c}`") for c in by]
    rows = df.withColumn(_TIE, F.monotonically_increasing_id())  # lets the ranges split rows that are equal
    placed = rows.repartitionByRange(*names, F.col(_TIE)).sortWithinPartitions(*names, F.col(_TIE)).drop(_TIE)
    return staged(placed.withColumns({_RANGE: F.spark_partition_id(), _AT: F.monotonically_increasing_id()}), label)


def with_surrogate(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Adds numbers from 1 without gaps, in ascending order of the columns ``order``; equal rows are interchangeable."""
    placed = sorted_ranges(df, order, "surrogate")
    sizes = placed.groupBy(_RANGE).agg(F.count("*").alias("_n"), F.min(_AT).alias("_least"))
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(_RANGE, "_least", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))  # a row for each range
    numbered = placed.join(F.broadcast(starts), _RANGE)
    return numbered.withColumn(name, F.col("_before") + F.col(_AT) - F.col("_least") + 1).drop(_RANGE, _AT, "_least", "_before")


def scan(df: DataFrame, partition: Sequence[str], order: Sequence[str], *, before: dict[str, str] | None = None, after: dict[str, str] | None = None) -> DataFrame:
    """Adds, for each new name in ``before``, the last value of its column that is not null at or before the row within the
    row's partition, and for ``after`` the first at or behind it. Null keys are a partition of their own."""
    before, after = before or {}, after or {}
    key = F.struct(*[F.col(f"`{c}`") for c in partition]) if partition else F.struct(F.lit(0).alias("all"))
    placed = sorted_ranges(df, [*partition, *order], "scan").withColumn("_key", key)
    within = Window.partitionBy(_RANGE, "_key")
    up, down = (within.orderBy(o).rowsBetween(Window.unboundedPreceding, 0) for o in (F.asc(_AT), F.desc(_AT)))
    found = {new: F.last(c, ignorenulls=True).over(up) for new, c in before.items()} | {new: F.last(c, ignorenulls=True).over(down) for new, c in after.items()}

    # what a range ends and begins with, in its last and first partition
    value = lambda c, best: best(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), F.col(_AT)))
    held = placed.groupBy(_RANGE, "_key").agg(F.max(_AT).alias("_last"), F.min(_AT).alias("_first"), *[value(c, F.max_by).alias(f"b{i}") for i, c in enumerate(before.values())], *[value(c, F.min_by).alias(f"a{i}") for i, c in enumerate(after.values())])
    ends = lambda n, side: F.struct("_key", *[F.col(f"{side}{i}") for i in range(n)])
    summary = held.groupBy(_RANGE).agg(F.max_by(ends(len(before), "b"), "_last").alias("end"), F.min_by(ends(len(after), "a"), "_first").alias("start"))

    def handed(side: str, struct: str, n: int, order: str) -> DataFrame:
        """For each range the key that the range beside it ends with, and that key's value from all ranges on that side."""
        by = F.asc(_RANGE) if order == "asc" else F.desc(_RANGE)
        own = summary.select(_RANGE, F.col(f"{struct}._key").alias("k"), *[F.col(f"{struct}.{side}{i}").alias(f"v{i}") for i in range(n)])
        run = Window.partitionBy("k").orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
        state = F.struct("k", *[F.last(f"v{i}", ignorenulls=True).over(run).alias(f"v{i}") for i in range(n)])
        return own.withColumn("state", state).select(_RANGE, F.lag("state").over(Window.orderBy(by)).alias(f"_from_{side}"))

    out = placed.withColumns(found)
    if before:
        out = out.join(F.broadcast(handed("b", "end", len(before), "asc")), _RANGE, "left")  # a row for each range
        out = out.withColumns({new: F.coalesce(new, F.when(F.col("_key").eqNullSafe(F.col("_from_b.k")), F.col(f"_from_b.v{i}"))) for i, new in enumerate(before)}).drop("_from_b")
    if after:
        out = out.join(F.broadcast(handed("a", "start", len(after), "desc")), _RANGE, "left")
        out = out.withColumns({new: F.coalesce(new, F.when(F.col("_key").eqNullSafe(F.col("_from_a.k")), F.col(f"_from_a.v{i}"))) for i, new in enumerate(after)}).drop("_from_a")
    return out.drop(_RANGE, _AT, "_key")


def forward_fill(df: DataFrame, columns: Sequence[str], partition: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Nulls take the last value before them in their partition."""
    out = scan(df, partition, order, before={f"_filled_{c}": c for c in columns})
    return out.withColumns({c: F.col(f"_filled_{c}") for c in columns}).select(df.columns)


def neighbours(points: DataFrame, rows: DataFrame, on: Sequence[str], at: str, take: Sequence[str], prefer: Sequence = ()) -> DataFrame:
    """As-of merge: for each distinct (``on``, ``at``) of ``points`` the last row of ``rows`` at or before it as the struct
    ``before``, and the first at or after it as ``after``; null where there is none.

    Points and rows are united and sorted once, so no pair of them is ever built. Of the rows of one key and time counts the
    one of the least ``prefer``, or else of the least values. Null keys and times of points meet nothing, those of rows are left out.
    """
    keys = [*on, at]
    given = F.lit(True)
    for c in keys:
        given = given & F.col(c).isNotNull()
    row = F.struct(*[F.col(c) for c in (at, *take)])
    best = rows.where(given).groupBy(*keys).agg(F.min_by(row, F.struct(*[p.alias(f"p{i}") for i, p in enumerate(prefer)])) if prefer else F.min(row)).toDF(*keys, "row")
    asked = points.select(*keys).where(given).distinct().withColumn("asked", F.lit(True))
    both = best.withColumn("asked", F.lit(False)).unionByName(asked.withColumn("row", F.lit(None).cast(best.schema["row"].dataType)))
    both = both.groupBy(*keys).agg(F.first("row", ignorenulls=True).alias("row"), F.bool_or("asked").alias("asked"))
    return scan(both, on, [at], before={"before": "row"}, after={"after": "row"}).where("asked").select(*keys, "before", "after")
