"""Row lineage and the audit of what a processor removed or lost.

Lineage is a column, and reasons and losses are columns of the same plan, so an audit is a few aggregates and no
comparison of snapshots.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.clean import read_as
from sluice.operators.staging import staged

ROW_ID, REASONS, LOSS = "_dq_row_id", "_removal_reasons", "_loss_"


def add_lineage(df: DataFrame, audit_id: str, sequence: str) -> DataFrame:
    """``<audit>:<place>`` from an immutable place column; an error if the name is taken."""
    if ROW_ID in df.columns:
        raise ValueError(f"{ROW_ID} is reserved")
    return df.withColumn(ROW_ID, F.concat(F.lit(f"{audit_id}:"), F.col(sequence).cast("string")))


def drop_lineage(df: DataFrame) -> DataFrame:
    return df.drop(ROW_ID, REASONS, *[c for c in df.columns if c.startswith(LOSS)])


def start_tags(df: DataFrame) -> DataFrame:
    return df.withColumn(REASONS, F.array().cast("array<string>"))


def live() -> Column:
    return F.size(REASONS) == 0


def remove_unless(df: DataFrame, keep: Column, reason: str) -> DataFrame:
    """Tags live rows that a filter would drop; null counts as no."""
    gone = live() & ~F.coalesce(keep, F.lit(False))
    return df.withColumn(REASONS, F.when(gone, F.array_append(REASONS, F.lit(reason))).otherwise(F.col(REASONS)))


def remove_earlier(df: DataFrame, keys: Sequence[str], order: Sequence[Column], reason: str, *, last: bool = True) -> DataFrame:
    """Tags live rows that are not the last (or first) of their key; rows with a null key stay, null orders come before others.

    The rows are written once with a number each; the number to keep of each key is an aggregate, reduced in the tasks
    before its exchange, that is joined back, so a key that all rows share is split like any other. Equal orders: one stays.
    """
    whole = live()
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    rows = staged(df.withColumn("_row", F.monotonically_increasing_id()), "tagged")
    rank = F.struct(*[x for i, c in enumerate(order) for x in ((c.isNotNull() if last else c.isNull()).alias(f"n{i}"), c.alias(f"o{i}"))], "_row")
    kept = rows.where(whole).groupBy(*keys).agg((F.max if last else F.min)(rank).alias("_best")).select(*keys, F.col("_best._row").alias("_kept"))
    return remove_unless(rows.join(kept, list(keys), "left"), ~whole | (F.col("_row") == F.col("_kept")), reason).select(df.columns)


def convert(df: DataFrame, column: str, to: Column) -> DataFrame:
    """Replaces a column by a conversion of it and remembers the rows whose value was lost."""
    return take(df.withColumn(f"_value_{column}", to), [column])


def convert_all(df: DataFrame, to: dict[str, tuple]) -> DataFrame:
    """``convert`` for several columns by staged conversions, such as ``clean.NUMBER``."""
    return take(read_as(df, {f"_value_{c}": (c, how) for c, how in to.items()}), list(to))


def take(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Puts ``_value_<column>`` in place of each column and remembers what was lost."""
    before = lambda c: F.coalesce(F.col(LOSS + c), F.lit(False)) if LOSS + c in df.columns else F.lit(False)
    lost = {LOSS + c: before(c) | (F.col(c).isNotNull() & F.col(f"_value_{c}").isNull()) for c in columns}
    return df.withColumns(lost | {c: F.col(f"_value_{c}") for c in columns}).drop(*[f"_value_{c}" for c in columns])


def accepted(tagged: DataFrame) -> DataFrame:
    return drop_lineage(tagged.where(live()))


def removed(tagged: DataFrame) -> DataFrame:
    return tagged.where(~live())


def audit_ids(raw: DataFrame, processed: DataFrame, *, fan_out: bool = False) -> DataFrame:
    """One row: ids missing, unknown, null and duplicate among the processed, and whether tracking passed."""
    before = raw.select(F.col(ROW_ID).alias("id")).distinct()
    after = processed.groupBy(F.col(ROW_ID).alias("id")).agg(F.count("*").alias("n"))
    both = before.withColumn("b", F.lit(1)).join(after.where("id is not null").withColumn("a", F.lit(1)), "id", "full")
    counts = both.agg(F.count_if(F.col("a").isNull()).alias("missing_ids"), F.count_if(F.col("b").isNull()).alias("unknown_ids"), F.count_if(F.col("n") > 1).alias("duplicate_ids"))
    nulls = after.agg(F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("null_ids"))
    clean = (F.col("unknown_ids") == 0) & (F.col("null_ids") == 0) & (F.lit(fan_out) | (F.col("duplicate_ids") == 0))
    return counts.crossJoin(nulls).withColumn("passed", clean)  # two frames of one row each


def reconcile(tagged: DataFrame) -> DataFrame:
    """One row: raw, processed and removed rows, and the removed with and without a reason."""
    return tagged.agg(
        F.count("*").alias("raw_rows"),
        F.count_if(live()).alias("processed_rows"),
        F.count_if(~live()).alias("removed_rows"),
        F.count_if(~live() & F.exists(REASONS, lambda r: r != "")).alias("explained_rows"),
        F.count_if(~live() & ~F.exists(REASONS, lambda r: r != "")).alias("unexplained_rows"),
    ).withColumn("matches", F.col("raw_rows") == F.col("processed_rows") + F.col("removed_rows"))


def reason_counts(tagged: DataFrame) -> DataFrame:
    return tagged.select(F.explode(REASONS).alias("reason")).groupBy("reason").agg(F.count("*").alias("rows"))


def reconcile_frames(raw: DataFrame, processed: DataFrame, reasons: DataFrame, *, strict_unexplained: bool = False) -> DataFrame:
    """The same from separate frames: ``reasons`` has the row id and a reason, several for a row if need be."""
    gone = raw.select(ROW_ID).join(processed.select(ROW_ID), ROW_ID, "left_anti")
    told = gone.join(reasons.select(ROW_ID).distinct(), ROW_ID, "left_semi")
    misnamed = reasons.join(processed.select(ROW_ID), ROW_ID, "left_semi")
    one = lambda df, name: df.agg(F.count("*").alias(name))
    out = one(raw, "raw_rows").crossJoin(one(processed, "processed_rows")).crossJoin(one(gone, "removed_rows")).crossJoin(one(told, "explained_rows")).crossJoin(one(misnamed, "misnamed_rows"))
    out = out.withColumn("unexplained_rows", F.col("removed_rows") - F.col("explained_rows"))
    fine = (F.col("raw_rows") == F.col("processed_rows") + F.col("removed_rows")) & (F.col("misnamed_rows") == 0)
    return out.withColumn("matches", fine & (F.col("unexplained_rows") == 0) if strict_unexplained else fine)


def null_transitions(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: cells that became null, by column and in all, and rows with any; joined on the row id."""
    pair = before.select(ROW_ID, *[F.col(c).alias(f"_b_{c}") for c in columns]).join(after.select(ROW_ID, *columns), ROW_ID)
    lost = {c: F.col(f"_b_{c}").isNotNull() & F.col(c).isNull() for c in columns}
    return _transitions(pair, lost)


def conversion_loss(tagged: DataFrame) -> DataFrame:
    """The same from the loss columns of ``convert``, in one pass over live rows."""
    return _transitions(tagged.where(live()), {c.removeprefix(LOSS): F.col(c) for c in tagged.columns if c.startswith(LOSS)})


def _transitions(df: DataFrame, lost: dict[str, Column]) -> DataFrame:
    any_lost = F.lit(False)
    for c in lost.values():
        any_lost = any_lost | c
    out = df.agg(*[F.count_if(c).alias(f"lost_{k}") for k, c in lost.items()], F.count_if(any_lost).alias("affected_rows"))
    total = F.lit(0).cast("long")
    for k in lost:
        total = total + F.col(f"lost_{k}")
    return out.withColumn("lost_cells", total)


def null_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows, and nulls by column."""
    return df.agg(F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])
