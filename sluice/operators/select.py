"""Latest, nearest and top rows, and the joins built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The one latest row, nulls first; a top-1, no sort."""
    return df.orderBy(*[c.desc_nulls_last() for c in order]).limit(1)


def latest_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The latest row of each group as an aggregate, so groups of any size are reduced before the exchange."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).alias("_row"))
    return best.select(*keys, "_row.*")


def nearest(left: DataFrame, right: DataFrame, on: Sequence[str], accept: Column, rank: Sequence[Column], key: Sequence[str], how: str = "left") -> DataFrame:
    """As-of join: of the ``right`` rows with equal ``on`` that ``accept`` admits, the one of least ``rank``.

    ``key`` names the left rows. The pairs are reduced to one by an aggregate over the join's output, never sorted.
    Columns of both sides must have different names besides ``on``.
    """
    pairs = left.join(right, list(on)).where(accept)
    taken = [c for c in right.columns if c not in on]
    best = pairs.groupBy(*key).agg(F.min_by(F.struct(*taken), F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rank)])).alias("_best"))
    return left.join(best, list(key), how).select(*left.columns, "_best.*")


def top(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows; Spark keeps k a task."""
    return df.orderBy(*order).limit(k)


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Rows whose key is not null and has no parent."""
    keys = parent.select(F.col(parent_key or key).alias("_parent")).distinct()
    return child.where(F.col(key).isNotNull()).join(keys, F.col(key) == F.col("_parent"), "left_anti")


def require_no_orphans(child: DataFrame, parent: DataFrame, key: str) -> None:
    """Raises with the count and up to ten values."""
    lost = orphans(child, parent, key)
    if n := lost.count():
        raise ValueError(f"{n} orphans of {key}: {sorted(r[0] for r in lost.select(key).distinct().limit(10).collect())}")


def attach_unique(left: DataFrame, right: DataFrame, identity: Sequence[str]) -> DataFrame:
    """Left outer join that attaches a right row only where the identity (null equals null) has exactly one."""
    rest = [c for c in right.columns if c not in identity]
    once = right.groupBy(*[F.col(c).alias(f"_{c}") for c in identity]).agg(F.count("*").alias("_n"), F.first(F.struct(*rest)).alias("_row")).where("_n = 1")
    match = F.lit(True)
    for c in identity:
        match = match & left[c].eqNullSafe(once[f"_{c}"])
    return left.join(once, match, "left").select(*[left[c] for c in left.columns], "_row.*")


def fill_blanks(df: DataFrame, suggestions: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Blank fields take the suggestion of their key; others stay."""
    offered = suggestions.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    blank = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == ""
    return df.join(offered, key, "left").withColumns({c: F.when(blank(c), F.coalesce(F.col(f"_new_{c}"), F.col(c))).otherwise(F.col(c)) for c in columns}).drop(*[f"_new_{c}" for c in columns])
