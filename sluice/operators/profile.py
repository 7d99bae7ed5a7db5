"""Column statistics and the end-to-end audit of a processor."""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.clean import normalize_nulls, strip
from sluice.operators import dedup, lineage
from sluice.operators.ranges import sorted_ranges
from sluice.operators.staging import staged

STATISTICS = ("rows", "nulls", "null_rate", "distinct", "distinct_rate", "minimum", "maximum", "mean", "median", "infinite", "min_length", "max_length", "blank", "earliest", "latest")


def _finite(c: Column) -> Column:
    return F.when(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), c.cast("double"))


def _fits(kind: T.DataType) -> str:
    """Which statistics fit a type: those of numbers, of texts, of dates, of times, or none."""
    kinds = {"number": T.NumericType, "text": T.StringType, "date": T.DateType, "time": (T.TimestampType, T.TimestampNTZType)}
    return next((name for name, of in kinds.items() if isinstance(kind, of)), "")


def counted_values(frames: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """(i, given, number, infinite, length, blank, moment, n0, n1, ...): what the statistics need of each value of column i, null
    included, and how often each of the ``frames``, whose columns have the same types, has it.

    Each column is read and counted by itself in its own type; the frames' rows meet in the tasks before they are exchanged.
    """
    parts = []
    for i, c in enumerate(columns):
        kind, v = frames[0].schema[c].dataType, F.col("v")
        value = F.col(f"`{c}`")
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            value = F.when(value.isNotNull(), F.to_json(F.struct(value.alias("v"))))
        rows = functools.reduce(DataFrame.union, [df.select(value.alias("v"), F.lit(k).alias("k")) for k, df in enumerate(frames)])
        counts = [F.count_if(F.col("k") == k).alias(f"n{k}") for k in range(len(frames))]
        fits = _fits(kind)
        facts = {
            "number": (fits == "number", _finite(v), "double"),
            "infinite": (fits == "number", F.abs(v.cast("double")) == float("inf"), "boolean"),
            "length": (fits == "text", F.length(v), "long"),
            "blank": (fits == "text", strip(v) == "", "boolean"),
            "moment": (fits in ("date", "time"), F.unix_date(v) if fits == "date" else F.unix_micros(v.cast("timestamp")), "long"),
        } if fits else {}
        facts = [(facts[k][1] if facts and facts[k][0] else F.lit(None)).cast(as_).alias(k) for k, as_ in _FACTS.items()]
        parts.append(rows.groupBy("v").agg(*counts).select(F.lit(i).alias("i"), v.isNotNull().alias("given"), *facts, *[f"n{k}" for k in range(len(frames))]))
    return functools.reduce(DataFrame.union, parts)


_FACTS = {"number": "double", "infinite": "boolean", "length": "long", "blank": "boolean", "moment": "long"}


def medians(placed: DataFrame, n: str) -> DataFrame:
    """(i, median) of values in sorted ranges, each ``n`` times: counts of ranges say which ranges hold the middle one or two
    values, and only those are looked through."""
    parts = placed.groupBy("i", "_range").agg(F.sum(n).alias("m"))  # a row for each range, and for each column in it
    before = F.coalesce(F.sum("m").over(Window.partitionBy("i").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    low, high = F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)
    parts = parts.select("i", "_range", "m", before.alias("before"), F.sum("m").over(Window.partitionBy("i")).alias("total"))
    parts = parts.where((F.col("before") <= high) & (F.col("before") + F.col("m") > low)).drop("m")
    upto = F.sum(n).over(Window.partitionBy("i", "_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    held = placed.join(F.broadcast(parts), ["i", "_range"]).withColumn("upto", F.col("before") + upto)
    holds = lambda k: (F.col("upto") > k) & (F.col("upto") - F.col(n) <= k)
    return held.groupBy("i").agg(((F.max(F.when(holds(low), F.col("number"))) + F.max(F.when(holds(high), F.col("number")))) / 2).alias("median"))


def _profiles(frames: Sequence[DataFrame], columns: Sequence[str]) -> list[DataFrame]:
    """A profile of each frame, from values that are counted once for all; the frames' columns have the same types."""
    spark, kinds = frames[0].sparkSession, [frames[0].schema[c].dataType for c in columns]
    counts = staged(counted_values(frames, columns), "counted-values")
    placed = sorted_ranges(counts.where("number is not null").select("i", "number", *[f"n{k}" for k in range(len(frames))]), ["i", "number"], "values")
    names = spark.createDataFrame([(i, c, kind.simpleString(), _fits(kind)) for i, (c, kind) in enumerate(zip(columns, kinds))], "i int, column string, type string, fits string")

    def one(n: str) -> DataFrame:
        times = lambda where: F.coalesce(F.sum(F.when(where, F.col(n))), F.lit(0))
        of, number = counts.where(F.col(n) > 0), F.col("number")
        found = of.groupBy("i").agg(
            F.sum(n).alias("rows"), times(~F.col("given")).alias("nulls"), F.count_if("given").alias("distinct"),
            F.min(number).alias("minimum"), F.max(number).alias("maximum"), F.try_divide(F.sum(number * F.col(n)), F.sum(F.when(number.isNotNull(), F.col(n)))).alias("mean"),
            times(F.col("infinite")).alias("infinite"), F.min("length").alias("min_length"), F.max("length").alias("max_length"), times(F.col("blank")).alias("blank"),
            F.min("moment").alias("earliest"), F.max("moment").alias("latest"),
        )
        out = names.join(F.broadcast(found), "i", "left").join(F.broadcast(medians(placed, n)), "i", "left")
        whole = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
        fit = lambda c, kind: F.when(F.col("fits") == kind, F.coalesce(c, F.lit(0))).cast("long")
        moment = lambda c: F.when(F.col("fits") == "date", F.date_from_unix_date(F.col(c).cast("int")).cast("string")).when(F.col("fits") == "time", F.timestamp_micros(c).cast("string"))
        out = out.withColumns({c: whole(c) for c in ("rows", "nulls", "distinct")} | {"infinite": fit("infinite", "number"), "blank": fit("blank", "text"), "earliest": moment("earliest"), "latest": moment("latest")})
        return out.withColumns({"null_rate": F.try_divide("nulls", "rows"), "distinct_rate": F.try_divide("distinct", "rows")}).select("column", "type", *STATISTICS)

    return [one(f"n{k}") for k in range(len(frames))]


def column_profiles(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A row for each column, all from values that are counted once.

    Values are counted in the tasks before they are exchanged, and medians come from counts over sorted ranges, so no column
    is gathered in one task and the input is not expanded by the number of columns or distinct counts.
    """
    return _profiles([df], list(columns or df.columns))[0]


def both_profiles(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """Profiles of the raw and the processed columns under one another; columns of the same types are counted together."""
    kinds = [[(f.name, f.dataType) for f in df.schema if not f.name.startswith("_")] for df in (raw, processed)]
    names = [[c for c, _ in of] for of in kinds]
    one, other = _profiles([raw, processed], names[0]) if kinds[0] == kinds[1] else (column_profiles(raw, names[0]), column_profiles(processed, names[1]))
    return one.withColumn("frame", F.lit("raw")).unionByName(other.withColumn("frame", F.lit("processed")))


def review_metrics(df: DataFrame, flag: str = "needs_review") -> DataFrame:
    share = F.try_divide(F.count_if(F.coalesce(F.col(flag), F.lit(False))), F.count("*"))
    return df.agg(F.count("*").alias("rows"), F.count_if(F.coalesce(F.col(flag), F.lit(False))).alias("review_rows"), share.alias("review_rate"))


@dataclass
class Audit:
    """What an audit found; ``status`` is PASS or CHECK_FAILED."""

    dataset: str
    status: str
    tracking: dict
    rows: dict
    reasons: dict
    losses: dict
    duplicates: dict = field(default_factory=dict)
    review: dict = field(default_factory=dict)
    issues: list[str] = field(default_factory=list)

    def as_dict(self) -> dict:
        return asdict(self)

    def rules(self) -> dict[str, dict]:
        """Expected, observed and status of each rule; only the first two judge, the others are observations."""
        judge = lambda fine: "PASS" if fine else "FAIL"
        ids, rows = self.tracking, self.rows
        none = {"status": "NOT_APPLICABLE"}
        return {
            "row_tracking": {"expected": {"unknown": 0, "null": 0, "duplicate": 0}, "observed": {k: ids[f"{k}_ids"] for k in ("missing", "unknown", "null", "duplicate")}, "status": judge(ids["passed"])},
            "row_reconciliation": {"expected": rows["raw_rows"] - rows["removed_rows"], "observed": rows["processed_rows"], "status": judge(rows["matches"])},
            "null_transition": {"expected": "no configured threshold", "observed": {"conversion": self.losses.get("lost_cells", 0)}, **none},
            "dedup": {"expected": "no configured rule", "observed": {"duplicate_rows": self.duplicates.get("duplicate_rows", 0)}, **none},
            "needs_review": {"expected": "no configured threshold", "observed": self.review.get("review_rows", 0), **none},
            "column_profile": {"expected": "observation only", "observed": "see the profiles", **none},
        }


def audit(dataset: str, raw: DataFrame, processor: Callable[[DataFrame], DataFrame], sequence: str, *, dedup_keys: Sequence[str] = (), fan_out: bool = False, strict_unexplained: bool = False) -> tuple[DataFrame, Audit]:
    """Runs a tagging processor on ``raw`` with lineage and returns its accepted rows and the audit.

    The tagged rows are written once; the aggregates, each of one row, and the publication read that table.
    """
    before = lineage.add_lineage(raw, dataset, sequence)
    tagged = staged(processor(before), "audited")
    one = lambda df: df.first().asDict()
    live = tagged.where(lineage.live())
    tracking = one(lineage.audit_ids(before, tagged, fan_out=fan_out))
    rows = one(lineage.reconcile(tagged))
    reasons = {r["reason"]: r["rows"] for r in lineage.reason_counts(tagged).collect()}
    losses = one(lineage.conversion_loss(tagged))
    keys = [k for k in dedup_keys if k in raw.columns]
    payload = [c for c in raw.columns if c not in (*keys, sequence)]
    duplicates = one(dedup.metrics(normalize_nulls(raw), keys, payload)) if keys and payload else {}
    review = one(review_metrics(live)) if "needs_review" in tagged.columns else {}
    issues = [] if tracking["passed"] else ["lineage"]
    if not rows["matches"]:
        issues.append("row counts")
    if strict_unexplained and rows["unexplained_rows"]:
        issues.append("unexplained removals")
    found = Audit(dataset, "CHECK_FAILED" if issues else "PASS", tracking, rows, reasons, losses, duplicates, review, issues)
    return lineage.accepted(tagged), found
