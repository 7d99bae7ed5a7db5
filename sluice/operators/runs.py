"""Summaries over run history."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _totals() -> list[Column]:
    names = lambda when, what: F.array_sort(F.collect_set(F.when(when, F.col(what))))
    run, dq = F.col("run_status"), F.col("dq_status")
    return [
        F.count("*").alias("total_runs"),
        F.count_if(run == "SUCCESS").alias("succeeded"),
        F.count_if(run == "WARNING").alias("warned"),
        F.count_if(run == "FAILED").alias("failed"),
        F.count_if(dq == "PASSED").alias("dq_passed"),
        F.count_if(dq == "FAILED").alias("dq_failed"),
        F.avg("elapsed_seconds").alias("avg_seconds"),
        F.max("elapsed_seconds").alias("max_seconds"),
        F.coalesce(F.max_by("job_id", F.struct("elapsed_seconds", "job_id")), F.min("job_id")).alias("slowest_job"),
        names(run == "FAILED", "job_id").alias("failed_jobs"),
        names(dq == "FAILED", "job_id").alias("dq_failed_jobs"),
        names(run == "FAILED", "failure_stage").alias("failure_stages"),
    ]


def operations(runs: DataFrame, start: Column, end: Column, at: str = "finished_at") -> DataFrame:
    """One row for the half-open period: counts by status, times, the slowest job, jobs and stages that failed."""
    return runs.where((F.col(at) >= start) & (F.col(at) < end)).agg(*_totals())


def report_periods(days: DataFrame, day: str = "day") -> DataFrame:
    """(label, start, end): the night before and the daytime of each day, by the hours of ``report_period``."""
    at = lambda days, hours, minutes: F.col(day).cast("timestamp_ntz") + F.make_dt_interval(days=F.lit(days), hours=F.lit(hours), mins=F.lit(minutes))
    kinds = F.array(
        F.struct(F.lit("night").alias("label"), at(-1, 17, 0).alias("start"), at(0, 9, 15).alias("end")),
        F.struct(F.lit("day").alias("label"), at(0, 9, 15).alias("start"), at(0, 17, 0).alias("end")),
    )
    return days.select(day).distinct().select(F.inline(kinds)).distinct()


def by_period(runs: DataFrame, periods: DataFrame, at: str = "finished_at", bucket_hours: int = 6) -> DataFrame:
    """``operations`` of every period of a table with start and end (half-open, of any length, overlapping or not).

    A range join by buckets of time: a period stands in each bucket that it touches and meets the runs of these alone.
    Periods without a run give no row.
    """
    bucket = lambda c: F.floor(F.unix_micros(c.cast("timestamp")) / (bucket_hours * 3_600_000_000)).cast("long")
    last = F.col("end") - F.expr("INTERVAL 0.000001 SECOND")
    spread = periods.where("start < end").withColumn("_bucket", F.explode(F.sequence(bucket(F.col("start")), bucket(last))))
    met = runs.withColumn("_bucket", bucket(F.col(at))).join(spread, "_bucket").where((F.col(at) >= F.col("start")) & (F.col(at) < F.col("end")))
    return met.groupBy(*periods.columns).agg(*_totals())


def dq_rollup(statuses: DataFrame, run: str, status: str = "dq_status") -> DataFrame:
    """A run's status: null without any, PASSED if all passed, otherwise FAILED."""
    known = F.count(F.col(status))
    return statuses.groupBy(run).agg(F.when(known == 0, None).when(F.count_if(F.col(status) == "PASSED") == known, "PASSED").otherwise("FAILED").alias("dq_status"))


def report_period(now: datetime) -> tuple[datetime, datetime] | None:
    """The period that a report due now covers: at 09:15 since 17:00 the day before, at 17:00 since 09:15."""
    from datetime import timedelta

    minute = now.replace(second=0, microsecond=0)
    if (now.hour, now.minute) == (9, 15):
        return (minute - timedelta(days=1)).replace(hour=17, minute=0), minute
    if (now.hour, now.minute) == (17, 0):
        return minute.replace(hour=9, minute=15), minute
    return None


def summary_text(row: dict) -> str:
    """The report of ``operations``' row."""
    lines = [f"runs {row['total_runs']}: {row['succeeded']} succeeded, {row['warned']} warned, {row['failed']} failed", f"quality: {row['dq_passed']} passed, {row['dq_failed']} failed"]
    if row["avg_seconds"] is not None:
        lines.append(f"seconds: {row['avg_seconds']:.1f} on average, {row['max_seconds']:.1f} at most ({row['slowest_job']})")
    for what in ("failed_jobs", "dq_failed_jobs", "failure_stages"):
        if row[what]:
            lines.append(f"{what.replace('_', ' ')}: {', '.join(row[what])}")
    return "\n".join(lines)


def transient(text: Column) -> Column:
    """Whether an error text tells of a passing fault; markers that forbid a retry come first."""
    lower = F.lower(text)
    has = lambda words: reduce(lambda a, b: a | b, [F.contains(lower, F.lit(w)) for w in words])
    return F.coalesce(~has(DAILY_LIMIT) & has(PASSING), F.lit(False))


# Texts of a spent daily allowance, which no retry mends on the same day, and of faults that may pass.
DAILY_LIMIT = ("limited_number_of_service_requests_exceeds_error", 'returnreasoncode": "22', "일일 서비스 요청제한 횟수 초과")
PASSING = ("timeout", "timed out", "connectionerror", "connection error", "connection reset", "temporarily unavailable", "too many requests", "http 429", "http 502", "http 503", "http 504", "시간 초과", "네트워크 오류", "요청 최종 실패", "재시도 후에도 실패")
