"""The dataset job: read RAW, process and audit, validate, publish by policy, record the run.

A job takes one dataset from its specification. Its tables are published together or not at all, and every run is recorded
by its id, a failed one with the stage that it failed in. Phases run their datasets one after another; a failure
skips the following phases, not the other datasets of its own.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions import clean
from sluice.operators import profile
from sluice.plans.processors import PROCESSORS, SEQ
from sluice.plans.publish import Parts, Warehouse, record_run
from sluice.plans.specs import VALIDATORS, DatasetSpec, LoadPolicy
from sluice.sources import files

#: Members of keys that say the day of an observation: time series are split by it.
DAYS = ("baseDate", "observation_time_key")


@dataclass
class JobResult:
    """Rows and null cells of each published table, the audits, and seconds by stage."""

    dataset: str
    tables: dict[str, dict] = field(default_factory=dict)
    audits: dict[str, profile.Audit] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)
    stage: str = ""

    @property
    def dq_status(self) -> str | None:
        """Null without an audit, PASSED if all passed, otherwise FAILED."""
        if not self.audits:
            return None
        return "PASSED" if all(a.status == "PASS" for a in self.audits.values()) else "FAILED"


@contextmanager
def _timed(result: JobResult, stage: str):
    result.stage, began = stage, time.perf_counter()
    try:
        yield
    finally:
        result.seconds[stage] = round(time.perf_counter() - began, 3)


def duration(seconds: float) -> str:
    """Hours, minutes and seconds as text: 1h 02m 03s, 2m 03s or 3.2s."""
    whole = int(seconds)
    hours, minutes = whole // 3600, whole % 3600 // 60
    if hours:
        return f"{hours}h {minutes:02d}m {whole % 60:02d}s"
    return f"{minutes}m {whole % 60:02d}s" if minutes else f"{seconds:.1f}s"


def process_table(spec, raw: DataFrame) -> tuple[DataFrame, profile.Audit]:
    """The accepted rows of one table's processor and the audit of what it did."""
    if not spec.allow_empty and raw.isEmpty():
        raise ValueError(f"raw.{spec.table} has no rows")
    keys = spec.upsert_key or spec.primary_key
    fan_out = spec.processor == "weather_warning_status"
    out, found = profile.audit(spec.table, raw, PROCESSORS[spec.processor], SEQ, dedup_keys=keys, fan_out=fan_out)
    out = out.drop(SEQ)
    if not spec.allow_empty and not found.rows["processed_rows"]:
        raise ValueError(f"processed.{spec.table} has no rows")
    empty = [c for c in clean.empty_columns(raw, out) if c not in keys]
    return out.drop(*empty), found


def load_dataset(spec: DatasetSpec, read_raw: Callable[[str], DataFrame], warehouse: Warehouse, result: JobResult | None = None) -> JobResult:
    """One dataset from RAW tables (with a place column ``_ingest_seq``) to the warehouse."""
    result = result or JobResult(spec.name)
    with _timed(result, "source_read"):
        raws = {t.table: read_raw(t.table) for t in spec.tables}
    frames: dict[str, DataFrame] = {}
    with _timed(result, "process"):
        for t in spec.tables:
            frames[t.table], result.audits[t.table] = process_table(t, raws[t.table])
    with _timed(result, "validate"):
        if spec.validator is not None:
            if spec.validator not in VALIDATORS:
                raise KeyError(f"{spec.name}: no validator {spec.validator}")
            VALIDATORS[spec.validator](frames)
    with _timed(result, "db"):
        if spec.policy is LoadPolicy.TIMESERIES:
            days = {t.table: Parts(next(c for c in t.upsert_key if c in DAYS)) for t in spec.tables if set(DAYS) & set(t.upsert_key)}
            warehouse.upsert(spec.name, frames, {t.table: t.upsert_key for t in spec.tables}, parts=days)
        else:
            warehouse.replace(
                spec.name, frames, allow_empty=[t.table for t in spec.tables if t.allow_empty], primary_keys={t.table: t.primary_key for t in spec.tables if t.primary_key},
                cluster_by={t.table: t.cluster_by for t in spec.tables if t.cluster_by}, expected={t: a.rows["processed_rows"] for t, a in result.audits.items()},
            )
        for table in frames:
            result.tables[table] = cells(warehouse.read(spec.name, table))
    return result


def load_csv(warehouse: Warehouse, dataset: str, table: str, path, *, expected: int | None = None, primary_key: tuple[str, ...] = ()) -> dict[str, int]:
    """Publishes a CSV as it is, with its places, and gives the rows counted on the way: parsed, staged and published.

    ``expected`` is what the source says it sent. Any count that differs from the one before stops the load; before the
    publication nothing is changed.
    """
    raw = files.read_csv(warehouse.spark, path, sequence=True)
    counts = {"parsed": files.csv_report(raw)["rows"]}
    if expected is not None and counts["parsed"] != expected:
        raise ValueError(f"{table}: {counts['parsed']} rows parsed, {expected} sent")
    keys = {table: primary_key} if primary_key else None
    counts["staged"] = warehouse.replace(dataset, {table: raw}, expected={table: counts["parsed"]}, primary_keys=keys)[table]
    counts["published"] = warehouse.read(dataset, table).count()
    if counts["published"] != counts["staged"]:
        raise ValueError(f"{table}: {counts['published']} rows published, {counts['staged']} staged")
    return counts


def cells(df: DataFrame) -> dict[str, int]:
    """Rows and null cells of a table."""
    nulls = F.lit(0).cast("long")
    for c in df.columns:
        nulls = nulls + F.col(f"`{c}`").isNull().cast("long")
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(nulls), F.lit(0)).alias("nulls")).first().asDict()


def run_job(spec: DatasetSpec, read_raw: Callable[[str], DataFrame], warehouse: Warehouse, run_id: str | None = None) -> JobResult:
    """``load_dataset`` with its run recorded, whatever its end; a failure is raised again."""
    result, started, error = JobResult(spec.name), datetime.now(timezone.utc), None
    try:
        return load_dataset(spec, read_raw, warehouse, result)
    except Exception as e:
        error = e
        raise
    finally:
        finished = datetime.now(timezone.utc)
        told = {"failure_stage": result.stage, "error_type": type(error).__name__, "error_message": str(error)[:2000]} if error else {}
        record_run(
            warehouse,
            {
                "run_id": run_id or uuid.uuid4().hex, "job_id": spec.name, "dataset": spec.name, "source_kind": "raw_database", "run_status": "FAILED" if error else "SUCCESS", "dq_status": result.dq_status,
                "results": json.dumps(result.tables, sort_keys=True), "dq_results": json.dumps({t: a.status for t, a in result.audits.items()}, sort_keys=True), "stage_durations": json.dumps(result.seconds, sort_keys=True),
                "started_at": started, "finished_at": finished, "created_at": finished, "elapsed_seconds": (finished - started).total_seconds(), **told,
            },
        )


def run_phases(phases: Iterable[Iterable[DatasetSpec]], run: Callable[[DatasetSpec], object]) -> tuple[list[str], list[str]]:
    """Names of the datasets that failed and of those that were skipped; a phase is skipped after a failure in one before."""
    failed, skipped = [], []
    for phase in phases:
        if failed:
            skipped += [d.name for d in phase]
            continue
        for d in phase:
            try:
                run(d)
            except Exception:
                failed.append(d.name)
    return failed, skipped
