"""Declarations of tables and datasets, and the registries that tie them to processors and validators."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from enum import Enum
from typing import Protocol

from pyspark.sql import DataFrame


class LoadPolicy(Enum):
    SNAPSHOT = "snapshot"
    TIMESERIES = "timeseries"


@dataclass(frozen=True)
class TableSpec:
    """A physical table: its processor, how it is loaded, and its keys. ``cluster_by`` orders files for pruning."""

    table: str
    processor: str
    allow_empty: bool = False
    primary_key: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    load_policy: LoadPolicy = LoadPolicy.SNAPSHOT
    upsert_key: tuple[str, ...] = ()

    def __post_init__(self):
        check_names([self.table], [*self.primary_key, *self.cluster_by, *self.upsert_key])
        if (self.load_policy is LoadPolicy.TIMESERIES) != bool(self.upsert_key):
            raise ValueError(f"{self.table}: a time series, and only that, has an upsert key")


@dataclass(frozen=True)
class DatasetSpec:
    """Tables that are collected, checked and published together."""

    name: str
    tables: tuple[TableSpec, ...]
    cron: str = "0 6 * * *"
    validator: str | None = None
    attempts: int = 3
    run_order: int = 0
    run_last: bool = False

    @property
    def policy(self) -> LoadPolicy:
        kinds = {t.load_policy for t in self.tables}
        if len(kinds) != 1:
            raise ValueError(f"{self.name} mixes load policies")
        return kinds.pop()


class MetadataProvider(Protocol):
    """Where specifications come from."""

    def datasets(self) -> Iterable[DatasetSpec]: ...


def check_names(tables: Iterable[str], columns: Iterable[str] = ()) -> None:
    """Identifiers must be plain, as they become paths and columns."""
    for t in tables:
        if not re.fullmatch(r"[a-z][a-z0-9_]*", t):
            raise ValueError(f"bad table name {t!r}")
    for c in columns:
        if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", c):
            raise ValueError(f"bad column name {c!r}")


_SERIES = {"load_policy": LoadPolicy.TIMESERIES}
_CULTURE = ("public_sports_facilities", "public_sports_facility_programs", "sports_facility_nearby_public_transport", "national_sports_facility_status", "location_fitness_measurement_prescriptions", "open_school_sports_facilities", "sports_facility_safety_inspections", "fitness_measurement_prescriptions")


class Catalog:
    """The datasets of the library; each table has one owner."""

    def __init__(self, datasets: Iterable[DatasetSpec] | None = None):
        self._datasets = tuple(datasets) if datasets is not None else DEFAULT
        owners = [t.table for d in self._datasets for t in d.tables]
        if len(owners) != len(set(owners)):
            raise ValueError("a table has two owners")

    def datasets(self) -> tuple[DatasetSpec, ...]:
        return self._datasets

    def tables(self) -> dict[str, TableSpec]:
        return {t.table: t for d in self._datasets for t in d.tables}

    def phases(self) -> list[list[DatasetSpec]]:
        """The usual datasets in their run order, then those to run last; a failure skips the phase after it."""
        ordered = sorted(self._datasets, key=lambda d: d.run_order)
        return [phase for phase in ([d for d in ordered if not d.run_last], [d for d in ordered if d.run_last]) if phase]


DEFAULT = (
    DatasetSpec("weather", (TableSpec("weather_ultra_ncst", "weather", upsert_key=("baseDate", "baseTime", "nx", "ny", "category"), **_SERIES), TableSpec("weather_ultra_fcst", "weather", upsert_key=("baseDate", "baseTime", "fcstDate", "fcstTime", "nx", "ny", "category"), **_SERIES))),
    DatasetSpec("air_quality", (TableSpec("air_quality", "air_quality", upsert_key=("sidoName", "stationName", "observation_time_key"), **_SERIES),)),
    DatasetSpec("weather_warning", (TableSpec("weather_warning", "weather_warning"), TableSpec("weather_warning_status", "weather_warning_status", allow_empty=True))),
    DatasetSpec("trails", (TableSpec("durunubi_trails", "trails", primary_key=("routeIdx",)), TableSpec("durunubi_segments", "segments", primary_key=("crsIdx",), cluster_by=("routeIdx",))), validator="segments_have_trails"),
    DatasetSpec("facility", (TableSpec("facility", "facility", cluster_by=("faci_cd",)),)),
    DatasetSpec("public_open_facility", (TableSpec("public_open_facility", "public_open_facility"),)),
    DatasetSpec("aed", (TableSpec("aed", "aed"),)),
    DatasetSpec("bicycle", (TableSpec("koroad_bicycle_accident_hotspots", "bicycle", primary_key=("afos_fid",), cluster_by=("si_do", "gu_gun")),)),
    DatasetSpec("culture", tuple(TableSpec(f"culture_{t}", f"culture_{t}") for t in _CULTURE), run_order=1, run_last=True),
)

VALIDATORS: dict[str, Callable[[dict[str, DataFrame]], None]] = {}


def validator(name: str):
    def register(check):
        VALIDATORS[name] = check
        return check

    return register


@validator("segments_have_trails")
def _segments_have_trails(frames: dict[str, DataFrame]) -> None:
    from sluice.operators.select import require_no_orphans

    require_no_orphans(frames["durunubi_segments"], frames["durunubi_trails"], "routeIdx")
