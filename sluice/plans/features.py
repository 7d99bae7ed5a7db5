"""Features of places: opening hours, weather on a grid, air quality of a region, and candidates built from these.

Tables of weather and air are first bound to what was collected within the age limits (``read_environment``). Places are
reduced to their distinct cells, regions, stations and times, and these meet weather and air by as-of merges, never row
by row. Times are local and without zone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions import clean, geo, schedule
from sluice.functions.values import FEATURE_NULL_TOKENS, INDOOR, NO_RAIN, OUTDOOR
from sluice.operators import ranges
from sluice.operators.dedup import content_key
from sluice.operators.staging import staged


@dataclass(frozen=True)
class EnvironmentConfig:
    """Limits in minutes and thresholds; nonsensical ones are refused."""

    observation_age: int = 90
    forecast_age: int = 180
    forecast_offset: int = 60
    air_age: int = 120
    cold: float = 5.0
    hot: float = 30.0
    pm10: float = 81.0
    pm25: float = 36.0

    def __post_init__(self):
        if not all(math.isfinite(v) for v in vars(self).values()):
            raise ValueError("limits and thresholds must be finite")
        if min(self.observation_age, self.forecast_age, self.forecast_offset, self.air_age, self.pm10, self.pm25) <= 0 or self.cold >= self.hot:
            raise ValueError("limits must be positive, cold must be below hot")


#: The components of weather that are chosen, each for itself.
COMPONENTS = ("T1H", "PTY", "RN1")


def feature_text(c: Column) -> Column:
    return clean.normalize(c.cast("string"), FEATURE_NULL_TOKENS)


def feature_number(c: Column) -> Column:
    value = clean.number(c)
    return F.when(F.abs(value) < float("inf"), value)


def _clock(text: Column) -> Column:
    """The time since midnight from HHMM."""
    at = F.when(text.rlike(r"^([01]\d|2[0-3])[0-5]\d$"), text)
    return F.make_dt_interval(hours=F.substring(at, 1, 2).cast("int"), mins=F.substring(at, 3, 2).cast("int"))


def weather_time(day: Column, time: Column) -> Column:
    """A moment from a date (yyyyMMdd or ISO) and HHMM."""
    return clean.moment(feature_text(day)).cast("date").cast("timestamp_ntz") + _clock(feature_text(time))


def _minutes(later: Column, earlier: Column) -> Column:
    return F.timestamp_diff("SECOND", earlier, later) / 60


def weather_rows(observations: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Both kinds as (nx, ny, category, kind, value, issued, valid, collected)."""

    def side(df: DataFrame, kind: str, value: str, valid: tuple[str, str]) -> DataFrame:
        texts = {"_day": "baseDate", "_time": "baseTime", "_valid_day": valid[0], "_valid_time": valid[1]}
        df = clean.normalized(df.where(F.col("category").isin(*COMPONENTS)), texts, FEATURE_NULL_TOKENS)
        df = df.withColumns({c: clean.moment_of(F.col(c)).cast("date").cast("timestamp_ntz") for c in ("_day", "_valid_day")})
        moment = lambda day, time: F.col(day) + _clock(F.col(time))
        return df.select(
            F.col("nx").cast("long").alias("nx"), F.col("ny").cast("long").alias("ny"), "category", F.lit(kind).alias("kind"), F.col(value).cast("string").alias("value"),
            moment("_day", "_time").alias("issued"), moment("_valid_day", "_valid_time").alias("valid"), F.col("collected_at").cast("timestamp_ntz").alias("collected"),
        )

    return side(observations, "OBSERVATION", "obsrValue", ("baseDate", "baseTime")).union(side(forecasts, "FORECAST", "fcstValue", ("fcstDate", "fcstTime")))


def recent(df: DataFrame, now: Column, config: EnvironmentConfig = EnvironmentConfig(), at: str = "collected_at") -> DataFrame:
    """The rows of an environment table that were collected within the longest age limit; the filter reaches the scan."""
    minutes = max(config.observation_age, config.forecast_age, config.air_age)
    return df.where((F.col(at) >= now - F.make_dt_interval(mins=F.lit(minutes))) & (F.col(at) <= now)) if at in df.columns else df.limit(0)


def read_environment(observations: DataFrame, forecasts: DataFrame, air: DataFrame, now: Column, config: EnvironmentConfig = EnvironmentConfig()) -> tuple[DataFrame, DataFrame]:
    """The weather rows and air readings that were collected within the age limits; the filter reaches the scans."""
    seen = [recent(df, now, config) for df in (observations, forecasts, air)]
    return weather_rows(*seen[:2]), seen[2]


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def choose_weather(places: DataFrame, weather: DataFrame, key: str, now: Column, config: EnvironmentConfig = EnvironmentConfig()) -> DataFrame:
    """For each place (``key``, grid struct, ``target`` time): the best row of each component, and why others fell out.

    Accepted rows compete by nearness to the target, preferred kind, newest issue, newest capture, observations first, then
    the least value. Places are reduced to their distinct cells and targets, rows to the best of each cell, component, kind
    and valid time; an as-of merge in one sorted pass finds the rows beside each target, which are the nearest ones, so no
    place meets the history of its cell. Whatever rejects a row without regard to a target is an aggregate of the cell, and
    the earliest and latest valid times tell whether any row lies off a target. Cells without weather give no row.
    """
    cell, forecast = ["nx", "ny"], F.col("kind") == "FORECAST"
    fault = (
        F.when(F.col("issued").isNull() | F.col("valid").isNull() | F.col("collected").isNull(), "INVALID_TIME")
        .when((F.col("issued") > now) | (F.col("collected") > now) | (~forecast & (F.col("valid") > now)), "FUTURE_DATA")
        .when(_minutes(now, F.col("issued")) > F.when(forecast, config.forecast_age).otherwise(config.observation_age), "STALE")
        .when(forecast & (F.col("valid") < F.col("issued")), "TIME_MISMATCH")
    )
    rows = staged(weather.where(F.col("category").isin(*COMPONENTS)).withColumn("fault", fault), "weather")
    fine = F.when(F.col("fault").isNull(), F.col("valid"))
    about = rows.groupBy(*cell, "category", "kind").agg(F.collect_set("fault").alias("faults"), F.min(fine).alias("low"), F.max(fine).alias("high"))
    about = about.groupBy(*cell).agg(F.collect_list(F.struct("kind", "faults", "low", "high")).alias("about"))  # six at most

    targets = places.select(key, "target", F.col("grid.nx").alias("nx"), F.col("grid.ny").alias("ny"))
    distinct = targets.select(*cell, "target").distinct()
    kinds = F.explode(F.array(*[F.struct(F.lit(c).alias("category"), F.lit(k).alias("kind")) for c in COMPONENTS for k in ("OBSERVATION", "FORECAST")]))
    points = distinct.select(*cell, F.col("target").alias("valid"), kinds.alias("x")).select(*cell, "valid", "x.*")
    newest = [-_micros(F.col("issued")), -_micros(F.col("collected")), F.col("value")]
    beside = ranges.neighbours(points, rows.where("fault is null"), [*cell, "category", "kind"], "valid", ["value", "issued", "collected"], newest).withColumnRenamed("valid", "target")

    offset = lambda valid: _minutes(F.col("target"), valid)
    prefer = F.when(F.col("target") > now, forecast).otherwise(~forecast)

    def ranked(side: str) -> Column:
        r = F.col(side)
        fits = F.when(forecast, F.abs(offset(r["valid"])) <= config.forecast_offset).otherwise(offset(r["valid"]).between(0, config.observation_age))
        rank = F.struct(F.abs(offset(r["valid"])).alias("off"), (~prefer).cast("int").alias("kept"), (-_micros(r["issued"])).alias("issue"), (-_micros(r["collected"])).alias("capture"), forecast.cast("int").alias("late"), r["value"].alias("value"), "kind", r["issued"].alias("issued"), r["valid"].alias("valid"))
        return F.when(r.isNotNull() & fits, rank)

    best = beside.select(*cell, "target", "category", F.coalesce(F.least(ranked("before"), ranked("after")), ranked("before"), ranked("after")).alias("x"))
    part = lambda c: F.min(F.when(F.col("category") == c, F.col("x")))
    best = best.groupBy(*cell, "target").agg(*[part(c).alias(c.lower()) for c in COMPONENTS])
    shown = [F.when(F.col(c.lower()).isNotNull(), F.struct(*[F.col(f"{c.lower()}.{f}").alias(f) for f in ("value", "kind", "issued", "valid")])).alias(c.lower()) for c in COMPONENTS]
    late = F.make_dt_interval(mins=F.lit(config.forecast_offset))
    early = lambda x: F.when(x["kind"] == "FORECAST", x["low"] < F.col("target") - late).otherwise(x["low"] < F.col("target") - F.make_dt_interval(mins=F.lit(config.observation_age)))
    beyond = lambda x: F.when(x["kind"] == "FORECAST", x["high"] > F.col("target") + late).otherwise(x["high"] > F.col("target"))
    reasons = F.transform("about", lambda x: F.when(F.coalesce(early(x) | beyond(x), F.lit(False)), F.array_union(x["faults"], F.array(F.lit("TIME_MISMATCH")))).otherwise(x["faults"]))
    chosen = best.join(about, cell).select(*cell, "target", *shown, F.array_sort(F.array_distinct(F.flatten(reasons))).alias("rejected"))
    return targets.join(chosen, [*cell, "target"]).select(key, *[c.lower() for c in COMPONENTS], "rejected")


def weather_features(chosen: DataFrame, linked: Column, config: EnvironmentConfig = EnvironmentConfig()) -> DataFrame:
    """Temperature, precipitation, state and availability from the chosen components."""
    temperature = feature_number(F.col("t1h.value"))
    kind, rain = feature_number(F.col("pty.value")), F.when(feature_text(F.col("rn1.value")) == NO_RAIN, 0.0).otherwise(feature_number(F.col("rn1.value")))
    # Codes of precipitation kinds; 0 is none.
    by_kind = F.when(kind.isin(0, 1, 2, 3, 5, 6, 7), kind != 0)
    by_rain = F.when(rain >= 0, rain > 0)
    wet = F.when(F.coalesce(by_kind, F.lit(False)) | F.coalesce(by_rain, F.lit(False)), True).otherwise(F.coalesce(by_kind, by_rain))
    states = F.array(
        F.when(temperature.isNull(), "UNKNOWN").when(temperature.between(config.cold, config.hot), "FAVORABLE").otherwise("CAUTION"),
        F.when(wet.isNull(), "UNKNOWN").when(wet, "CAUTION").otherwise("FAVORABLE"),
    )
    any_chosen = F.col("t1h").isNotNull() | F.col("pty").isNotNull() | F.col("rn1").isNotNull()
    has = lambda r: F.coalesce(F.array_contains("rejected", r), F.lit(False))
    availability = (
        F.when(~linked, "UNLINKED").when(temperature.isNotNull() & wet.isNotNull(), "AVAILABLE").when(any_chosen, "PARTIAL")
        .when(has("STALE"), "STALE").when(has("TIME_MISMATCH"), "TIME_MISMATCH").otherwise("MISSING")
    )
    return chosen.select("*", temperature.alias("temperature"), F.when(rain >= 0, rain).alias("precipitation"), wet.alias("wet"), schedule.combine(states).alias("weather_state"), availability.alias("weather_availability"))


def _readings(air: DataFrame, now: Column) -> DataFrame:
    """(region, station, measured, collected, pm10, pm25, faults): each station's latest usable reading beside the faults of its
    others, one aggregate. Rows without a region or a station's name count for nothing."""
    rows = clean.normalized(air, {"_region": "sidoName", "_station": "stationName"}, FEATURE_NULL_TOKENS)
    rows = clean.read_as(rows, {"_pm10": ("pm10Value", clean.NUMBER), "_pm25": ("pm25Value", clean.NUMBER)})
    finite = lambda c: F.when(F.abs(F.col(c)) < float("inf"), F.col(c))
    rows = rows.select(
        clean.mapped(F.col("_region"), strict=True).alias("region"), F.col("_station").alias("station"), F.col("dataTime").cast("timestamp_ntz").alias("measured"),
        F.col("collected_at").cast("timestamp_ntz").alias("collected"), finite("_pm10").alias("pm10"), finite("_pm25").alias("pm25"),
    ).where("region is not null and station is not null")
    undated = F.col("measured").isNull() | F.col("collected").isNull()
    fault = F.when(undated, "UNKNOWN_MEASUREMENT_TIME").when((F.col("measured") > now) | (F.col("collected") > now), "FUTURE_DATA")
    rows = rows.withColumn("fault", fault)
    rank = F.struct("measured", "collected", "pm10", "pm25")
    return rows.groupBy("region", "station").agg(F.max(F.when(F.col("fault").isNull(), rank)).alias("x"), F.collect_set("fault").alias("faults")).select("region", "station", "x.*", "faults")


def _air_states(out: DataFrame, verified: Column, config: EnvironmentConfig) -> DataFrame:
    """State, availability and scope from pm10, pm25, stations, complete and air_rejected."""
    caution = F.coalesce(F.col("pm10") >= config.pm10, F.lit(False)) | F.coalesce(F.col("pm25") >= config.pm25, F.lit(False))
    whole = (F.col("stations") > 0) & F.col("complete") & (F.size("air_rejected") == 0)
    return out.withColumns(
        {
            "air_state": F.when(caution, "CAUTION").when(whole, "FAVORABLE").otherwise("UNKNOWN"),
            "air_availability": F.when(whole, "AVAILABLE").when(F.col("stations") > 0, "PARTIAL").when(F.array_contains("air_rejected", "STALE"), "STALE").otherwise("MISSING"),
            "air_scope": F.when(verified, "VERIFIED_STATION").otherwise("REGIONAL_PROXY"),
        }
    )


def air_by_region(air: DataFrame, now: Column, target: Column, config: EnvironmentConfig = EnvironmentConfig(), station: str | None = None) -> DataFrame:
    """A row for each standard region: the worst of its stations' latest readings, and their completeness.

    Readings without a usable time, of the future or too old for the target are not used, but remembered: a region with any
    is not complete. ``station`` names a verified station: then only it is read, and the scope says so.
    """
    last = _readings(air, now)
    if station is not None:
        last = last.where(F.col("station") == station)
    fresh = _minutes(target, F.col("measured")).between(0, config.air_age)
    faults = F.array_union("faults", F.when(F.col("measured").isNotNull() & ~fresh, F.array(F.lit("STALE"))).otherwise(F.array().cast("array<string>")))
    plus = lambda c: F.when(fresh & (F.col(c) >= 0), F.col(c))
    out = last.groupBy("region").agg(
        F.max(plus("pm10")).alias("pm10"), F.max(plus("pm25")).alias("pm25"), F.count_if(fresh).alias("stations"),
        F.coalesce(F.bool_and(F.when(fresh, plus("pm10").isNotNull() & plus("pm25").isNotNull())), F.lit(False)).alias("complete"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(faults)))).alias("air_rejected"),
    )
    return _air_states(out, F.lit(station is not None), config)


def air_at_targets(points: DataFrame, air: DataFrame, now: Column, config: EnvironmentConfig = EnvironmentConfig()) -> DataFrame:
    """The columns of ``air_by_region`` for each distinct (region, station, target) of ``points``; no target lies before ``now``.

    A station's name restricts a point to it, null means the whole region. A station's latest reading serves every target
    until it is too old, so of a region those measured at or after (target - age limit) count: their running worst by time
    of measurement is one row for each such time, and an as-of merge finds each target's. Regions without readings give no row.
    """
    last = _readings(air, now)
    # a region's stations count twice: for the region, and each for itself
    scoped = last.withColumn("scope", F.explode(F.array(F.lit(""), F.col("station"))))
    usable = scoped.where("measured is not null")
    plus = lambda c: F.when(F.col(c) >= 0, F.col(c))
    steps = usable.groupBy("region", "scope", "measured").agg(F.max(plus("pm10")).alias("a"), F.max(plus("pm25")).alias("b"), F.count("*").alias("n"), F.bool_and(plus("pm10").isNotNull() & plus("pm25").isNotNull()).alias("whole"))
    since = Window.partitionBy("region", "scope").orderBy(F.desc("measured")).rowsBetween(Window.unboundedPreceding, 0)  # a region's stations
    steps = steps.select("region", "scope", F.col("measured").alias("cutoff"), F.max("a").over(since).alias("pm10"), F.max("b").over(since).alias("pm25"), F.sum("n").over(since).alias("stations"), F.bool_and("whole").over(since).alias("complete"))
    about = scoped.groupBy("region", "scope").agg(F.array_distinct(F.flatten(F.collect_set("faults"))).alias("faults"), F.count("measured").alias("dated"))

    asked = points.select("region", F.coalesce("station", F.lit("")).alias("scope"), "target").where("region is not null and target is not null").distinct()
    asked = asked.withColumn("cutoff", F.col("target") - F.make_dt_interval(mins=F.lit(config.air_age)))
    found = ranges.neighbours(asked, steps, ["region", "scope"], "cutoff", ["pm10", "pm25", "stations", "complete"]).select("region", "scope", "cutoff", F.col("after").alias("x"))
    out = asked.join(about, ["region", "scope"]).join(found, ["region", "scope", "cutoff"], "left")
    fresh = F.coalesce(F.col("x.stations"), F.lit(0))
    faults = F.array_sort(F.array_union("faults", F.when(F.col("dated") > fresh, F.array(F.lit("STALE"))).otherwise(F.array().cast("array<string>"))))
    out = out.select("region", F.nullif("scope", F.lit("")).alias("station"), "target", F.col("x.pm10").alias("pm10"), F.col("x.pm25").alias("pm25"), fresh.alias("stations"), F.coalesce("x.complete", F.lit(False)).alias("complete"), faults.alias("air_rejected"))
    return _air_states(out, F.col("station").isNotNull(), config)


def outdoor_suitability(exposure: Column, weather_state: Column, air_state: Column) -> Column:
    """By exposure, which is given with evidence and never guessed."""
    both = schedule.combine(F.array(F.coalesce(weather_state, F.lit("UNKNOWN")), F.coalesce(air_state, F.lit("UNKNOWN"))))
    return F.when(exposure == "INDOOR", "NOT_APPLICABLE").when(exposure == "OUTDOOR", both).otherwise("UNKNOWN")


HOURS = {"week_open": "weekdayOperOpenHhmm", "week_close": "weekdayOperColseHhmm", "weekend_open": "wkendOperOpenHhmm", "weekend_close": "wkendOperCloseHhmm"}


def exercise_features(
    places: DataFrame, weather: DataFrame, air: DataFrame, now: Column, key: str, *, travel: str | None = None, exposure: str | None = None, region: str = "sido_standard",
    station: str | None = None, grid: str | None = None, holidays: DataFrame | None = None, config: EnvironmentConfig = EnvironmentConfig(),
) -> DataFrame:
    """All features of places with latitude, longitude, opening hours and region.

    ``weather`` and ``air`` come from ``read_environment``. ``holidays`` has a ``day``; without it rules about public holidays
    stay unknown. ``travel``, ``exposure``, ``station`` (the name of a verified station, null for none) and ``grid`` (a struct of nx
    and ny that must agree with the position) name columns of ``places``. Weather and air are those of the arrival, or of ``now``
    without an estimate of the travel time.
    """
    places = clean.complete(places, (*HOURS.values(), "rstde", region))
    known = None
    if holidays is not None:
        days = holidays.select(F.collect_set("day").alias("_days"))  # a calendar: one row, hundreds of days
        places = places.crossJoin(F.broadcast(days))
        day = now.cast("date")
        known = tuple(F.array_contains("_days", d) for d in (F.date_sub(day, 1), day, F.date_add(day, 1)))
    minutes = F.col(travel).cast("double") if travel else F.lit(None).cast("double")
    hours = {k: F.col(c) for k, c in HOURS.items()}
    base = schedule.add_feasibility(places, now, minutes, F.col("rstde"), hours, known)
    link = geo.weather_link(F.col("latitude"), F.col("longitude"), F.col(grid) if grid else None)
    base = base.withColumns({"weather_link": link, "region": clean.mapped(F.col(region), strict=True), "air_station": feature_text(F.col(station)) if station else F.lit(None).cast("string")})
    base = base.withColumn("target", F.coalesce("feasibility.arrival", now)).withColumn("_grid", F.col("weather_link.grid"))
    base = staged(base, "places")  # read for the places themselves, their cells and their regions
    chosen = choose_weather(base.select(key, "target", F.col("_grid").alias("grid")).where("grid is not null"), weather, key, now, config)
    out = base.join(chosen, key, "left").transform(lambda df: weather_features(df, F.col("_grid").isNotNull(), config))
    at = air_at_targets(base.select("region", F.col("air_station").alias("station"), "target"), air, now, config)
    at = at.select(*[F.col(c).alias(f"_{c}") for c in ("region", "station", "target")], *[c for c in at.columns if c not in ("region", "station", "target")])
    same = (F.col("region") == F.col("_region")) & F.col("air_station").eqNullSafe(F.col("_station")) & (F.col("target") == F.col("_target"))
    out = out.join(at, same, "left").drop("_region", "_station", "_target")
    out = out.withColumn("air_availability", F.when(F.col("region").isNull(), "UNLINKED").otherwise(F.coalesce("air_availability", F.lit("MISSING")))).withColumn("air_state", F.coalesce("air_state", F.lit("UNKNOWN")))
    shown = F.col(exposure) if exposure else F.lit(None).cast("string")
    out = out.withColumn("environment_target_basis", F.when(F.col("feasibility.arrival").isNotNull(), "ARRIVAL").otherwise("NOW_NO_TRAVEL_ESTIMATE"))
    return out.withColumn("outdoor_suitability", outdoor_suitability(shown, F.col("weather_state"), F.col("air_state"))).drop("_days", "_grid")


def from_origin(places: DataFrame, lat: float, lon: float) -> DataFrame:
    """Distance and travel time from a test origin."""
    km = geo.haversine_km(F.lit(lat), F.lit(lon), clean.coordinate(F.col("latitude"), 90), clean.coordinate(F.col("longitude"), 180))
    return places.withColumn("distance_km", km).withColumn("travel_minutes", geo.travel_minutes(km))


# Texts for a facility without a name and without a type.
UNNAMED, UNTYPED = "시설명 미등록", "운동 시설"


#: What ``features`` of a candidate holds of its ``exercise_features``.
FEATURES = (
    "feasibility", "weather_link", "t1h", "pty", "rn1", "rejected", "temperature", "precipitation", "wet", "weather_state", "weather_availability",
    "pm10", "pm25", "stations", "complete", "air_rejected", "air_state", "air_availability", "air_scope", "target", "environment_target_basis", "exposure", "outdoor_suitability",
)


def candidates(facilities: DataFrame, open_facilities: DataFrame, evaluated_at: Column, environment: tuple[DataFrame, DataFrame] | None = None, config: EnvironmentConfig = EnvironmentConfig()) -> DataFrame:
    """Candidates of both sources under one schema, one for each content; sources are never joined by name.

    With ``environment``, the frames of ``read_environment``, each has its ``exercise_features`` at ``evaluated_at`` (a time
    without zone) as the JSON ``features``. The first source has no opening hours; its city is its region.
    """
    text = lambda *c: F.coalesce(*[F.nullif(F.col(x), F.lit("")) for x in c], F.lit(""))

    def record(df: DataFrame, source: str, columns: dict[str, Column], lat: str, lon: str) -> DataFrame:
        kept = [c for c in df.columns if not c.startswith("_")]
        row = F.to_json(F.struct(*sorted(kept)), {"ignoreNullFields": "false"})
        own = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in (*HOURS.values(), "rstde")]
        return df.select(F.lit(source).alias("source_table"), content_key(kept).alias("source_key"), *[v.alias(k) for k, v in columns.items()], clean.coordinate(F.col(lat), 90).alias("latitude"), clean.coordinate(F.col(lon), 180).alias("longitude"), row.alias("source_row"), evaluated_at.alias("evaluated_at"), *own)

    first = record(
        facilities, "processed.facility",
        {"facility_name": F.coalesce(F.nullif("faci_nm", F.lit("")), F.lit(UNNAMED)), "facility_type": F.coalesce(F.nullif("ftype_nm", F.lit("")), F.nullif("fcob_nm", F.lit("")), F.lit(UNTYPED)), "address": text("faci_road_addr", "faci_addr"), "city": text("cp_nm"), "district": text("cpb_nm"), "exposure": F.when(F.col("inout_gbn_nm") == INDOOR, "INDOOR").when(F.col("inout_gbn_nm") == OUTDOOR, "OUTDOOR")},
        "faci_lat", "faci_lot",
    )
    second = record(
        open_facilities, "processed.public_open_facility",
        {"facility_name": text("openFcltyNm"), "facility_type": text("openFcltyType"), "address": text("rdnmadr", "lnmadr"), "city": text("sido_standard"), "district": F.lit(""), "exposure": F.lit(None).cast("string")},
        "latitude", "longitude",
    )
    found = first.unionByName(second).dropDuplicates(["source_table", "source_key"])
    if environment is None:
        return found.drop(*HOURS.values(), "rstde")
    found = staged(found.withColumn("_place", F.concat_ws(":", "source_table", "source_key")), "candidates")
    out = exercise_features(found, *environment, evaluated_at, "_place", exposure="exposure", region="city", config=config)
    told = F.to_json(F.struct(*FEATURES), {"ignoreNullFields": "false"})
    return out.select(*[c for c in found.columns if c not in (*HOURS.values(), "rstde", "_place")], told.alias("features"))


def nearest_facilities(found: DataFrame, lat: float, lon: float, k: int, *, city: str | None = None, district: str | None = None) -> DataFrame:
    """The k nearest candidates of a region by the way on the ellipsoid, unknown distances last; filters reach the scan, Spark
    keeps k a task."""
    if city:
        found = found.where(F.col("city") == city)
    if district:
        found = found.where((F.col("district") == district) | (F.col("district") == ""))
    found = geo.with_geodesic(found, F.lit(lat), F.lit(lon), F.col("latitude"), F.col("longitude"), "_metres")
    return found.withColumn("distance_km", F.col("_metres") / 1000).drop("_metres").orderBy(F.asc_nulls_last("distance_km"), "facility_name", "source_key").limit(k)
