"""The current reading of every station as a stream with state, and the regions' roll-up kept beside it.

State is keyed by (region, station): the latest reading by (measured, collected) and whether it is still current. A reading
is ``STALE`` once the stream's clock, the watermark of the column ``arrived``, has passed its time of measurement by the age
limit; a timer says so without any new row. Corrections win however late they were measured, as only ``arrived`` counts for
lateness; arrival times must not fall by more than ``delay``. State is a row for each station.

Updates are merged with the published stations, and the regions they touch are rolled up from the merged rows; both
tables change in one publication, and a batch that runs again merges to the same tables.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from sluice.plans.publish import Parts, Warehouse, merge

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HELD = "measured long, collected long, pm10 double, pm25 double, stale boolean"
UPDATES = "region string, station string, measured long, collected long, pm10 double, pm25 double, state string"


class LatestReading(StatefulProcessor):
    """Keeps the latest reading of a station; times are milliseconds."""

    def __init__(self, age: int):
        self.age = age

    def init(self, handle) -> None:
        self.handle, self.held = handle, handle.getValueState("latest", HELD)

    def _told(self, key, x, clock: int) -> Iterator[Row]:
        """Stores ``x`` and gives the update; a timer is set for as long as it is current."""
        limit = x[0] + self.age
        stale = clock > limit
        if not stale:
            self.handle.registerTimer(max(limit, clock + 1))
        self.held.update((*x, stale))
        yield Row(region=key[0], station=key[1], measured=x[0], collected=x[1], pm10=x[2], pm25=x[3], state="STALE" if stale else "CURRENT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        order = lambda x: tuple((v is not None, v if v is not None else 0) for v in x)
        best = max(((r.measured, r.collected, r.pm10, r.pm25) for r in rows), key=order)
        if self.held.exists():
            old = tuple(self.held.get())
            if order(best) <= order(old[:4]):
                return
            if not old[4]:
                self.handle.deleteTimer(old[0] + self.age)
        yield from self._told(key, best, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.held.exists():
            *x, stale = tuple(self.held.get())
            clock = timerValues.getCurrentWatermarkInMs()
            if not stale and clock > x[0] + self.age:
                yield from self._told(key, tuple(x), clock)
            elif not stale:
                self.handle.registerTimer(clock + 1)

    def close(self) -> None:
        pass


def latest_readings(stream: DataFrame, age_minutes: int, delay: str = "0 seconds") -> DataFrame:
    """Updates (region, station, reading, state) from a stream of region, station, measured, collected, pm10, pm25 and arrived.

    Rows without a region, a station or one of the times are left out.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    rows = stream.withWatermark("arrived", delay).where("region is not null and station is not null and measured is not null and collected is not null")
    rows = rows.select("region", "station", F.unix_millis("measured").alias("measured"), F.unix_millis("collected").alias("collected"), F.col("pm10").cast("double").alias("pm10"), F.col("pm25").cast("double").alias("pm25"), "arrived")
    return rows.groupBy("region", "station").transformWithState(LatestReading(age_minutes * 60_000), UPDATES, "Update", "eventTime")


def roll_up(stations: DataFrame) -> DataFrame:
    """A row for each region: the worst of its current stations, their number and that of the stale ones."""
    current = F.col("state") == "CURRENT"
    worst = lambda c: F.max(F.when(current & (F.col(c) >= 0), F.col(c))).alias(c)
    return stations.groupBy("region").agg(worst("pm10"), worst("pm25"), F.count_if(current).alias("stations"), F.count_if(~current).alias("stale"), F.max("measured").alias("measured"))


#: Stations are split by region, so a batch reads and writes the regions that it touches.
STATIONS, REGIONS = Parts("region", "value"), Parts()


def keep_current(stream: DataFrame, warehouse: Warehouse, dataset: str, checkpoint: str, age_minutes: int, delay: str = "0 seconds", **trigger) -> StreamingQuery:
    """Keeps ``<dataset>.stations`` and ``<dataset>.regions`` current."""

    def load(batch: DataFrame, _: int) -> None:
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            touched = {r[0] for r in batch.select(STATIONS.of(["region", "station"])).distinct().collect()}  # regions
            key = ["region", "station"]
            merged = merge(warehouse.read(dataset, "stations", parts=touched), batch, key) if warehouse.exists(dataset, "stations") else batch
            warehouse.upsert(dataset, {"stations": batch, "regions": roll_up(merged)}, {"stations": key, "regions": ["region"]}, parts={"stations": STATIONS, "regions": REGIONS})
        finally:
            batch.unpersist()

    updates = latest_readings(stream, age_minutes, delay)
    return updates.writeStream.foreachBatch(load).outputMode("update").option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
