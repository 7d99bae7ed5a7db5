"""Upserts by parts and the compare-and-swap of manifests: concurrent writers, untouched days, widened columns, lost swaps."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from sluice.plans.publish import Parts, Warehouse, record_run

SCHEMA = "station string, at string, v long, seq long"
KEY, DAYS = {"t": ["station", "at"]}, {"t": Parts("at")}


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "w"))


def batch(spark, *rows):
    return spark.createDataFrame([(s, t, v, i) for i, (s, t, v) in enumerate(rows)], SCHEMA)


def found(warehouse):
    return {(r.station, r["at"]): r.v for r in warehouse.read("d", "t").collect()}


def test_a_day_writes_a_day(spark, warehouse):
    first = [(s, f"2024-01-0{d} 10:00", d) for s in "ab" for d in range(1, 8)]
    assert warehouse.upsert("d", {"t": batch(spark, *first)}, KEY, order="seq", parts=DAYS) == {"t": 14}
    before = warehouse.versions("d")["t"]
    assert warehouse.upsert("d", {"t": batch(spark, ("a", "2024-01-03 10:00", 99), ("c", "2024-01-03 11:00", 5), ("a", "2024-01-03 10:00", 98))}, KEY, order="seq") == {"t": 15}
    after = warehouse.versions("d")["t"]
    assert {p for p in after if after[p] != before.get(p)} == {"2024-01-03"}
    assert found(warehouse) == {(s, t): v for s, t, v in first} | {("a", "2024-01-03 10:00"): 98, ("c", "2024-01-03 11:00"): 5}
    assert {r.v for r in warehouse.read("d", "t", parts=["2024-01-03"]).collect()} == {98, 5, 3}
    # a new column is null in the other days, a wider type writes all of them again
    extra = batch(spark, ("z", "2024-01-09 00:00", 1)).withColumn("extra", F.lit("e"))
    warehouse.upsert("d", {"t": extra}, KEY)
    assert warehouse.versions("d")["t"]["2024-01-01"] == after["2024-01-01"]
    assert {r.extra for r in warehouse.read("d", "t").collect()} == {None, "e"}
    warehouse.upsert("d", {"t": batch(spark, ("y", "2024-01-09 00:00", 1)).withColumn("v", F.lit("none"))}, KEY)
    assert warehouse.versions("d")["t"]["2024-01-01"] != after["2024-01-01"]
    assert len(found(warehouse)) == 17 and found(warehouse)["y", "2024-01-09 00:00"] == "none"


@pytest.mark.parametrize("days", [("1", "2", "3", "4"), ("1", "1", "1", "1")])
def test_concurrent_writers_all_survive(spark, warehouse, days):
    """Writers of other days and of the same day; each is told that it has published, and so it has."""
    warehouse.upsert("d", {"t": batch(spark, ("old", "2024-01-01 00:00", 0))}, KEY, parts=DAYS)
    write = lambda i: warehouse.upsert("d", {"t": batch(spark, (f"w{i}", f"2024-01-0{days[i]} 0{i}:00", i), ("all", f"2024-01-0{days[i]} 12:00", i))}, KEY)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(4)))
    got = found(warehouse)
    assert {k for k in got if k[0] != "all"} == {("old", "2024-01-01 00:00"), *((f"w{i}", f"2024-01-0{days[i]} 0{i}:00") for i in range(4))}
    assert len([k for k in got if k[0] == "all"]) == len(set(days))
    assert warehouse.manifest("d")[0] == 5


def test_a_lost_swap_merges_again(spark, warehouse, monkeypatch):
    """Between a writer's look and its swap another one changes the same part, then another part."""
    warehouse.upsert("d", {"t": batch(spark, ("a", "2024-01-01 00:00", 1))}, KEY, parts=DAYS)
    staged, real, between = [], Warehouse._swap, [batch(spark, ("b", "2024-01-01 01:00", 2)), batch(spark, ("c", "2024-01-02 00:00", 3))]
    stage = Warehouse._stage

    def swap(self, dataset, number, tables):
        if between:
            Warehouse(spark, self.root).upsert(dataset, {"t": between.pop(0)}, KEY) if not getattr(self, "inner", False) else None
        return real(self, dataset, number, tables)

    class Other(Warehouse):
        pass

    def counted(self, *a, **k):
        staged.append(type(self).__name__)
        return stage(self, *a, **k)

    monkeypatch.setattr(Other, "_swap", swap)
    monkeypatch.setattr(Warehouse, "_stage", counted)
    Other(spark, warehouse.root).upsert("d", {"t": batch(spark, ("a", "2024-01-01 00:00", 9), ("d", "2024-01-01 02:00", 4))}, KEY)
    assert found(warehouse) == {("a", "2024-01-01 00:00"): 9, ("b", "2024-01-01 01:00"): 2, ("c", "2024-01-02 00:00"): 3, ("d", "2024-01-01 02:00"): 4}
    # merged again after the first loss, whose part had changed; after the second its files served
    assert staged.count("Other") == 2


def test_parts_must_follow_from_the_key(spark, warehouse):
    with pytest.raises(ValueError, match="no member of the key"):
        warehouse.upsert("d", {"t": batch(spark, ("a", "2024-01-01", 1))}, {"t": ["station"]}, parts=DAYS)
    odd = [("Ä/ö=", "x", 1), ("", "y", 2), ("..", "z", 3), ("a b", "2024-01-01", 4)]
    for parts in (Parts("station", "value"), Parts(buckets=5), Parts("at")):
        own = Warehouse(spark, f"{warehouse.root}-{parts.unit}-{parts.buckets}")
        own.upsert("d", {"t": batch(spark, *odd)}, KEY, parts={"t": parts})
        own.upsert("d", {"t": batch(spark, *[(s, t, v + 10) for s, t, v in odd[:2]])}, KEY)
        assert found(own) == {(s, t): v + (10 if i < 2 else 0) for i, (s, t, v) in enumerate(odd)}


def test_history_and_superseded_files(spark, warehouse):
    for i in range(5):
        record_run(warehouse, {"run_id": f"r{i % 3}", "job_id": "j", "run_status": f"S{i}"})
    assert {(r.run_id, r.run_status) for r in warehouse.read("monitoring", "run_history").collect()} == {("r0", "S3"), ("r1", "S4"), ("r2", "S2")}
    named = set(warehouse._folders("monitoring", warehouse.manifest("monitoring")[1]))
    there = [f"{warehouse.root}/monitoring/run_history/{v}/{p}" for v in warehouse._names(f"{warehouse.root}/monitoring/run_history") for p in warehouse._names(f"{warehouse.root}/monitoring/run_history/{v}") if p.startswith("_part")]
    assert named <= set(there) and len(there) <= len(named) + 1
    lost = f"{warehouse.root}/monitoring/run_history/feed"
    spark.range(1).write.parquet(lost)
    assert warehouse.vacuum("monitoring", 3600) == 0
    assert warehouse.vacuum("monitoring", -1) >= 1 and "feed" not in warehouse._names(f"{warehouse.root}/monitoring/run_history")
    assert warehouse.read("monitoring", "run_history").count() == 3
