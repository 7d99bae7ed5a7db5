"""The dataset job on small frames: all tables or none, and every run in the history."""

import json

import pytest

from sluice.plans import job, specs
from sluice.plans.processors import SEQ
from sluice.plans.publish import HISTORY, Warehouse

TRAIL, SEGMENT = f"routeIdx string, themeNm string, {SEQ} long", f"routeIdx string, crsIdx string, crsKorNm string, crsDstnc string, {SEQ} long"


def trails(spark, segment_of):
    tables = {
        "durunubi_trails": spark.createDataFrame([("R1", "a", 0), ("R2", None, 1)], TRAIL),
        "durunubi_segments": spark.createDataFrame([("R1", "C1", "x", "1.5", 0), (segment_of, "C2", "y", "far", 1)], SEGMENT),
    }
    return tables.__getitem__


def spec(name):
    return next(s for s in specs.Catalog().datasets() if s.name == name)


def test_a_dataset_is_published_as_a_whole(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    found = job.run_job(spec("trails"), trails(spark, "R2"), w, "run1")
    assert found.tables == {"durunubi_trails": {"rows": 2, "nulls": 1}, "durunubi_segments": {"rows": 2, "nulls": 1}}
    assert found.dq_status == "PASSED" and set(found.seconds) == {"source_read", "process", "validate", "db"}
    with pytest.raises(ValueError, match="orphans"):
        job.run_job(spec("trails"), trails(spark, "R9"), w, "run2")
    assert w.read("trails", "durunubi_segments").where("routeIdx = 'R9'").count() == 0
    history = {r.run_id: r for r in w.read("monitoring", "run_history", HISTORY).collect()}
    assert (history["run1"].run_status, history["run1"].failure_stage) == ("SUCCESS", None)
    assert (history["run2"].run_status, history["run2"].failure_stage, history["run2"].dq_status) == ("FAILED", "validate", "PASSED")
    assert json.loads(history["run1"].results)["durunubi_trails"]["rows"] == 2


def test_time_series_are_merged(spark, tmp_path):
    w, columns = Warehouse(spark, str(tmp_path)), f"sidoName string, stationName string, dataTime string, collected_at string, pm10Value string, pm25Value string, o3Value string, khaiValue string, {SEQ} long"
    row = lambda value, seq: ("서울", "중구", "2026-09-29 11:00", "2026-09-29T12:00:00", value, "1", "0.1", "2", seq)
    for value in ("10", "20"):
        frame = spark.createDataFrame([row(value, 0)], columns)
        job.run_job(spec("air_quality"), lambda _: frame, w)
    assert [r.pm10Value for r in w.read("air_quality", "air_quality").collect()] == [20]


def test_empty_raw_tables_and_unknown_validators(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no rows"):
        job.load_dataset(spec("trails"), lambda t: trails(spark, "R2")(t).limit(0), w)
    odd = specs.DatasetSpec("odd", spec("trails").tables, validator="none such")
    with pytest.raises(KeyError, match="none such"):
        job.load_dataset(odd, trails(spark, "R2"), w)


def test_phases_skip_after_a_failure_but_peers_run():
    ran = []

    def run(d):
        ran.append(d.name)
        if d.name == "weather":
            raise RuntimeError

    failed, skipped = job.run_phases(specs.Catalog().phases(), run)
    assert failed == ["weather"] and skipped == ["culture"] and len(ran) == len(specs.Catalog().datasets()) - 1
    assert job.run_phases(specs.Catalog().phases(), ran.append) == ([], [])


def test_durations():
    assert [job.duration(x) for x in (3.21, 123.4, 3723)] == ["3.2s", "2m 03s", "1h 02m 03s"]
