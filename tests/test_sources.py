"""Readers."""

import json

import pytest
from pyspark.sql import functions as F

from sluice.operators import runs, select
from sluice.sources import files
from sluice.sources.paged import PagedSource


def test_csv(spark, tmp_path):
    good = tmp_path / "A_202601.csv"
    good.write_text('a,b\n1, x \n"",2\n')
    df = files.read_csv(spark, str(good))
    assert sorted(map(tuple, df.collect()), key=str) == sorted([("1", " x "), (None, "2")], key=str)
    assert files.csv_report(df) == {"rows": 2, "empty_fields": 1}
    for name, text in (("wide", "a,b\n1,2,3\n"), ("twice", "a,a\n1,2\n"), ("page", "<html>\n"), ("nul", "a,b\n1,\0\n")):
        (tmp_path / name).write_text(text)
        with pytest.raises(Exception):
            files.read_csv(spark, str(tmp_path / name)).collect()


def test_file_choice():
    assert files.file_for(["d/A_202601.csv", "d/A_202602.csv", "B_209901.csv"], "A") == "d/A_202602.csv"
    with pytest.raises(ValueError):
        files.file_for(["x/A_202602.csv", "y/A_202602.csv"], "A")
    with pytest.raises(FileNotFoundError):
        files.file_for([], "A")


def test_xml(spark, tmp_path):
    (tmp_path / "x.xml").write_text("<r><item><a>1</a><b>y</b></item><item><a>2</a></item></r>")
    assert sorted(map(tuple, files.read_xml(spark, str(tmp_path / "x.xml"), "item", "a string, b string").collect()), key=str) == [("1", "y"), ("2", None)]


def test_envelopes(spark):
    answers = [{"response": {"body": {"items": {"item": [{"a": "1"}, {"a": "2"}]}, "totalCount": 2}}}, {"items": {"item": {"a": "3"}}, "totalCount": 1}, {"items": "none", "totalCount": 0}]
    df = spark.createDataFrame([(i, json.dumps(a)) for i, a in enumerate(answers)], "scope int, answer string")
    rows = files.envelope_items(df, "answer", "struct<a:string>")
    assert sorted((r.scope, r.a) for r in rows.collect()) == [(0, "1"), (0, "2"), (1, "3")]
    files.require_total(rows, ["scope"])
    with pytest.raises(ValueError):
        files.require_total(rows.where("a <> '1'"), ["scope"])


def test_paged_source(spark, tmp_path):
    spark.dataSource.register(PagedSource)
    page = lambda n, items, total: (tmp_path / f"{n}.json").write_text(json.dumps({"body": {"items": {"item": items}, "totalCount": total}}))
    page(1, [{"a": 1}, {"a": 2}], 3)
    page(2, [{"a": 3}], 3)
    read = lambda: sorted(map(tuple, spark.read.format("paged").option("columns", "a").option("rows", 2).load(str(tmp_path)).collect()))
    assert read() == [(0, "1"), (1, "2"), (2, "3")]
    page(2, [], 3)
    with pytest.raises(Exception):
        read()


def test_checkpoint_resume(spark):
    lines = [{"type": "meta"}, {"type": "unit", "key": "a", "status": "failed"}, {"type": "unit", "key": "a", "status": "done"}, {"type": "unit", "key": "b", "status": "failed"}]
    df = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(lines)] + [(9, '{"type": "un')], "n int, value string")
    done = files.completed_units(df, "n")
    units = spark.createDataFrame([("a",), ("b",), ("c",)], "key string")
    assert sorted(r.key for r in files.pending(units, done).collect()) == ["b", "c"]
    assert len(files.fingerprint(units).first()[0]) == 64
    with pytest.raises(ValueError):
        files.completed_units(df.where("n > 0"), "n")


def test_orphans_and_unique_attach(spark):
    left = spark.createDataFrame([(1, None), (2, "x")], "i int, k string")
    right = spark.createDataFrame([(None, "n"), ("x", "1"), ("x", "2")], "k string, v string")
    assert {(r.i, r.v) for r in select.attach_unique(left, right, ["k"]).collect()} == {(1, "n"), (2, None)}
    assert select.orphans(left, right.where("k is null"), "k").count() == 1


def test_run_reports(spark):
    import datetime as dt

    assert runs.report_period(dt.datetime(2026, 9, 28, 9, 15)) == (dt.datetime(2026, 9, 27, 17), dt.datetime(2026, 9, 28, 9, 15))
    assert runs.report_period(dt.datetime(2026, 9, 28, 17, 30)) is None
    df = spark.createDataFrame([("timed out",), ("HTTP 429 LIMITED_NUMBER_OF_SERVICE_REQUESTS_EXCEEDS_ERROR",), ("row 503",), (None,)], "e string")
    assert [r[0] for r in df.select(runs.transient(F.col("e"))).collect()] == [True, False, False, False]


def test_checkpoints_reports_and_lists(spark, tmp_path):
    path = str(tmp_path / "check")
    files.start_checkpoint(spark, path, "job 1")
    units = spark.createDataFrame([("a", "failed", ["x"], "2026-01-01T00:00:00"), ("b", "done", ["y", "z"], "2026-01-01T00:00:01")], "key string, status string, records array<string>, saved_at string")
    files.append_units(units, path)
    files.append_units(units.where("key = 'a'").withColumns({"status": F.lit("done"), "saved_at": F.lit("2026-01-01T00:00:02")}), path)
    assert {r.key: (r.status, r.records) for r in files.read_checkpoint(spark, path).collect()} == {"a": ("done", ["x"]), "b": ("done", ["y", "z"])}
    assert files.pending(spark.createDataFrame([("a",), ("c",)], "key string"), files.read_checkpoint(spark, path)).collect() == [("c",)]
    files.write_report(units, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report/json")).count() == 2
    assert spark.read.csv(str(tmp_path / "report/csv"), header=True, escape='"').where("key = 'b'").first().records == '["y","z"]'
    cities = files.first_present(spark.createDataFrame([("1", None), (None, "2")], "citycode string, cityCode2 string"), {"city_code": ("citycode", "cityCode2"), "city_name": ("none",)})
    assert sorted(tuple(r) for r in cities.collect()) == [("1", None), ("2", None)]
    years = spark.range(2012, 2025)
    files.require_values(years, "id", range(2012, 2025))
    for bad in (years.where("id <> 2013"), years.union(spark.range(1))):
        with pytest.raises(ValueError, match="id"):
            files.require_values(bad, "id", range(2012, 2025))
    years.createOrReplaceTempView("years_of_test")
    assert files.catalog_columns(spark).where("table_name = 'years_of_test'").select("column_name", "data_type", "place").collect() == [("id", "bigint", 0)]


def test_quoted_headers_places_and_versions(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('"name, full",b\nx,1\ny,\n', encoding="utf-8")
    rows = files.read_csv(spark, str(path), sequence=True).collect()
    assert [(r["name, full"], r["b"], r[files.SEQ]) for r in rows] == [("x", "1", 0), ("y", None, 1)]
    versions = spark.createDataFrame([("a (202401)",), ("a (202402)",), ("b (202402)",)], "n string")
    with pytest.raises(ValueError, match="2 versions"):
        files.latest_version(versions, F.col("n"))
    assert files.latest_version(versions.where("n like 'a%'"), F.col("n")).count() == 1
