"""Places of CSV rows do not depend on how files are dealt; counts of a load are compared."""

import pytest
from pyspark.sql import functions as F

from sluice.operators.dedup import keep_last
from sluice.plans.job import load_csv
from sluice.plans.publish import Warehouse
from sluice.sources import files


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000b")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_places_of_files_of_unlike_size(spark, tmp_path, small_splits):
    """The scan packs large files first; places follow names, offsets and rows all the same."""
    want = []
    for name, n in (("a", 3), ("b 2", 900), ("c", 40), ("d", 2)):
        lines = [f'{name},{i},"x{i}"' for i in range(n)]
        if name == "c":  # line breaks in fields, so this file is read whole
            lines[5] = 'c,5,"two\nlines, ""\\" and more"'.replace('""', "")
        (tmp_path / f"{name}.csv").write_text("file,n,v\n" + "\n".join(lines) + "\n", encoding="utf-8")
        want += [(name, str(i)) for i in range(n)]
    rows = files.read_csv(spark, str(tmp_path), sequence=True)
    got = sorted((r[files.SEQ], r["file"], r["n"]) for r in rows.collect())
    assert got == [(i, *w) for i, w in enumerate(want)]
    assert "two\nlines" in rows.where("file = 'c' and n = '5'").first().v
    last = keep_last(rows.withColumn("k", F.col("n")), ["k"], [F.col(files.SEQ)])
    assert {r.k: r.file for r in last.collect()} == {str(i): "d" if i < 2 else "c" if i < 40 else "b 2" for i in range(900)}
    assert files.read_csv(spark, str(tmp_path)).count() == len(want)
    assert files.read_csv(spark, str(tmp_path / "b 2.csv")).rdd.getNumPartitions() > 1


def test_counts_of_a_load(spark, tmp_path, monkeypatch):
    (tmp_path / "in.csv").write_text("k,v\n1,a\n2,b\n", encoding="utf-8")
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    assert load_csv(warehouse, "d", "t", str(tmp_path / "in.csv"), expected=2, primary_key=("k",)) == {"parsed": 2, "staged": 2, "published": 2}
    with pytest.raises(ValueError, match="2 rows parsed, 3 sent"):
        load_csv(warehouse, "d", "t", str(tmp_path / "in.csv"), expected=3)
    monkeypatch.setattr(files, "csv_report", lambda df: {"rows": 5})
    with pytest.raises(ValueError, match="2 rows staged, 5 expected"):
        load_csv(warehouse, "d", "t", str(tmp_path / "in.csv"))
    assert warehouse.manifest("d")[0] == 1
