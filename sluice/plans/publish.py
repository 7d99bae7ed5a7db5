"""Publication: staged, verified and all or nothing; upserts of time series by the partitions that they touch; history.

A dataset's tables live under ``root/<dataset>/<table>/<version>/_part=<part>`` as Parquet. The dataset's manifest names, for
every table, the version of each part, its rows and the schema. Manifests are numbered and only ever added: a writer
makes number n + 1 out of n by an exclusive create after all tables have been staged and checked, so a dataset changes as
a whole or not at all, and of two writers that began at the same number one loses. The loser looks again: if the parts it
has read are still the same, its files serve for the new manifest; else it merges with what is there now.

An upsert reads and writes the parts that its batch touches. A table's parts follow from its key (``Parts``), so equal keys
share one. Files of the last manifest but one stay, so a reader that has begun keeps its files. The exclusive create is a
rename that must not replace (atomic in HDFS and stores like it), on a local disk a hard link. Files are reached through
Hadoop's file system API, whatever store ``root`` is in.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.dedup import keep_last
from sluice.operators.staging import scratch  # noqa: F401
from sluice.plans.specs import check_names

#: Manifests that are kept; a writer may be so many behind before it can no longer tell that it has lost.
KEPT, TRIES = 1_000, 50


class Conflict(RuntimeError):
    """Other writers were faster ``TRIES`` times."""


@dataclass(frozen=True)
class Parts:
    """How a table is split by its key: by the day of ``column`` (a date, a timestamp, or text with yyyy-MM-dd in it), by its
    value, or by ``buckets`` of the whole key's hash; one part without any."""

    column: str | None = None
    unit: str = "day"
    buckets: int = 0

    def of(self, key: Sequence[str]) -> Column:
        """The part's name, safe in a path."""
        if self.column is None:
            text = [F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in key]
            return F.concat(F.lit("b"), F.pmod(F.xxhash64(*text), F.lit(self.buckets)).cast("string")) if self.buckets else F.lit("all")
        if self.column not in key:
            raise ValueError(f"parts by {self.column}, which is no member of the key {tuple(key)}")
        value = F.col(f"`{self.column}`").cast("string")
        if self.unit == "day":
            return F.coalesce(F.nullif(F.regexp_extract(value, r"\d{4}-\d{2}-\d{2}", 0), F.lit("")), F.lit("other"))
        return F.concat(F.lit("v"), F.hex(F.encode(value, "utf-8")))

    def told(self) -> dict:
        return {"column": self.column, "unit": self.unit, "buckets": self.buckets}


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # files
    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        fs = self._fs(folder)
        return [s.getPath().getName() for s in fs.listStatus(self._path(folder))] if fs.exists(self._path(folder)) else []

    def _delete(self, path: str) -> None:
        self._fs(path).delete(self._path(path), True)

    # manifests
    def _manifests(self, dataset: str) -> list[int]:
        return sorted(int(m[1]) for name in self._names(f"{self.root}/{dataset}") if (m := re.fullmatch(r"manifest-(\d+)\.json", name)))

    def _load(self, dataset: str, number: int) -> dict:
        path = f"{self.root}/{dataset}/manifest-{number}.json"
        return json.loads("".join(r[0] for r in self.spark.read.text(path, wholetext=True).collect()))

    def manifest(self, dataset: str) -> tuple[int, dict]:
        """The last manifest's number and its tables; 0 and none before the first publication."""
        found = self._manifests(dataset)
        return (found[-1], self._load(dataset, found[-1])) if found else (0, {})

    def _swap(self, dataset: str, number: int, tables: dict) -> bool:
        """Makes manifest ``number`` unless there is one; whether it did."""
        final, new = f"{self.root}/{dataset}/manifest-{number}.json", f"{self.root}/{dataset}/new-{uuid.uuid4().hex}.json"
        fs, jvm = self._fs(final), self.spark._jvm
        out = fs.create(self._path(new), True)
        out.write(bytearray(json.dumps(tables, sort_keys=True).encode()))
        out.close()
        try:
            if fs.getScheme() == "file":
                nio = jvm.java.nio.file.Paths
                place = lambda p: nio.get(fs.makeQualified(self._path(p)).toUri())
                jvm.java.nio.file.Files.createLink(place(final), place(new))
                return True
            none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(final).toUri(), self.spark._jsc.hadoopConfiguration()).rename(self._path(new), self._path(final), none)
            return True
        except Py4JJavaError as e:
            if "AlreadyExists" not in e.java_exception.getClass().getName():
                raise
            return False
        finally:
            fs.delete(self._path(new), False)

    def _commit(self, dataset: str, attempt: Callable[[dict], dict], touched: Callable[[dict], object]) -> dict:
        """Publishes what ``attempt`` makes of the current tables; its work is done again only if ``touched`` has changed.

        ``attempt`` gives the new entries, ``touched`` what of the tables it depends on.
        """
        base = made = None
        for _ in range(TRIES):
            number, tables = self.manifest(dataset)
            if made is None or touched(tables) != base:
                base, made = touched(tables), attempt(tables)
            merged = tables | {t: (e(tables.get(t)) if callable(e) else e) for t, e in made.items()}
            if self._swap(dataset, number + 1, merged):
                self._drop_superseded(dataset, number, tables, merged)
                return merged
        raise Conflict(f"{dataset}: other writers were faster {TRIES} times")

    def _drop_superseded(self, dataset: str, number: int, old: dict, new: dict) -> None:
        """Removes files that the manifest before ``old`` names and neither ``old`` nor ``new`` does, and very old manifests.

        Files that no manifest names yet may belong to a writer at work; ``vacuum`` removes those of writers that died.
        """
        if number > 1:
            held = {f for tables in (old, new) for f in self._folders(dataset, tables)}
            try:
                before = self._load(dataset, number - 1)
            except Exception:  # another writer has removed it  # noqa: BLE001
                return
            for folder in set(self._folders(dataset, before)) - held:
                self._delete(folder)
        if number > KEPT:
            self._delete(f"{self.root}/{dataset}/manifest-{number - KEPT}.json")

    def _folders(self, dataset: str, tables: dict) -> list[str]:
        return [f"{self.root}/{dataset}/{t}/{version}/_part={part}" for t, entry in tables.items() for part, (version, _) in entry["parts"].items()]

    def vacuum(self, dataset: str, older_than_seconds: float) -> int:
        """Removes versions that none of the last two manifests names and that are as old; gives their number."""
        number, tables = self.manifest(dataset)
        held = {f.rsplit("/", 1)[0] for x in (tables, self._load(dataset, number - 1) if number > 1 else {}) for f in self._folders(dataset, x)}
        import time

        removed = 0
        for table in tables:
            folder = f"{self.root}/{dataset}/{table}"
            for status in self._fs(folder).listStatus(self._path(folder)):
                path = f"{folder}/{status.getPath().getName()}"
                if path not in held and status.getModificationTime() < 1000 * (time.time() - older_than_seconds):
                    self._delete(path)
                    removed += 1
        return removed

    # reading
    def versions(self, dataset: str) -> dict[str, dict]:
        """The published tables and the version of each of their parts."""
        return {t: {part: version for part, (version, _) in e["parts"].items()} for t, e in self.manifest(dataset)[1].items()}

    def exists(self, dataset: str, table: str) -> bool:
        return table in self.manifest(dataset)[1]

    def _read(self, dataset: str, table: str, entry: dict, parts: Iterable[str] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(entry["schema"])
        wanted = entry["parts"] if parts is None else {p: entry["parts"][p] for p in parts if p in entry["parts"]}
        paths = [f"{self.root}/{dataset}/{table}/{version}/_part={part}" for part, (version, _) in sorted(wanted.items())]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, dataset: str, table: str, schema=None, parts: Iterable[str] | None = None) -> DataFrame:
        """The published table, or some parts of it; an empty frame of ``schema`` if there is none and a schema is given."""
        entry = self.manifest(dataset)[1].get(table)
        if entry is None:
            if schema is None:
                raise FileNotFoundError(f"{dataset}.{table}")
            return self.spark.createDataFrame([], schema)
        return self._read(dataset, table, entry, parts)

    def snapshot(self, tables: Sequence[tuple[str, str]]) -> dict[str, DataFrame]:
        """Several tables as of one look at the manifests."""
        seen = {d: self.manifest(d)[1] for d, _ in tables}
        return {t: self._read(d, t, seen[d][t]) for d, t in tables if t in seen[d]}

    # writing
    def _stage(self, dataset: str, table: str, df: DataFrame, parts: Parts, key: Sequence[str], order: Sequence[str] | None = None) -> dict:
        """Writes ``df`` as a new version and gives its entry, with the rows of each part as they were written."""
        if not df.columns:
            raise ValueError(f"{table} has no columns")
        version = uuid.uuid4().hex
        path = f"{self.root}/{dataset}/{table}/{version}"
        part = parts.of(key)
        out = df.withColumn("_part", part)
        if parts.column or parts.buckets:
            out = out.hint("rebalance", "_part")  # few files a part, and a part of many rows over several tasks
        if order:
            out = out.sortWithinPartitions("_part", *order)
        out.write.partitionBy("_part").parquet(path)
        there = [name for name in self._names(path) if name.startswith("_part=")]
        counts = {}
        if there:
            written = self.spark.read.schema(df.schema).option("basePath", path).parquet(*[f"{path}/{name}" for name in there])
            counts = {r["part"]: r["n"] for r in written.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}  # a row for each part
        return {"parts": {p: [version, n] for p, n in counts.items()}, "schema": json.loads(df.schema.json()), "by": parts.told()}

    def replace(
        self, dataset: str, frames: dict[str, DataFrame], *, allow_empty: Sequence[str] = (), primary_keys: dict[str, Sequence[str]] | None = None, cluster_by: dict[str, Sequence[str]] | None = None,
        expected: dict[str, int] | None = None, parts: dict[str, Parts] | None = None,
    ) -> dict[str, int]:
        """Stages, verifies and publishes all ``frames``; other tables of the dataset keep their version.

        ``expected`` has the rows that were parsed or processed; another staged count is an error.
        """
        check_names([dataset, *frames], [c for df in frames.values() for c in df.columns])
        entries = {}
        for table, df in frames.items():
            key = (primary_keys or {}).get(table)
            entry = entries[table] = self._stage(dataset, table, df, (parts or {}).get(table, Parts()), key or (), (cluster_by or {}).get(table))
            rows = _rows(entry)
            if rows != (expected or {}).get(table, rows):
                raise ValueError(f"{table}: {rows} rows staged, {expected[table]} expected")
            if not rows and table not in allow_empty:
                raise ValueError(f"{table} is empty")
            if key:
                require_unique(self._read(dataset, table, entry), key, table)
        self._commit(dataset, lambda _: entries, lambda _: None)
        return {t: _rows(e) for t, e in entries.items()}

    def upsert(self, dataset: str, frames: dict[str, DataFrame], keys: dict[str, Sequence[str]], *, keep_absent: bool = False, order: str | None = None, parts: dict[str, Parts] | None = None) -> dict[str, int]:
        """Merges batches by their keys, all tables or none; a later row of a key wins within a batch by ``order``.

        Only the parts that a batch touches are read and written. A table keeps the parts it was made with. All are written
        again where a column of the batch widens the table's type.
        """
        check_names([dataset, *frames], [c for df in frames.values() for c in df.columns])
        batches = {t: prepare_batch(df, keys[t], t, order) for t, df in frames.items()}
        split = lambda tables, t: Parts(**tables[t]["by"]) if t in tables else (parts or {}).get(t, Parts())
        met: dict[str, set] = {}

        def touched(tables: dict):
            """The batch's parts, and their versions; a table's schema as well, as others may widen it."""
            for t, df in batches.items():
                if t not in met:
                    met[t] = {r[0] for r in df.select(split(tables, t).of(keys[t])).distinct().collect()}
            return {t: (tables[t]["schema"], {p: v for p, v in tables[t]["parts"].items() if p in met[t]}) if t in tables else None for t in batches}

        def attempt(tables: dict) -> dict:
            out = {}
            for t, batch in batches.items():
                old = tables.get(t)
                merged, whole = batch, True
                if old:
                    merged = merge(self._read(dataset, t, old, met[t]), batch, keys[t], keep_absent=keep_absent)
                    kept = {f["name"]: f["type"] for f in old["schema"]["fields"]}
                    whole = any(kept.get(f["name"], f["type"]) != f["type"] for f in json.loads(merged.schema.json())["fields"])
                    if whole:
                        merged = merge(self._read(dataset, t, old), batch, keys[t], keep_absent=keep_absent)
                entry = self._stage(dataset, t, merged, split(tables, t), keys[t])
                require_unique(self._read(dataset, t, entry), keys[t], t)
                out[t] = entry if whole else (lambda now, entry=entry: entry | {"parts": now["parts"] | entry["parts"]})
            return out

        # a part that others add meanwhile must not be lost if all are written again
        published = self._commit(dataset, attempt, lambda tables: (touched(tables), {t: tables[t]["parts"] for t in batches if t in tables and _widens(tables[t], batches[t])}))
        return {t: _rows(published[t]) for t in frames}

    def rebuild(self, dataset: str, table: str, df: DataFrame, key: Sequence[str]) -> int:
        """Full rebuild of a derived table."""
        return self.replace(dataset, {table: df}, allow_empty=[table], primary_keys={table: key})[table]

    def copy_to(self, other: "Warehouse", dataset: str) -> dict[str, int]:
        """Copies every published table of a dataset and compares the counts."""
        tables = self.manifest(dataset)[1]
        frames = {t: self._read(dataset, t, e) for t, e in tables.items()}
        counts = other.replace(dataset, frames, allow_empty=list(frames))
        for table, entry in tables.items():
            if _rows(entry) != counts[table]:
                raise ValueError(f"{table}: the copy has {counts[table]} rows, not {_rows(entry)}")
        return counts


def _rows(entry: dict) -> int:
    return sum(n for _, n in entry["parts"].values())


def _widens(entry: dict, batch: DataFrame) -> bool:
    kept = {f["name"]: f["type"] for f in entry["schema"]["fields"]}
    return any(kept.get(f["name"], f["type"]) != f["type"] for f in json.loads(batch.schema.json())["fields"])


def require_unique(df: DataFrame, key: Sequence[str], name: str = "table") -> None:
    """Raises if a key member is null or a key repeats; partial counts come before the exchange."""
    empty = F.lit(False)
    for c in key:
        empty = empty | F.col(c).isNull()
    if (n := df.where(empty).limit(1).count()) or df.groupBy(*key).count().where("count > 1").limit(1).count():
        raise ValueError(f"{name}: {'null' if n else 'duplicate'} key {tuple(key)}")


def prepare_batch(batch: DataFrame, key: Sequence[str], name: str = "batch", order: str | None = None) -> DataFrame:
    """A batch ready to merge: keys present and not null, not empty, the last row of each key."""
    if missing := set(key) - set(batch.columns):
        raise ValueError(f"{name} lacks {sorted(missing)}")
    empty = F.lit(False)
    for c in key:
        empty = empty | F.col(c).isNull()
    facts = batch.agg(F.count("*").alias("n"), F.count_if(empty).alias("nulls")).first()
    if not facts["n"] or facts["nulls"]:
        raise ValueError(f"{name}: {facts['n']} rows, {facts['nulls']} with a null key")
    by = [F.col(order)] if order else [F.struct(*batch.columns)]
    return keep_last(batch, key, by, null_keys="group")


def merge(target: DataFrame, batch: DataFrame, key: Sequence[str], *, keep_absent: bool = False) -> DataFrame:
    """Rows of the batch replace those of equal key, the rest stays; columns of both are kept.

    Columns that the batch lacks become null on replaced rows, or keep the old value with ``keep_absent``.
    """
    absent = [c for c in target.columns if c not in batch.columns]
    if keep_absent and absent:
        batch = batch.join(target.select(*key, *absent), list(key), "left")
    for c in set(target.columns) & set(batch.columns):
        if target.schema[c].dataType != batch.schema[c].dataType:  # a column that has widened to text
            target, batch = target.withColumn(c, F.col(c).cast("string")), batch.withColumn(c, F.col(c).cast("string"))
    return target.join(batch.select(*key), list(key), "left_anti").unionByName(batch, allowMissingColumns=True)


HISTORY = "run_id string, job_id string, dataset string, source_kind string, run_status string, dq_status string, results string, dq_results string, stage_durations string, failure_stage string, error_type string, error_message string, started_at timestamp, finished_at timestamp, created_at timestamp, elapsed_seconds double"


#: History is split by the hash of a run's id, so recording a run rewrites a small share of it.
HISTORY_PARTS = Parts(buckets=64)


def record_run(warehouse: Warehouse, run: dict) -> None:
    """Writes one run to the history by its id, apart from the load, so that a failed load is recorded as well."""
    row = warehouse.spark.createDataFrame([tuple(run.get(f.split()[0]) for f in HISTORY.split(", "))], HISTORY)
    warehouse.upsert("monitoring", {"run_history": row}, {"run_history": ["run_id"]}, parts={"run_history": HISTORY_PARTS})
