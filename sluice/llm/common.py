"""Shared plumbing of the operators: tables, the shared scratch folder, Arrow batches, bounded memos."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the provided Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Only where the setting is absent from a local session (one machine, one folder) a temporary folder serves; elsewhere an
    error says what to set, as executors could not see each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="sluice-")
    return _LOCAL[app]


#: Temporary folders of local sessions without the setting, by application.
_LOCAL: dict[str, str] = {}


def materialise(df: DataFrame, label: str, **options) -> DataFrame:
    """Writes ``df`` to the shared folder once, with a writer's ``options``, and returns a scan of what was written.

    Cuts lineage: a lost executor costs a re-read of finished files, never a recomputation of the stages before.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/sluice-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _WRITTEN[id(out)] = (out, path)
    return out


#: Tables of ``materialise`` that may be discarded yet, by the identity of their DataFrame.
_WRITTEN: dict[int, tuple[DataFrame, str]] = {}


def discard(*tables: DataFrame) -> None:
    """Deletes tables of ``materialise`` that nothing still to be run reads."""
    for df in tables:
        _, path = _WRITTEN.pop(id(df), (None, None))
        if path:
            jvm, session = df.sparkSession._jvm, df.sparkSession._jsparkSession
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(session.sessionState().newHadoopConf()).delete(place, True)


def small_batches(spark: SparkSession) -> None:
    """Bounds an Arrow batch by rows and by bytes: texts may be long, and a worker holds a batch at a time.

    A row longer than the bound is a batch of its own.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


class Memo(dict):
    """A dictionary that fills itself by ``make(key)`` within ``limit`` bytes.

    Bytes are counted as the length of keys and values and an allowance for each entry. It has two generations: when the
    younger is half the limit it becomes the older one, whose place it takes; what is asked for again moves to the younger,
    so frequent keys stay. Keys longer than ``longest`` are made anew each time: long words are rarely met again.
    """

    ENTRY = 200

    def __init__(self, make, limit: int, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest, self.held, self.older = make, limit, longest, 0, {}

    def __missing__(self, key):
        value = self.older[key] if key in self.older else self.make(key)
        if len(key) > self.longest:
            return value
        if 2 * self.held >= self.limit:
            self.older = dict(self)
            self.clear()
            self.held = 0
        self.held += self.ENTRY + len(key) + (len(value) if value is not None else 0)
        self[key] = value
        return value
