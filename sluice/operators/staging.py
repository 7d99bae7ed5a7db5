"""Tables in the shared folder: lineage is cut there, and what several steps read is computed once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names; on one machine a temporary one serves."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="sluice-")
    return f"{folder.rstrip('/')}/sluice-plans-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder, and a scan of it."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
