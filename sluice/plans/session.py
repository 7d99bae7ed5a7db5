"""Sessions: the settings that the operators rely on, and the library on the workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[2]
_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """UTC, adaptive execution, and this package on every worker; the cluster's other settings stay."""
    for key, value in {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}.items():
        spark.conf.set(key, value)
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        _SHIPPED.add(app)
        archive = os.path.join(tempfile.mkdtemp(prefix="sluice-"), "sluice_library.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(ROOT.joinpath("sluice").rglob("*.py")):
                z.write(f, f.relative_to(ROOT))
        spark.sparkContext.addPyFile(archive)
    return spark


def local(cores: str = "8", **conf) -> SparkSession:
    """A session on this machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("sluice")
    base = {"spark.sql.shuffle.partitions": cores, "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.sql.session.timeZone": "UTC"}
    for k, v in (base | conf).items():
        builder = builder.config(k, v)
    return prepare(builder.getOrCreate())
