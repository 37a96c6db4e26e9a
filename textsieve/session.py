"""Session construction and the shared scratch location.

Intermediate tables that must survive executor loss are written under the
cluster's ``spark.checkpoint.dir`` (a shared file system).  The setting is read
from the session; only a local session gets a private default, as in tests.
"""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # delete checkpoint files once the checkpointed DataFrame is unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(app: str = "textsieve", master: str | None = None, shuffle_partitions: int | None = None,
              conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint directory.

    A local session without one (as in tests) gets a private folder.  On a
    cluster it must be set: a folder of the driver is not visible to executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="textsieve-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def write_scratch(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to a fresh scratch table and read it back (columnar, lineage cut, survives lost executors)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, for clusters where it is not installed."""
    if spark.sparkContext.applicationId in _shipped:
        return
    _shipped.add(spark.sparkContext.applicationId)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    base = os.path.join(tempfile.mkdtemp(prefix="textsieve-zip-"), "textsieve")
    spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", root, "textsieve"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint directory for a written table."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")
