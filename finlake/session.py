"""Session defaults.

A cluster normally brings its own session; every setting here is one a cluster
operator may override.  ``shuffle_partitions`` is only the starting point: AQE
coalesces small partitions and splits skewed ones at run time.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "finlake", master: str | None = None,
                  shuffle_partitions: int | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master).config("spark.driver.memory", os.environ.get("FINLAKE_DRIVER_MEMORY", "8g"))
        b = b.config("spark.ui.enabled", "false")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return (
        b.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "zstd")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """Folder of this application for streaming checkpoints, lineage cuts and intermediate tables.

    A cluster names a shared folder in ``spark.checkpoint.dir``.  Only a local session may do
    without one: it gets a single temporary folder.  The folder goes when the session ends.
    """
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not re.match(r"local(\[|$)", spark.sparkContext.master):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            shared = tempfile.mkdtemp(prefix="finlake-")
        _ROOTS[app] = f"{shared.rstrip('/')}/finlake-{app}"
        path = spark._jvm.org.apache.hadoop.fs.Path(_ROOTS[app])
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return _ROOTS[app]


_ROOTS: dict[str, str] = {}


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder."""
    return f"{checkpoint_root(spark)}/{kind}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back: a lineage cut that survives lost executors."""
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: written once to the shared folder, read back by later stages.

    Used where a result is read several times (daily bars feeding many features, the
    matrix feeding the passes of a model).  Unlike a cache it survives lost executors.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(checkpoint_root(df.sparkSession))
    return df.checkpoint()
