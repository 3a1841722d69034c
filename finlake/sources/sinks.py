"""Parquet sinks: partitioned by time, sorted by identity key, safe to re-run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.operators.dedup import merge_latest


def _part(time: str | None, grain: str) -> tuple[str, Column]:
    if time is None:  # a table of current facts is one partition
        return "year", F.lit(0)
    if grain == "month":
        return "ym", F.date_format(time, "yyyyMM").cast("int")
    return "year", F.year(time)


def _arranged(df: DataFrame, part: str, keys: Sequence[str]) -> DataFrame:
    # REBALANCE lets AQE merge small output partitions and split a hot one, so a heavy
    # year becomes several files instead of one straggling task.
    return df.hint("rebalance", F.col(part)).sortWithinPartitions(part, *keys)


def append(df: DataFrame, path: str, time: str | None, keys: Sequence[str], grain: str = "year") -> None:
    """Bulk append; the sort gives tight row-group statistics on the keys."""
    part, expr = _part(time, grain)
    _arranged(df.withColumn(part, expr), part, keys).write.mode("append").partitionBy(part).parquet(path)


def upsert(spark: SparkSession, incoming: DataFrame, path: str, time: str | None, keys: Sequence[str],
           version: Sequence[str], grain: str = "year") -> None:
    """Load so that loading the same rows again changes nothing.

    Only the partitions that the new rows touch are read and replaced: their values, a few
    years or months, are taken first and become a partition filter.
    """
    part, expr = _part(time, grain)
    new = incoming.withColumn(part, expr)
    if _exists(spark, path):
        touched = [r[0] for r in new.select(part).distinct().collect()]
        old = spark.read.schema(new.schema).parquet(path).filter(F.col(part).isin(touched))
        new = merge_latest(old.select(*new.columns), new, keys, version)
    else:
        new = merge_latest(new.limit(0), new, keys, version)
    (_arranged(new, part, keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(part).parquet(path))


def copy_by_month(df: DataFrame, path: str, time: str, keys: Sequence[str]) -> DataFrame:
    """Month-partitioned copy; returns source and target row counts per month."""
    append(df, path, time, keys, "month")
    target = df.sparkSession.read.parquet(path)
    return reconcile(df.withColumn("ym", _part(time, "month")[1]), target, "ym")


def reconcile(source: DataFrame, target: DataFrame, by: str) -> DataFrame:
    """Row counts of both sides per group, and whether they agree."""
    s = source.groupBy(by).agg(F.count(F.lit(1)).alias("source_rows"))
    t = target.groupBy(by).agg(F.count(F.lit(1)).alias("target_rows"))
    d = s.join(t, by, "full").fillna(0, ["source_rows", "target_rows"])
    return d.withColumn("matches", F.col("source_rows") == F.col("target_rows"))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
