"""Intermediate tables in the shared folder, removed when their consumer has ended."""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, SparkSession

from gridlens.session import scratch_path


def written(df: DataFrame, label: str, made: list[str] | None = None, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table; its path is added to ``made``."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{label}")
    writer = df.write
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    if made is not None:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables this process wrote to the shared folder and no longer needs."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)
    paths.clear()


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Inside, Spark deletes a query's shuffle files when it ends, and not when the driver next collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
