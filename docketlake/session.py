"""Session builder and table access shared by queries, tests and the bench."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None, memory: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; on a cluster leave ``master`` unset."""
    builder = SparkSession.builder.appName("docketlake")
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if memory:
        builder = builder.config("spark.driver.memory", memory)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(os.environ.get("DOCKETLAKE_LOG", "ERROR"))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables; the path may be any URI Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
