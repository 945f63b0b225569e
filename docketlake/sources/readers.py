"""Readers and the lake writer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_feed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank and malformed lines are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_batch(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A whole JSON document (an object or a list); malformed input fails."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_bill_xml(spark: SparkSession, path: str, schema: str, row_tag: str = "bill") -> DataFrame:
    return spark.read.schema(schema).option("rowTag", row_tag).format("xml").load(path)


def api_items(pages: DataFrame, item_schema: str, column: str = "body") -> tuple[DataFrame, DataFrame]:
    """(items, errors) of JSON pages; a page without the envelope is an error, not empty."""
    parsed = pages.withColumn("_p", F.from_json(column, f"items array<struct<{item_schema}>>, nextCursor string"))
    good = parsed.where("_p.items is not null")
    return good.select("*", F.inline("_p.items")).drop("_p"), parsed.where("_p is null or _p.items is null").select(column, F.lit("missing envelope").alias("error"))


def archive_keys(fetches: DataFrame, prefix: str = "raw") -> DataFrame:
    """Keys of raw payloads: jurisdiction, day of the fetch (1970-01-01 if none), digest."""
    day = F.coalesce(F.to_date("fetched_at"), F.lit("1970-01-01").cast("date")).cast("string")
    return fetches.withColumn("key", F.concat(F.lit(f"{prefix or 'raw'}/"), F.lower("jurisdiction"), F.lit("/"), day, F.lit("/"), F.sha2("body", 256), F.lit(".bin")))


def manifest_key(jurisdiction: Column, day: Column, run_id: Column) -> Column:
    """Key of the list of objects that a run wrote."""
    return F.concat(F.lit("manifests/"), F.lower(jurisdiction), F.lit("/"), day.cast("string"), F.lit("/"), run_id, F.lit(".json"))


def archivable(fetches: DataFrame) -> DataFrame:
    """Successful responses only."""
    return fetches.where("status between 200 and 299")


def new_objects(fetches: DataFrame, existing: DataFrame, prefix: str = "raw") -> DataFrame:
    """Fetches whose key isn't stored, one for each key. An empty body fails the write."""
    refused = F.raise_error(F.lit("refusing to archive an empty body")).cast("binary")
    body = F.when(F.octet_length("body") > 0, F.col("body").cast("binary")).otherwise(refused)
    return archive_keys(fetches.withColumn("body", body), prefix).dropDuplicates(["key"]).join(existing.select("key"), "key", "left_anti")


def archive_stats(fetches: DataFrame, existing: DataFrame) -> DataFrame:
    """written, skipped, objects of a write of ``fetches``."""
    keys = archive_keys(fetches).groupBy("key").agg(F.count("*").alias("n"))
    stored = existing.select("key", F.lit(True).alias("stored")).distinct()
    n = keys.join(stored, "key", "left").agg(F.count_if(F.col("stored").isNull()).alias("written"), F.coalesce(F.sum("n"), F.lit(0)).alias("objects"))
    return n.select("written", (F.col("objects") - F.col("written")).alias("skipped"), "objects")


def write_archive(fetches: DataFrame, path: str, existing: DataFrame) -> None:
    """Append new objects under ``path``, by jurisdiction and day."""
    d = new_objects(archivable(fetches), existing).withColumns({"jurisdiction": F.lower("jurisdiction"), "day": F.split("key", "/")[2]})
    d.write.mode("append").partitionBy("jurisdiction", "day").parquet(path)
