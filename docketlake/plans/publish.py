"""Publishing of loaded documents: the snapshot of the latest rows, and indexes behind an alias."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def snapshot(stored: DataFrame, batch: DataFrame, key: str = "document_id", order: str = "ord") -> DataFrame:
    """``stored`` after a batch: the latest row by ``order`` of each key of the batch replaces
    the stored one. Partial aggregation keeps a key that comes often small."""
    columns = stored.columns
    latest = batch.groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("_r")).select("_r.*")
    return stored.join(latest.select(key), key, "left_anti").select(*columns).unionByName(latest)


def notable(changes: DataFrame) -> DataFrame:
    return changes.where(~F.col("kind").isin("unchanged", "metadata_only"))


def index_name(prefix: str, stamp: str) -> str:
    return f"{prefix}-documents-{stamp}".lower()


def build_index(documents: DataFrame, root: str, prefix: str, stamp: str) -> str:
    """Write the documents as a new index beside the others; its path."""
    path = f"{root.rstrip('/')}/{index_name(prefix, stamp)}"
    documents.write.mode("errorifexists").parquet(path)
    return path


def flip_alias(spark: SparkSession, path: str, alias: str) -> DataFrame:
    """Let the view ``alias`` show the index at ``path``; an empty index is refused and the view
    stays as it was."""
    index = spark.read.parquet(path)
    if index.isEmpty():
        raise ValueError("refusing to alias an empty index")
    index.createOrReplaceTempView(alias)
    return spark.table(alias)
