"""The corpus pipeline: five stages, each over all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.llm.common import fresh, kept_table, parted, shared_folder, table
from docketlake.llm.decontamination import decontaminate
from docketlake.llm.jaccard_join import keep_one
from docketlake.llm.mixing import mix_sources
from docketlake.llm.quality_rules import quality_rules
from docketlake.llm.token_output import token_output


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the base rule or a certified cutoff rejects."""
    (row,) = fresh(docs, "_row")
    own = docs.withColumn(row, F.xxhash64("doc_id", "lang", "text"))
    judged = quality_rules(own.select("doc_id", "text", "lang", row), table(spark, sf_dir, "labels"), keep=(row,))
    bad = kept_table(judged.where(~F.col("kept")).select(row).distinct(), "rejected")
    clear, rest = parted(own, row, bad.select(F.col(row).alias("key")))
    return clear.unionByName(rest.join(bad, row, "left_anti").select(*own.columns)).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of similar ones."""
    return keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents to the target weights of their sources, in global random order."""
    return mix_sources(docs).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token shards, in the order that the mixing left, and returns what they say of
    each document."""
    return token_output(spark, docs, ordered=False)


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", near_copies),
    ("decontamination", benchmark_leaks),
    ("mixing", mixture),
    ("token_output", tokens),
]

#: The join and the token ids are beyond SQL; tests/llm holds the run against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
