"""What the corpus operators share: words, working folders and table access."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Runs of anything but ASCII white space; the same bytes that ``bytes.split()`` keeps.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text in order; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and every executor can reach.

    It lies in ``spark.checkpoint.dir``. Where that is unset (single-machine tests) it is
    set to a temporary folder once for the session.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("docketlake.shared.dir", None)
    if not base:
        base = f"file://{tempfile.mkdtemp(prefix='docketlake-')}"
        spark.conf.set("docketlake.shared.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage so that later
    stages survive lost executors without computing it again."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows that go to a Python worker at a time; Spark's 10,000 are many megabytes of whole texts.
BATCH_ROWS = 1000


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside hands texts to Python workers in small Arrow batches."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Names like the wanted ones that no column of ``df`` has, whatever its case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


#: Bits of a sieve: 2 MB of data, whatever goes through it.
SIEVE_BITS = 1 << 24


def _with_bit(df: DataFrame, name: str, keys: DataFrame, how: str) -> DataFrame:
    bits = keys.select(F.pmod("key", F.lit(SIEVE_BITS)).cast("int").alias("_p")).groupBy(F.shiftright("_p", 6).alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, _p & 63)")).alias("_bits"))
    d = df.withColumn("_p", F.pmod(F.col(name), F.lit(SIEVE_BITS)).cast("int")).withColumn("_word", F.shiftright("_p", 6))
    return d.join(F.broadcast(bits), "_word", how).withColumn("_bit", F.expr("coalesce((_bits & shiftleft(1L, _p & 63)) <> 0, false)"))


def sieved(df: DataFrame, name: str, keys: DataFrame) -> DataFrame:
    """The rows of ``df`` whose long column ``name`` may be among the column ``key`` of ``keys``:
    all that are, and others by chance. A join on the column must follow; it then moves few
    rows. The table of bits is broadcast, and its size is fixed."""
    return _with_bit(df, name, keys, "inner").where("_bit").select(*df.columns)


def parted(df: DataFrame, name: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that are not among ``keys``, which need no join, and those that may be. As
    ``sieved``; reads ``df`` twice. The columns of the user are held in one, so that names
    don't clash."""
    held = df.select(F.struct(*df.columns).alias("row"), F.col(name).alias("_name"))
    d = _with_bit(held, "_name", keys, "left")
    return d.where("not _bit").select("row.*"), d.where("_bit").select("row.*")


def trim() -> None:
    """Gives freed memory of a Python worker back, so that idle workers weigh little."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def lean(run):
    """A function for mapInArrow whose worker gives its memory back when a task is over, when
    nothing of the task is held any more, and when one begins."""

    def wrapped(batches):
        trim()
        yield from run(batches)
        trim()

    return wrapped
