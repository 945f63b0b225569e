"""Incremental loads: micro-batches merge into a snapshot, then the watermark advances."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession


def ingest(stream: DataFrame, load: Callable[[DataFrame, int], None], advance: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run what is available to its end. The watermark moves after the load only, so a batch
    that fails is loaded again; loads are idempotent by derived keys."""

    def batch(df: DataFrame, number: int) -> None:
        df = df.persist()
        try:
            load(df, number)
            advance(df, number)
        finally:
            df.unpersist()

    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def token_bucket(requests: DataFrame, per_minute: float = 10.0, burst: float = 5.0) -> DataFrame:
    """host, t (seconds), admitted, wait: a bucket for each host, refilled by elapsed time."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        level, last, rate = burst, None, per_minute / 60.0
        rows = []
        for t in pdf["t"].sort_values().tolist():
            level = min(burst, level + (t - last) * rate) if last is not None else burst
            last = t
            ok = level >= 1.0
            rows.append((key[0], t, ok, 0.0 if ok else (1.0 - level) / rate))
            level -= 1.0 if ok else 0.0
        return pd.DataFrame(rows, columns=["host", "t", "admitted", "wait"])

    return requests.groupBy("host").applyInPandas(run, "host string, t double, admitted boolean, wait double")


def token_bucket_stream(requests: DataFrame, per_minute: float = 10.0, burst: float = 5.0) -> DataFrame:
    """The same with keyed state; requests that come late count at the latest time seen."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        level, last = state.get if state.exists else (burst, None)
        rate, rows = per_minute / 60.0, []
        for t in sorted(x for b in batches for x in b["t"].tolist()):
            now = t if last is None else max(t, last)
            level = min(burst, level + (now - last) * rate) if last is not None else burst
            last, ok = now, level >= 1.0
            rows.append((key[0], t, ok, 0.0 if ok else (1.0 - level) / rate))
            level -= 1.0 if ok else 0.0
        state.update((level, last))
        yield pd.DataFrame(rows, columns=["host", "t", "admitted", "wait"])

    return requests.groupBy("host").applyInPandasWithState(run, "host string, t double, admitted boolean, wait double", "level double, last double", "append", "NoTimeout")


def event_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)
