"""State of crawls and runs as tables: checkpoints, watermark writes, the run ledger, metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .orchestration import TERMINAL_RUNS

STATES = ("pending", "running", *TERMINAL_RUNS)
SCHEMA = 2


def enqueue(pending: Column, completed: Column, units: Column) -> Column:
    """Work with more units, in order, without blank, queued or completed ones."""
    more = F.filter(units, lambda u: (u != "") & ~F.array_contains(completed, u))
    return F.array_distinct(F.concat(F.filter(pending, lambda u: ~F.array_contains(completed, u)), more))


def mark_done(pending: Column, completed: Column, unit: Column) -> tuple[Column, Column]:
    """(pending, completed) after a unit; doing it twice changes nothing."""
    return F.filter(pending, lambda u: u != unit), F.array_distinct(F.concat(completed, F.array(unit)))


def checkpoint_json(d: DataFrame) -> Column:
    """A checkpoint row as JSON of schema 2, keys in order."""
    blank = F.struct().cast("struct<>")
    fields = sorted({"schema": F.lit(SCHEMA), "metadata": blank, **{c: F.col(c) for c in ("jurisdiction", "stream", "cursor", "completed", "pending", "attempt")}}.items())
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields]))


def read_checkpoint(raw: Column) -> Column:
    """The checkpoint of a JSON text; older schemas are read, a newer one or an unusable text
    gives null."""
    c = F.from_json(raw, "schema int, jurisdiction string, stream string, cursor string, completed array<string>, pending array<string>, attempt int")
    usable = (F.coalesce(c["schema"], F.lit(1)) <= SCHEMA) & (F.coalesce(c["jurisdiction"], F.lit("")) != "")
    none = F.array().cast("array<string>")
    done = F.array_distinct(F.coalesce(c["completed"], none))
    left = F.filter(F.array_distinct(F.coalesce(c["pending"], none)), lambda u: ~F.array_contains(done, u))
    out = F.struct(F.lower(F.trim(c["jurisdiction"])).alias("jurisdiction"), F.coalesce(F.nullif(F.trim(c["stream"]), F.lit("")), F.lit("default")).alias("stream"), F.coalesce(c["cursor"], F.lit("")).alias("cursor"), done.alias("completed"), left.alias("pending"), F.coalesce(c["attempt"], F.lit(0)).alias("attempt"))
    return F.when(usable, out)


def put_watermarks(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming watermarks (jurisdiction, stream, position, revision) with ``accepted``: a write
    whose revision is not above the stored one stems from a stale read."""
    keys = ["jurisdiction", "stream"]
    have = stored.select(*keys, F.col("revision").alias("stored_revision"))
    return incoming.join(have, keys, "left").withColumn("accepted", F.coalesce(F.col("revision") > F.col("stored_revision"), F.lit(True)))


def run_ledger(events: DataFrame) -> DataFrame:
    """Runs from their events (run_id, jurisdiction, at, event start/record/finish, state, seen,
    written, skipped, failures, blocking). The first start counts; counters add up; a run that
    closes as succeeded with blocking findings is partial."""
    last = F.max_by("state", F.when(F.col("event") == "finish", F.struct("at")))
    n = lambda c: F.coalesce(F.sum(F.when(F.col("event") == "record", F.col(c))), F.lit(0)).alias(c)
    d = events.groupBy("run_id").agg(F.min_by("jurisdiction", "at").alias("jurisdiction"), F.min(F.when(F.col("event") == "start", F.col("at"))).alias("started_at"), F.max(F.when(F.col("event") == "finish", F.col("at"))).alias("finished_at"), last.alias("_state"), *[n(c) for c in ("seen", "written", "skipped", "failures", "blocking")])
    closed = F.when(F.col("_state").isin(*STATES), F.col("_state")).otherwise("failed")
    state = F.when(F.col("_state").isNull(), "running").when((closed == "succeeded") & (F.col("blocking") > 0), "partial").otherwise(closed)
    return d.withColumn("state", state).drop("_state")


def list_runs(runs: DataFrame, jurisdiction: str | None = None, state: str | None = None, since: Column | None = None) -> DataFrame:
    """Runs that match, newest first. A state that is none reads as pending."""
    d = runs
    if jurisdiction is not None:
        d = d.where(F.col("jurisdiction") == jurisdiction.strip().lower())
    if state is not None:
        d = d.where(F.col("state") == (state if state in STATES else "pending"))
    if since is not None:
        d = d.where(F.col("started_at") >= since)
    return d.orderBy(F.desc("started_at"), F.desc("run_id"))


def totals(runs: DataFrame, since: Column | None = None) -> DataFrame:
    """One row: runs of each state, zero where none, and the documents written."""
    d = runs if since is None else runs.where(F.col("started_at") >= since)
    return d.agg(*[F.count_if(F.col("state") == s).alias(s) for s in STATES], F.coalesce(F.sum("written"), F.lit(0)).alias("documents_written"))


def metric_key(name: Column, labels: Column) -> Column:
    """name{label=value,...}, labels (a map) in order; the name alone without labels."""
    parts = F.transform(F.array_sort(F.map_entries(labels)), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return F.when(F.size(labels) > 0, F.concat(name, F.lit("{"), F.array_join(parts, ","), F.lit("}"))).otherwise(name)


def metrics_snapshot(samples: DataFrame) -> DataFrame:
    """kind, name, value from samples (key, kind counter/gauge/observation, value, at): sums of
    counters, last gauges, count and sum of observations. A counter that falls fails."""
    safe = F.when((F.col("kind") == "counter") & (F.col("value") < 0), F.raise_error(F.lit("counters cannot decrease")).cast("double")).otherwise(F.col("value"))
    d = samples.withColumn("value", safe).groupBy("kind", "key").agg(F.sum("value").alias("s"), F.max_by("value", "at").alias("last"), F.count("*").cast("double").alias("n"))
    row = lambda kind, name, value: F.struct(F.lit(kind).alias("kind"), name.alias("name"), value.alias("value"))
    rows = F.when(F.col("kind") == "counter", F.array(row("counter", F.col("key"), F.col("s")))).when(F.col("kind") == "gauge", F.array(row("gauge", F.col("key"), F.col("last")))).otherwise(F.array(row("summary", F.concat("key", F.lit("#count")), F.col("n")), row("summary", F.concat("key", F.lit("#sum")), F.col("s"))))
    return d.select(F.inline(rows))


def select_jurisdictions(registry: DataFrame, codes: list[str] | None = None, method: str | None = None, tag: str | None = None) -> DataFrame:
    """The registry's rows by code: the named ones (unknown codes fail), else the enabled ones;
    then of a method or with a tag."""
    wanted = [c.strip().lower() for c in codes or [] if c.strip()]
    if wanted and wanted != ["all"]:
        known = {r["code"] for r in registry.where(F.col("code").isin(wanted)).select("code").collect()}
        if missing := [c for c in wanted if c not in known]:
            raise ValueError(f"unknown jurisdiction: {', '.join(missing)}")
        d = registry.where(F.col("code").isin(wanted))
    else:
        d = registry.where("enabled")
    if method is not None:
        d = d.where(F.col("method") == method)
    if tag is not None:
        d = d.where(F.array_contains("tags", tag))
    return d.orderBy("code")
