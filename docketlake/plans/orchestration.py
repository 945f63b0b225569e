"""Planning and monitoring over state tables: all are joins, windows and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAFETY_LAG = 15 * 60
FRESH = 900
TERMINAL_RUNS = ("succeeded", "partial", "failed", "abandoned")


def advance_watermarks(seen: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """seen: jurisdiction, observed_through. Never rewinds; every advance is a revision."""
    new = seen.groupBy("jurisdiction").agg((F.max("observed_through") - F.make_interval(mins=F.lit(15))).alias("new"))
    if stored is None:
        return new.select("jurisdiction", F.col("new").alias("observed_through"), F.lit(1).alias("revision"))
    return new.join(stored, "jurisdiction", "full").select("jurisdiction", F.greatest("observed_through", "new").alias("observed_through"), (F.coalesce("revision", F.lit(0)) + F.col("new").isNotNull().cast("int")).alias("revision"))


def lag_seconds(observed: Column, as_of: Column) -> Column:
    """Never below 0; null if nothing was observed."""
    return F.when(observed.isNotNull(), F.greatest(F.lit(0), F.unix_timestamp(as_of) - F.unix_timestamp(observed)))


def scored(jurisdictions: DataFrame, watermarks: DataFrame, as_of: Column) -> DataFrame:
    """code, method, lag, score, reason of every enabled jurisdiction; the never ingested lead."""
    lag = lag_seconds(F.col("observed_through"), as_of)
    weight = F.when(F.array_contains("tags", "federal"), 2.0).when(F.array_contains("tags", "large"), 1.5).otherwise(1.0)
    score = F.when(lag.isNull(), F.lit(float("inf"))).when(lag < FRESH, 0.0).otherwise(lag * weight)
    reason = F.when(lag.isNull(), "never ingested").when(lag < FRESH, "within freshness target").otherwise("stale")
    d = jurisdictions.where("enabled").join(watermarks.select("jurisdiction", "observed_through"), F.col("code") == F.col("jurisdiction"), "left")
    return d.select("code", "method", lag.alias("lag"), score.alias("score"), reason.alias("reason"))


def schedule(jurisdictions: DataFrame, watermarks: DataFrame, as_of: Column, parallel: int = 8, browsers: int = 2) -> DataFrame:
    """Constrained top-k by staleness: at most ``parallel`` in all, ``browsers`` of them by
    browser. Two limits replace the greedy loop, as a browser beyond its own limit leaves its
    place to the next."""
    d = scored(jurisdictions, watermarks, as_of).where("score > 0")
    order = [F.desc("score"), F.asc("code")]
    shared = F.coalesce(F.col("method") == "browser", F.lit(False))
    best = d.where(~shared).orderBy(*order).limit(parallel).union(d.where(shared).orderBy(*order).limit(browsers))
    return best.orderBy(*order).limit(parallel).select("code", "method", "score")


def schedule_decisions(jurisdictions: DataFrame, watermarks: DataFrame, as_of: Column, parallel: int = 8, browsers: int = 2) -> DataFrame:
    """code, lag, reason, selected: also those that are deferred. At most ``parallel`` rows are
    broadcast."""
    chosen = schedule(jurisdictions, watermarks, as_of, parallel, browsers).select("code", F.lit(True).alias("selected"))
    d = scored(jurisdictions, watermarks, as_of).join(F.broadcast(chosen), "code", "left")
    return d.select("code", "lag", "reason", F.coalesce("selected", F.lit(False)).alias("selected"))


def run_summary(runs: DataFrame) -> DataFrame:
    states = ("pending", "running", *TERMINAL_RUNS)
    return runs.groupBy("jurisdiction").agg(*[F.count_if(F.col("state") == s).alias(s) for s in states], F.sum("documents_written").alias("documents_written"))


def failure_streaks(runs: DataFrame) -> DataFrame:
    """Failures in a row among the latest finished runs: those after the latest that is no
    failure. Both sums are partial, so a jurisdiction with most of the runs stays small."""
    d = runs.where(F.col("state").isin(*TERMINAL_RUNS)).select("jurisdiction", "state", F.struct("started_at", "run_id").alias("_at"))
    last = d.groupBy("jurisdiction").agg(F.max(F.when(F.col("state") != "failed", F.col("_at"))).alias("_last"))
    return d.join(last, "jurisdiction").groupBy("jurisdiction").agg(F.count_if(F.col("_last").isNull() | (F.col("_at") > F.col("_last"))).alias("streak"))


def alerts(jurisdictions: DataFrame, watermarks: DataFrame, runs: DataFrame, as_of: Column, warn_hours: int = 6, critical_hours: int = 24, warn_failures: int = 2, critical_failures: int = 4) -> DataFrame:
    """jurisdiction, rule, severity, message, value of enabled jurisdictions that need a look."""
    j = jurisdictions.where("enabled").select(F.col("code").alias("jurisdiction"))
    lag = lag_seconds(F.col("observed_through"), as_of)
    grave, late = lag >= critical_hours * 3600, lag >= warn_hours * 3600
    stale = j.join(watermarks.select("jurisdiction", "observed_through"), "jurisdiction", "left").select(
        "jurisdiction", F.when(lag.isNull(), "never_ingested").otherwise("stale_watermark").alias("rule"), F.when(lag.isNull() | grave, "critical").when(late, "warn").alias("severity"),
        F.when(lag.isNull(), "jurisdiction has no watermark at all").when(grave, "watermark is critically stale").otherwise("watermark is behind the freshness target").alias("message"), lag.cast("double").alias("value"),
    )
    n = F.coalesce("streak", F.lit(0))
    grave = n >= critical_failures
    failing = j.join(failure_streaks(runs), "jurisdiction", "left").select("jurisdiction", F.lit("consecutive_failures").alias("rule"), F.when(grave, "critical").when(n >= warn_failures, "warn").alias("severity"), F.when(grave, "ingest has failed repeatedly").otherwise("ingest is failing").alias("message"), n.cast("double").alias("value"))
    return stale.unionByName(failing).where("severity is not null")


def ordered_alerts(found: DataFrame) -> DataFrame:
    """Worst first, then by jurisdiction and rule."""
    return found.orderBy((F.col("severity") != "critical").cast("int"), "jurisdiction", "rule")


def backfill(jurisdictions: DataFrame, through: Column, chunk_days: int = 30, completed: DataFrame | None = None, max_slices: int | None = None) -> DataFrame:
    """jurisdiction, session, start, end, label, priority (first year of the session): sessions
    (biennial ones from odd years) from 1900 on cut into chunks, without the completed ones;
    of each jurisdiction at most ``max_slices``, from the newest session on."""
    since = F.greatest("from_year", F.lit(1900))
    first = since - F.when(F.col("biennial") & (since % 2 == 0), 1).otherwise(0)
    step = F.when(F.col("biennial"), 2).otherwise(1)
    d = jurisdictions.withColumn("_step", step).withColumn("_year", F.explode(F.sequence(first, F.year(through), step)))
    session = F.when(F.col("biennial"), F.concat_ws("-", "_year", F.col("_year") + 1)).otherwise(F.col("_year").cast("string"))
    last = F.least(F.make_date(F.col("_year") + F.col("_step") - 1, F.lit(12), F.lit(31)), through)
    d = d.select("jurisdiction", session.alias("session"), F.make_date("_year", F.lit(1), F.lit(1)).alias("_from"), last.alias("_last"), F.col("_year").alias("priority")).where("_from <= _last")
    d = d.withColumn("start", F.explode(F.sequence("_from", "_last", F.make_dt_interval(days=F.lit(chunk_days)))))
    d = d.withColumn("end", F.least(F.date_add("start", chunk_days - 1), "_last")).select("jurisdiction", "session", "start", "end", F.concat_ws(":", "jurisdiction", "session", F.col("start").cast("string")).alias("label"), "priority")
    if completed is not None:
        d = d.join(completed.select("label"), "label", "left_anti").select(*d.columns)
    if max_slices is not None:  # a jurisdiction has few slices: years times chunks of a year
        w = Window.partitionBy("jurisdiction").orderBy(F.desc("priority"), "start")
        d = d.withColumn("_i", F.row_number().over(w)).where(F.col("_i") <= max_slices).drop("_i")
    return d


def take(slices: DataFrame, count: int) -> DataFrame:
    """The first ``count`` slices of all jurisdictions, newest sessions first."""
    if count < 0:
        raise ValueError("count cannot be negative")
    return slices.orderBy(F.desc("priority"), "jurisdiction", "start").limit(count)
