"""Batch operators over documents: dedupe, diff, quality, loading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.docket import TERMINAL, status_rank

SEVERITIES = ["info", "warn", "error", "critical"]


def merge_actions(actions: DataFrame, *keys: str) -> DataFrame:
    """One row for each (keys, date, wording), as if rows came one by one by ``ord`` and each
    replaced the kept one whole if it knew a chamber or a committee that the kept one lacks.

    The first row that knows both stays for good. Else chamber and committee take turns, and the
    kept row is the first of the last run that knows the same one; else the first row.
    """
    w = Window.partitionBy(*keys, "occurred_on", F.lower("description"))
    knows = F.coalesce(F.col("chamber") != "unknown", F.lit(False)).cast("int") + 2 * F.col("committee").isNotNull().cast("int")
    last = lambda k: F.max(F.when(F.col("_k") == k, F.col("ord"))).over(w)
    d = actions.withColumn("_k", knows).withColumn("_1", last(1)).withColumn("_2", last(2))
    other = F.when(F.col("_k") == 1, F.col("_2")).otherwise(F.col("_1"))
    rank = F.when(F.col("_k") == 3, 0).when((F.col("_k") > 0) & (other.isNull() | (F.col("ord") > other)), 1).when(F.col("_k") == 0, 2).otherwise(3)
    return d.withColumn("_r", F.row_number().over(w.orderBy(rank, "ord"))).where("_r = 1").drop("_k", "_1", "_2", "_r")


def dedupe_batch(docs: DataFrame) -> DataFrame:
    """One document for each id. Scalars come from the most complete observation (the earliest
    of equals) that has them, where blank texts and an unknown status say nothing; dates widen.
    Partial aggregation keeps hot ids small."""
    score = F.struct("n_versions", "n_actions", "n_sponsors", F.col("summary").isNotNull().cast("int").alias("s"), F.length(F.coalesce("title", F.lit(""))).alias("t"), (-F.col("ord")).alias("o"))
    best = lambda c, none="": F.coalesce(F.max_by(c, F.when(~F.coalesce(F.col(c), F.lit(none)).isin("", none), score)), F.max_by(c, score)).alias(c)
    return docs.groupBy("document_id").agg(best("title"), best("summary"), best("status", "unknown"), F.min("introduced_on").alias("introduced_on"), F.max("last_action_on").alias("last_action_on"), F.max("observed_at").alias("observed_at"), F.count("*").alias("n_merged"))


def change_kind(found: Column, before: Column, after: Column, text_changed: Column, similarity: Column, fields_changed: Column, threshold: float = 0.6) -> Column:
    """Kind of a change, by priority: new, withdrawn, text, status, metadata."""
    moved = F.when(before.isin(*TERMINAL) & ~after.isin(*TERMINAL), "status_regressed").when(status_rank(after) > status_rank(before), "status_advanced").otherwise("status_regressed")
    return F.when(~found, "new").when((after == "withdrawn") & (before != "withdrawn"), "withdrawn").when(text_changed, F.when(similarity < threshold, "superseded").otherwise("text_revised")).when(before != after, moved).when(fields_changed, "metadata_only").otherwise("unchanged")


def findings(docs: DataFrame) -> DataFrame:
    """check, severity, subject, message, observed, expected of every fault, from a single scan; duplicate ids and the empty
    batch apart. last_acted_on and last_terminal_on are the latest dates of any action and of one
    that implies a terminal status."""
    latest = F.date_add(F.to_date("batch_observed"), 3)
    none = F.lit(None).cast("string")
    day = lambda c: F.col(c).cast("string")
    n = F.length(F.coalesce("title", F.lit("")))
    future, old = (lambda d: F.col(d) > latest), (lambda d: F.col(d) < F.lit("1900-01-01").cast("date"))
    rows = [
        (F.length(F.coalesce("identifier", F.lit(""))) < 2, "identifier_present", "error", "identifier is too short to be a bill designator", F.col("identifier"), none),
        (n == 0, "title_present", "error", "title missing or implausibly short", F.col("title"), F.lit("at least 8 characters")),
        ((n > 0) & (n < 8), "title_present", "warn", "title missing or implausibly short", F.col("title"), F.lit("at least 8 characters")),
        *[(wrong(d), "dates_plausible", "error", f"{d} {what}", day(d), none) for d in ("introduced_on", "last_action_on") for wrong, what in ((future, "is in the future"), (old, "predates the twentieth century"))],
        (~F.col("status").isin("unknown", "prefiled") & (F.col("n_actions") == 0), "status_supported", "warn", "status set but no actions were captured", F.col("status"), none),
        (F.col("status").isin(*TERMINAL) & (F.col("n_actions") > 0) & (F.col("last_acted_on") > F.col("last_terminal_on")), "terminal_consistency", "warn", "actions recorded after the terminal action", day("last_acted_on"), none),
        ((F.col("chamber") == "unknown") & ~F.col("kind").isin("regulation", "notice"), "chamber_known", "warn", "chamber could not be determined", F.col("identifier"), none),
        (F.col("n_primary") > 1, "sponsor_sanity", "warn", "more than one primary sponsor", F.col("n_primary").cast("string"), F.lit("1")),
        ((F.col("kind") == "bill") & (F.col("n_sponsors") == 0), "sponsor_sanity", "info", "bill has no sponsors", none, none),
    ]
    found = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(k).alias("check"), F.lit(s).alias("severity"), F.lit(m).alias("message"), o.alias("observed"), e.alias("expected"))) for c, k, s, m, o, e in rows]))
    single = docs.select(F.col("document_id").alias("subject"), F.inline(found))
    told = lambda check, severity, message: [F.lit(x).alias(y) for x, y in ((check, "check"), (severity, "severity"), (message, "message"))]
    double = docs.groupBy(F.col("document_id").alias("subject")).count().where("count > 1").select("subject", *told("no_duplicate_ids", "error", "document id appears more than once in the batch"), F.col("count").cast("string").alias("observed"), F.lit("1").alias("expected"))
    nobody = F.lit(None).cast(docs.schema["document_id"].dataType).alias("subject")
    empty = docs.agg(F.count("*").alias("n")).where("n = 0").select(nobody, *told("batch_not_empty", "info", "batch contained no documents"), none.alias("observed"), none.alias("expected"))
    return single.unionByName(double).unionByName(empty).select("check", "severity", "subject", "message", "observed", "expected")


def ordered_findings(found: DataFrame) -> DataFrame:
    """Worst first, then by check, subject and message."""
    return found.orderBy(F.desc(severity_rank(F.col("severity"))), "check", F.coalesce(F.col("subject").cast("string"), F.lit("")), "message")


def severity_rank(severity: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, SEVERITIES)), severity)


def report(found: DataFrame) -> DataFrame:
    """section (severity, check), name, n: counts by severity, zero where none, and by check."""
    levels = found.agg(*[F.count_if(F.col("severity") == s).alias(s) for s in SEVERITIES])
    levels = levels.select(F.inline(F.array(*[F.struct(F.lit("severity").alias("section"), F.lit(s).alias("name"), F.col(s).alias("n")) for s in SEVERITIES])))
    return levels.unionByName(found.groupBy(F.col("check").alias("name")).agg(F.count("*").alias("n")).select(F.lit("check").alias("section"), "name", "n"))


def gate(found: DataFrame, documents: DataFrame, waived: tuple[str, ...] = (), max_errors: int = 0, max_rate: float = 0.0) -> DataFrame:
    """One row: counts by severity, whether the batch passes, the worst severity, and what
    blocks. Findings of waived checks stay, as warnings. A rate within the allowance overrides
    the number of errors; one over it blocks."""
    grave = F.when(F.col("check").isin(*waived) & F.col("severity").isin("error", "critical"), "warn").otherwise(F.col("severity")) if waived else F.col("severity")
    by = lambda s: F.array_sort(F.collect_set(F.when(F.col("severity") == s, F.col("check")))).alias(f"_{s}")
    counts = found.withColumn("severity", grave).agg(*[F.count_if(F.col("severity") == s).alias(s) for s in SEVERITIES], by("critical"), by("error"), F.max_by("severity", severity_rank(F.col("severity"))).alias("_worst"))
    rate = F.when(F.col("documents") > 0, F.col("error") / F.col("documents")).otherwise(0.0)
    allowed = (rate <= max_rate) if max_rate > 0 else F.lit(False)
    over = (rate > max_rate) if max_rate > 0 else F.lit(False)
    blocked = (F.col("critical") > 0) | ((F.col("error") > max_errors) & ~allowed)
    none = F.array().cast("array<string>")
    reasons = F.array_distinct(F.concat(F.col("_critical"), F.when(blocked, F.col("_error")).otherwise(none), F.when(over, F.array(F.lit("error_rate"))).otherwise(none)))
    return counts.join(documents.agg(F.count("*").alias("documents"))).select(*reversed(SEVERITIES), "documents", (~(blocked | over)).alias("passed"), F.array_join(reasons, ",").alias("blocked_by"), F.coalesce("_worst", F.lit("info")).alias("worst"))


def enforce(decision: DataFrame) -> DataFrame:
    """The decision; fails where the batch is blocked."""
    failed = F.raise_error(F.concat(F.lit("quality gate blocked the batch: "), "blocked_by")).cast("boolean")
    return decision.withColumn("passed", F.when(F.col("passed"), True).otherwise(failed))


def replace_children(stored: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Child rows after a load: all of a loaded parent's rows are replaced, also by none."""
    return stored.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def batches(rows: DataFrame, order: str, size: int) -> DataFrame:
    """Batch numbers without a global window: places within range partitions plus the counts
    of the partitions before them (one small row for each partition)."""
    d = rows.repartitionByRange(order).sortWithinPartitions(order).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    before = d.groupBy("_p").count().withColumn("_base", F.sum("count").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)))
    return d.join(F.broadcast(before.select("_p", F.coalesce("_base", F.lit(0)).alias("_base"))), "_p").withColumn("batch", F.floor((F.col("_base") + F.col("_i")) / size)).drop("_p", "_i", "_base")
