"""What changed between two observations of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.docket import TERMINAL
from .documents import change_kind

# The fields that a change of metadata is told by, in this order.
TRACKED = ["title", "summary", "status", "chamber", "kind", "introduced_on", "last_action_on", "subjects", "sponsors"]
SUBSTITUTION = 0.6


def latest_version(versions: Column) -> Column:
    """The version published last (the first of equals); the last listed if none has a date."""
    places = F.transform(versions, lambda v, i: F.struct(v["published_on"].alias("day"), (-i).alias("place")))
    dated = F.filter(places, lambda p: p["day"].isNotNull())
    return F.when(F.size(dated) > 0, F.get(versions, -F.array_max(dated)["place"])).otherwise(F.get(versions, F.size(versions) - 1))


def _comparable(doc: Column, name: str) -> Column:
    if name == "subjects":
        return F.array_sort(F.transform(doc[name], F.lower))
    if name == "sponsors":
        return F.array_sort(F.transform(doc[name], lambda s: F.concat(s["role"], F.lit(":"), F.lower(s["name"]))))
    return doc[name]


def changed_fields(before: Column, after: Column) -> Column:
    """Names of the tracked fields that differ; order and case of lists do not count."""
    same = lambda f: _comparable(before, f).eqNullSafe(_comparable(after, f))
    return F.array_compact(F.array(*[F.when(~same(f), F.lit(f)) for f in TRACKED]))


def new_actions(before: Column, after: Column) -> Column:
    """Actions whose (date, wording) the earlier docket lacks; repeated ones count each."""
    key = lambda a: F.struct(a["occurred_on"].alias("d"), F.lower(a["description"]).alias("t"))
    known = F.transform(before, key)
    return F.size(F.filter(after, lambda a: ~F.array_contains(known, key(a))))


def diff_documents(current: DataFrame, previous: DataFrame, threshold: float = SUBSTITUTION) -> DataFrame:
    """document_id, kind, fields, previous_status, current_status, similarity, new_actions, notes,
    notable for each current document; both sides hold the tracked fields, actions and versions
    (label, text, published_on, semantic_hash).

    Texts are compared only where they differ; the rest of a row needs no Python.
    """
    from ..functions.udfs import text_similarity

    side = lambda df, name: df.select("document_id", F.struct(*[c for c in df.columns if c != "document_id"]).alias(name))
    d = side(current, "c").join(side(previous, "p"), "document_id", "left")
    c, p = F.col("c"), F.col("p")
    d = d.withColumn("cv", latest_version(c["versions"])).withColumn("pv", latest_version(p["versions"]))
    old, new = F.coalesce(F.col("pv.text"), F.lit("")), F.coalesce(F.col("cv.text"), F.lit(""))
    some = p.isNotNull() & (F.col("cv").isNotNull() | F.col("pv").isNotNull())
    differ = some & (old != new)
    d = d.withColumn("similarity", F.when(differ, text_similarity(F.when(differ, old), F.when(differ, new))).when(some, F.lit(1.0)))
    both = F.col("cv").isNotNull() & F.col("pv").isNotNull()
    text = F.when(both, F.col("cv.semantic_hash") != F.col("pv.semantic_hash")).otherwise(F.col("cv").isNotNull() != F.col("pv").isNotNull())
    d = d.withColumn("fields", F.when(p.isNotNull(), changed_fields(p, c)).otherwise(F.array().cast("array<string>")))
    d = d.withColumn("new_actions", F.when(p.isNotNull(), new_actions(p["actions"], c["actions"])).otherwise(F.size(c["actions"])))
    kind = change_kind(p.isNotNull(), p["status"], c["status"], text, F.coalesce("similarity", F.lit(1.0)), (F.size("fields") > 0) | (F.col("new_actions") > 0), threshold)
    d = d.withColumn("kind", kind)
    note = F.when(F.col("kind") == "superseded", "text similarity below substitution threshold").when((F.col("kind") == "status_regressed") & p["status"].isin(TERMINAL), "moved out of a terminal status")
    return d.select("document_id", "kind", "fields", p["status"].alias("previous_status"), c["status"].alias("current_status"), "similarity", "new_actions", F.array_compact(F.array(note)).alias("notes"), (~F.col("kind").isin("unchanged", "metadata_only")).alias("notable"))
