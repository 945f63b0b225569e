"""Rows that a load writes: the document, its children and its change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ids

# Tables in the order of writing; children are replaced as whole sets.
TABLE_ORDER = ["documents", "document_versions", "document_actions", "document_sponsors", "document_subjects", "document_changes"]
REPLACED = ["document_actions", "document_sponsors", "document_subjects"]


def metadata_fingerprint(docs: DataFrame) -> DataFrame:
    """``docs`` with metadata_fingerprint, the digest of what makes a change of metadata only."""
    joined = lambda c, f: F.array_join(F.array_sort(F.transform(c, f)), "|")
    sponsors = joined("sponsors", lambda s: ids.collapse(F.concat(s["role"], F.lit(":"), s["name"])))
    return docs.withColumn("metadata_fingerprint", ids.field_digest(title=F.col("title"), summary=F.col("summary"), chamber=F.col("chamber"), kind=F.col("kind"), subjects=joined("subjects", ids.collapse), sponsors=sponsors, introduced_on=F.col("introduced_on")))


def upsert_tables(docs: DataFrame, changes: DataFrame | None = None) -> dict[str, DataFrame]:
    """The rows of each table, in the order of writing. An id that is missing fails the load."""
    docs = docs.withColumn("document_id", F.coalesce("document_id", F.raise_error(F.lit("document has no id"))))
    flat = ["document_id", "jurisdiction", "session", "identifier", "citation", "title", "summary", "kind", "chamber", "status", "introduced_on", "last_action_on", "metadata_fingerprint"]
    out = {
        "documents": metadata_fingerprint(docs).select(*flat),
        "document_versions": docs.select("document_id", F.inline("versions")).withColumn("length", F.length("text")),
        "document_actions": docs.select("document_id", F.inline("actions")).withColumn("description_hash", F.sha2(F.lower("description"), 256)),
        "document_sponsors": docs.select("document_id", F.posexplode("sponsors").alias("position", "s")).select("document_id", "position", "s.*"),
        "document_subjects": docs.select("document_id", F.explode("subjects").alias("subject")),
    }
    if changes is not None:
        out["document_changes"] = changes.where("kind <> 'unchanged'")
    return {t: out[t] for t in TABLE_ORDER if t in out}


def plan_summary(docs: DataFrame, changes: DataFrame | None = None) -> DataFrame:
    """tab, n_rows, n_replaced (documents whose stored children go first) of a load."""
    parts = []
    for place, (name, rows) in enumerate(upsert_tables(docs, changes).items()):
        n = F.countDistinct("document_id") if name in REPLACED else F.lit(0).cast("long")
        parts.append(rows.agg(F.count("*").alias("n_rows"), n.alias("n_replaced")).select(F.lit(place).alias("place"), F.lit(name).alias("tab"), "n_rows", "n_replaced"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
