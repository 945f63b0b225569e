"""Merging of whole observations of a document, nested lists included.

Lists are merged row by row before they are put together again, so partial sums keep an id
that was observed very often small: a task holds distinct actions, versions and sponsors of a
document, never its observations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import merge_sponsors

#: Value of a scalar that says nothing.
_BLANK = {"kind": "unknown", "chamber": "unknown", "status": "unknown"}
_SCALARS = ["jurisdiction", "session", "identifier", "citation", "title", "summary", "kind", "chamber", "status", "url"]


def completeness(versions: str = "versions", actions: str = "actions", sponsors: str = "sponsors", subjects: str = "subjects") -> Column:
    """How much an observation knows; structs compare field by field."""
    counts = [F.coalesce(F.size(c), F.lit(0)).alias(c) for c in (versions, actions, sponsors, subjects)]
    return F.struct(*counts, (F.coalesce("summary", F.lit("")) != "").cast("int").alias("has_summary"), F.length(F.coalesce("title", F.lit(""))).alias("title_length"))


def merge_documents(docs: DataFrame) -> DataFrame:
    """One document for each document_id, from canonical documents with ``ord`` (arrival).

    The most complete observation leads, the earliest of equals; its blanks are filled from
    the next ones in that order. Of equal actions the first that knows most of chamber and
    committee stays, of equal versions the first, sponsors are merged by name, and subjects
    are united. Order is by completeness of the single observations; it isn't taken again
    after each merge.
    """
    score = F.struct(completeness().alias("c"), (-F.col("ord")).alias("o"))
    d = docs.withColumn("_s", score)
    pick = lambda c: F.max_by(c, F.when(F.coalesce(F.col(c), F.lit("")).isin("", _BLANK.get(c, "")) == F.lit(False), F.col("_s")))
    flat = d.groupBy("document_id").agg(*[F.coalesce(pick(c), F.lit(_BLANK.get(c, "")) if c != "url" else F.lit(None).cast("string")).alias(c) for c in _SCALARS], F.max_by("introduced_on", F.when(F.col("introduced_on").isNotNull(), F.col("_s"))).alias("_introduced"), F.max_by("last_action_on", F.when(F.col("last_action_on").isNotNull(), F.col("_s"))).alias("_last"), F.count("*").alias("n_merged"))

    a = d.select("document_id", "_s", F.explode("actions").alias("a"))
    known = (F.col("a.chamber") != "unknown").cast("int") + F.col("a.committee").isNotNull().cast("int")
    a = a.groupBy("document_id", F.col("a.occurred_on").alias("day"), F.lower("a.description").alias("said")).agg(F.max_by("a", F.struct(known.alias("k"), F.col("_s").alias("s"))).alias("a"))
    a = a.groupBy("document_id").agg(F.array_sort(F.collect_list("a")).alias("actions"), F.min("day").alias("_first_day"), F.max("day").alias("_last_day"))

    v = d.select("document_id", "_s", F.posexplode("versions").alias("place", "v"))
    v = v.groupBy("document_id", F.col("v.semantic_hash").alias("h")).agg(F.max(F.struct("_s", (-F.col("place")).alias("p"), "v")).alias("m"))
    v = v.groupBy("document_id").agg(F.transform(F.sort_array(F.collect_list("m"), asc=False), lambda m: m["v"]).alias("versions"))

    # places follow the order of observations: the better the score the smaller the place
    s = d.select("document_id", "_s", F.posexplode("sponsors").alias("place", "sponsor"))
    c = F.col("_s.c")
    place = F.struct(*[(-c[f]).alias(f) for f in ("versions", "actions", "sponsors", "subjects", "has_summary", "title_length")], (-F.col("_s.o")).alias("o"), F.col("place").alias("p"))
    s = merge_sponsors(s.select("document_id", "sponsor", place.alias("ord")), "document_id")
    s = s.groupBy("document_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "sponsor"))), lambda m: m["sponsor"]).alias("sponsors"))

    t = d.select("document_id", F.explode("subjects").alias("t")).groupBy("document_id").agg(F.array_sort(F.collect_set("t")).alias("subjects"))

    out = flat
    for part in (a, v, s, t):
        out = out.join(part, "document_id", "left")
    types = dict(docs.dtypes)
    lists = [F.coalesce(c, F.array().cast(types[c])).alias(c) for c in ("actions", "versions", "sponsors", "subjects")]
    return out.select("document_id", *_SCALARS, F.least("_introduced", "_first_day").alias("introduced_on"), F.coalesce("_last_day", "_last").alias("last_action_on"), *lists, "n_merged")
