"""Loose scraped records to canonical documents: one projection, no shuffle.

Records are rows of FIXTURES.md, section 1: all columns may be null, none may be missing.
Text is expected in NFKC; ``functions.udfs.nfkc`` brings other text there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import docket, ids, names, text

# Letters of a designator that tell the chamber, or that it is a resolution.
LOWER = ["H", "A", "AB", "HB", "HR", "HJR", "HCR", "HF"]
UPPER = ["S", "SB", "SR", "SJR", "SCR", "SF"]
RESOLUTIONS = ["HR", "SR", "HJR", "SJR", "HCR", "SCR", "ACR"]
SUMMARY_LIMIT = 2000


def infer_chamber(identifier: Column) -> Column:
    """Chamber by the longest known start of the letters, three at most; else unknown."""
    letters = F.regexp_replace(F.upper(F.coalesce(identifier, F.lit(""))), r"\P{L}+", "")
    at = lambda n: F.substring(letters, 1, n)
    found = [F.when(at(n).isin(LOWER), "lower").when(at(n).isin(UPPER), "upper") for n in (3, 2, 1)]
    return F.coalesce(*found, F.lit("unknown"))


def infer_kind(identifier: Column, declared: Column) -> Column:
    letters = F.regexp_replace(F.upper(F.coalesce(identifier, F.lit(""))), r"\P{L}+", "")
    guess = F.when(F.substring(letters, 1, 3).isin(RESOLUTIONS) | F.substring(letters, 1, 2).isin(RESOLUTIONS), "resolution").otherwise("bill")
    return F.coalesce(F.nullif(F.lower(F.trim(declared)), F.lit("")), guess)


def normalise_actions(actions: Column) -> Column:
    """Dated actions with a description, in docket order; others are dropped."""

    def one(a: Column, i: Column) -> Column:
        said = names.clean_line(a["description"])
        chamber = F.coalesce(F.nullif(F.lower(F.trim(a["chamber"])), F.lit("")), F.lit("unknown"))
        place = F.coalesce(F.nullif(a["sequence"], F.lit(0)), i)
        day = text.parse_date(a["date"])
        return names.let(F.struct(said.alias("s"), day.alias("d")), lambda x: F.when((x["s"] != "") & x["d"].isNotNull(), F.struct(x["d"].alias("occurred_on"), place.alias("sequence"), x["s"].alias("description"), docket.classify_action(x["s"]).alias("kind"), chamber.alias("chamber"), F.nullif(names.clean_line(a["committee"]), F.lit("")).alias("committee"), docket.status_from_action(x["s"], chamber).alias("resulting_status"))))

    return F.array_sort(F.filter(F.transform(F.coalesce(actions, F.array().cast("array<struct<date:string,description:string,chamber:string,committee:string,sequence:int>>")), one), lambda a: a.isNotNull()))


def normalise_versions(versions: Column) -> Column:
    """Versions with a text: dated ones by (date, place), then the others in their order."""

    def one(v: Column, i: Column) -> Column:
        day = text.parse_date(v["published_on"])
        label = F.coalesce(F.nullif(v["label"], F.lit("")), F.concat(F.lit("version "), (i + 1).cast("string")))
        return F.when(F.trim(v["text"]) != "", F.struct(day.isNull().alias("undated"), day.alias("published_on"), i.alias("place"), label.alias("label"), F.trim(v["text"]).alias("text"), ids.semantic_digest(v["text"]).alias("semantic_hash")))

    built = F.array_sort(F.filter(F.transform(F.coalesce(versions, F.array().cast("array<struct<label:string,text:string,published_on:string>>")), one), lambda v: v.isNotNull()))
    return F.transform(built, lambda v: F.struct(v["label"].alias("label"), v["text"].alias("text"), v["published_on"].alias("published_on"), v["semantic_hash"].alias("semantic_hash")))


def docket_status(actions: Column, fallback: Column) -> Column:
    """Status of the latest implying action by (date, sequence, rank), within a row."""
    implied = F.filter(actions, lambda a: a["resulting_status"].isNotNull())
    order = F.transform(implied, lambda a: F.struct(a["occurred_on"], a["sequence"], docket.status_rank(a["resulting_status"]), a["description"], a["resulting_status"].alias("status")))
    return F.coalesce(F.array_max(order)["status"], fallback)


def normalise(records: DataFrame, jurisdiction: Column, session: Column) -> tuple[DataFrame, DataFrame]:
    """(documents, rejected): canonical documents, and the records without an identifier.

    The docket decides the status; the declared one holds where the docket implies none.
    An introduction after the last action is pulled back to it.
    """
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    d = records.withColumn("identifier", names.clean_line(F.coalesce(blank(F.col("identifier")), blank(F.col("bill_number")))))
    rejected = d.where("identifier = ''").select("title", F.coalesce("url", "source_url").alias("url"), F.lit("no identifier").alias("error"))
    d = d.where("identifier <> ''")
    declared = F.coalesce(F.nullif(F.lower(F.trim("chamber")), F.lit("unknown")), infer_chamber(F.col("identifier")))
    d = d.withColumns({"jurisdiction": jurisdiction, "session": session, "chamber": F.when(declared == "", infer_chamber(F.col("identifier"))).otherwise(declared), "actions": normalise_actions(F.col("actions"))})
    days = F.transform("actions", lambda a: a["occurred_on"])
    d = d.withColumns({"status": docket_status(F.col("actions"), F.coalesce(blank(F.col("status")), F.lit("unknown"))), "_first": F.coalesce(text.parse_date(F.coalesce(blank(F.col("introduced_on")), blank(F.col("introduced")))), F.array_min(days)), "last_action_on": F.coalesce(F.array_max(days), text.parse_date(F.col("last_action_on")))})
    cite = ids.citation(F.col("jurisdiction"), F.col("session"), F.col("identifier"))
    kind = infer_kind(F.col("identifier"), F.col("kind"))
    no_text = F.array().cast("array<string>")
    mapped = F.filter(F.transform(F.coalesce("subjects", no_text), text.subject), lambda s: s.isNotNull())
    documents = d.select(
        ids.document_id(cite, kind).alias("document_id"), "jurisdiction", "session", "identifier", cite.alias("citation"),
        names.clean_line(F.col("title")).alias("title"), text.truncate(F.trim(F.coalesce("summary", F.lit(""))), SUMMARY_LIMIT).alias("summary"),
        kind.alias("kind"), "chamber", "status", F.least("_first", "last_action_on").alias("introduced_on"), "last_action_on",
        F.array_sort(F.array_distinct(mapped)).alias("subjects"), names.sponsors(F.coalesce("sponsors", no_text), F.col("chamber")).alias("sponsors"), "actions",
        normalise_versions(F.col("versions")).alias("versions"), text.canonical_url(F.coalesce(blank(F.col("url")), blank(F.col("source_url")))).alias("url"),
    )
    return documents, rejected
