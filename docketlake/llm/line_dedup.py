"""Near-duplicate lines by a deletion-neighbourhood join. DataFrame functions only.

A line goes when an equal line, or one within one edit of it (characters inserted, deleted or
replaced) and at least 0.75 similar by length, stands earlier; the earliest stays. Lines are
judged on the input.

Two lines within one edit agree in the first or in the last half, so only lines that share a
half with a different line emit variants: the line with each one character left out. A
replacement at place i makes the variants without i equal; an insertion makes a variant of the
longer line equal to the shorter. Keys of variants are put together from hashes of blocks of the
line, so that all variants of a line cost as much as the line is long, not its square: blocks
before the deletion stand as they are, blocks after it are shifted by one character, and only
the block that loses the character is hashed anew. For each key the earliest line is the partner
of all others, so that a key shared by many lines costs as many rows, never pairs. The edit
distance of every line and partner is then verified on the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import kept_table, sieved, table

MAX_EDITS = 1
SIMILARITY = 0.75
#: Length of the longer line from which one edit leaves it SIMILARITY alike.
ONE_EDIT = int(MAX_EDITS / (1 - SIMILARITY))
BLOCK = 32


def _at(doc_id: str = "doc_id") -> Column:
    return F.struct(doc_id, "_th", "line_no")


def _exploded(docs: DataFrame) -> DataFrame:
    """doc_id, _th (hash of the text), line_no, line, and its two hashes, of lines with a word."""
    d = docs.select("doc_id", F.xxhash64("text").alias("_th"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line_no", "line"))
    d = d.where(F.btrim("line", F.lit(" \t\x0b\f\r")) != "")
    return d.select("doc_id", "_th", "line_no", "line", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(7), "line").alias("b"))


def _halves(line: Column) -> list[Column]:
    """Keys of the first and keys of the last half, cut for a shorter partner and for one that is
    no shorter; lines within one edit share one of them."""
    n = F.length(line)
    h = lambda lo: F.floor(lo / 2).cast("int")
    first = [F.xxhash64(F.lit(0), h(lo), F.substring(line, F.lit(1), h(lo))) for lo in (n - 1, n)]
    last = [F.xxhash64(F.lit(1), lo - h(lo), F.right(line, lo - h(lo))) for lo in (n - 1, n)]
    none = F.array().cast("array<bigint>")
    return [F.when(n >= ONE_EDIT - 1, F.array_distinct(F.array(*x))).otherwise(none) for x in (first, last)]


def _xor(hashes: Column, w) -> Column:
    return F.coalesce(F.bit_xor(hashes).over(w), F.lit(0))


def _blocks(own: DataFrame) -> DataFrame:
    """a, b, n, lo and hi (places from lo on and before hi may be edited), q (number of a block),
    text of it, after (the character behind it), and the combined hashes: before (of the blocks before it), rest (of those after it, shifted), whole."""
    cut = F.regexp_extract_all("line", F.lit(rf"(?s).{{1,{BLOCK}}}"), 0)
    n = F.length("line")
    # a partner with the same first half is edited behind it, one with the same last half before
    lo = F.when(F.col("last"), F.lit(0)).otherwise(F.floor((n - 1) / 2).cast("int"))
    hi = F.when(F.col("first"), n).otherwise(n - F.ceil((n - 1) / 2).cast("int") + 1)
    d = own.select("a", "b", F.struct(n.alias("n"), lo.alias("lo"), hi.alias("hi")).alias("n"), cut.alias("_c"))
    # the character behind a block goes with it; the array of all blocks must not go with each
    ahead = F.transform("_c", lambda x, q: F.struct(x.alias("text"), F.coalesce(F.substring(F.get("_c", q + 1), 1, 1), F.lit("")).alias("after")))
    d = d.select("a", "b", "n", ahead.alias("_c")).select("a", "b", "n", F.posexplode("_c").alias("q", "_b")).select("a", "b", "n", "q", "_b.text", "_b.after")
    shifted = F.concat(F.expr("substring(text, 2)"), "after")
    d = d.select("*", F.xxhash64("q", "text").alias("_h"), F.when(shifted != "", F.xxhash64("q", shifted)).alias("_s"))
    w = Window.partitionBy("a", "b")
    upto = w.orderBy("q").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.select("*", _xor(F.col("_h"), upto).alias("_p"), _xor(F.col("_s"), upto).alias("_t"), _xor(F.col("_h"), w).alias("whole"), _xor(F.col("_s"), w).alias("_all"))
    return d.select("a", "b", "n.*", "q", "text", "after", F.col("_p").bitwiseXOR(F.col("_h")).alias("before"), F.col("_t").bitwiseXOR(F.col("_all")).alias("rest"), "whole")


def _variants(blocks: DataFrame) -> DataFrame:
    """a, b, key, role, place: role 0 for the line itself, 1 for a variant that may equal another
    line, 2 for one that may equal another line's without the same place."""

    def without(i: Column) -> Column:
        left = F.concat(F.substring(F.col("text"), F.lit(1), i), F.substring(F.col("text"), i + 2, F.lit(BLOCK)), F.col("after"))
        own = F.when(left != "", F.xxhash64("q", left)).otherwise(F.lit(0).cast("long"))
        return F.struct(i.alias("i"), F.col("before").bitwiseXOR(own).bitwiseXOR(F.col("rest")).alias("h"))

    lo = F.greatest(F.lit(0), F.col("lo") - F.col("q") * BLOCK)
    hi = F.least(F.length("text"), F.col("hi") - F.col("q") * BLOCK) - 1
    each = F.when((F.col("n") >= ONE_EDIT) & (lo <= hi), F.transform(F.sequence(lo, hi), without))
    d = blocks.select("a", "b", "n", "q", "lo", "whole", F.explode_outer(each).alias("c"))
    place = F.col("q") * BLOCK + F.col("c.i")
    own = F.struct(F.xxhash64("n", "whole").alias("key"), F.lit(0).alias("role"), F.lit(None).cast("int").alias("place"))
    gone = F.struct(F.xxhash64(F.col("n") - 1, "c.h").alias("key"), F.lit(1).alias("role"), place.alias("place"))
    swap = F.struct(F.xxhash64("n", place, "c.h").alias("key"), F.lit(2).alias("role"), place.alias("place"))
    first = (F.col("q") == 0) & F.coalesce(F.col("c.i") == lo, F.lit(True))
    rows = F.filter(F.array(F.when(first, own), F.when(F.col("c").isNotNull(), gone), F.when(F.col("c").isNotNull(), swap)), lambda x: x.isNotNull())
    return d.select("a", "b", F.inline(rows))


def _one_edit() -> Column:
    """Whether line and other are one edit apart, given the place of the edit: the texts agree
    before it and after it. Takes as long as the lines, where a table of distances would take
    their product."""
    one, two = F.when(F.col("role") == 0, F.col("other")).otherwise(F.col("line")), F.when(F.col("role") == 0, F.col("line")).otherwise(F.col("other"))
    skip = F.when(F.col("role") == 2, 2).otherwise(1)
    rest = F.length("line") + F.length("other")  # more than there is
    before = F.substring(one, F.lit(1), F.col("place")) == F.substring(two, F.lit(1), F.col("place"))
    after = F.substring(one, F.col("place") + 2, rest) == F.substring(two, F.col("place") + skip, rest)
    return (F.col("line") != F.col("other")) & before & after


def near_lines(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """a, b, near (place of the earliest line one edit away)."""
    side = lambda name: F.transform(name, lambda x: F.struct(x.alias("key"), F.lit(name == "first").alias("first")))
    halves = lines.select("a", F.inline(F.concat(side("first"), side("last"))))
    shared = kept_table(halves.groupBy("key").agg(F.min("a").alias("_lo"), F.max("a").alias("_hi")).where("_lo <> _hi").select("key"), "halves")
    flagged = halves.join(shared, "key", "left_semi").groupBy("a").agg(F.bool_or("first").alias("first"), F.bool_or(~F.col("first")).alias("last"))
    flagged = kept_table(flagged, "flagged")
    texts = sieved(_exploded(docs), "a", flagged.select(F.col("a").alias("key"))).join(flagged, "a")
    own = texts.groupBy("a", "b", "first", "last").agg(F.min(_at()).alias("at"), F.first("line").alias("line"))
    own = kept_table(own, "lines")
    blocks = kept_table(_blocks(own), "blocks")
    keys = _variants(blocks).groupBy("key").agg(F.min("a").alias("_lo"), F.max("a").alias("_hi")).where("_lo <> _hi").select("key")
    keys = kept_table(keys, "variants")
    rows = kept_table(sieved(_variants(blocks), "key", keys).join(keys, "key", "left_semi"), "shared")
    who = F.struct("at", "a", "b", "place")
    first = rows.join(own.select("a", "b", "at"), ["a", "b"]).groupBy("key").agg(*[F.min(F.when(F.col("role") == r, who)).alias(f"m{r}") for r in (0, 1, 2)])
    first = kept_table(first, "earliest")
    found = rows.join(first, "key").withColumn("m", F.when(F.col("role") == 0, F.col("m1")).when(F.col("role") == 1, F.col("m0")).otherwise(F.col("m2")))
    found = found.where("m is not null and (a <> m.a or b <> m.b)").groupBy("a", "b", "role", "m.at", F.col("m.a").alias("ma"), F.col("m.b").alias("mb")).agg(F.min(F.coalesce("place", "m.place")).alias("place"))
    texts = own.select("a", "b", "line")
    found = found.join(texts, ["a", "b"]).join(texts.select(F.col("a").alias("ma"), F.col("b").alias("mb"), F.col("line").alias("other")), ["ma", "mb"])
    found = found.where(_one_edit()).where(F.greatest(F.length("line"), F.length("other")) >= ONE_EDIT)
    return found.groupBy("a", "b").agg(F.min("at").alias("near"))


def dropped_lines(docs: DataFrame) -> DataFrame:
    """doc_id, line_no (from 0), kept_doc_id, kept_line_no, edits of every line that goes.

    Order is (doc_id, hash of the text, line_no), null ids first; rows that agree in id and
    text are one document listed twice and give their rows twice. Lines without a word stay
    and keep none. Null and empty texts have no lines; extra columns are ignored. ``docs`` is
    read twice and must give the same rows each time.
    """
    docs = docs.select("doc_id", "text")
    lines = kept_table(_exploded(docs).select("doc_id", "_th", "line_no", "a", "b", *[x.alias(name) for x, name in zip(_halves(F.col("line")), ("first", "last"), strict=True)]), "places")
    near = kept_table(near_lines(docs, lines), "near")
    own = lines.select("doc_id", "_th", "line_no", "a", "b")
    # classes of several lines, by counts alone; their first and last places come after
    several = kept_table(own.groupBy("a", "b").count().where("count > 1").select("a", "b").unionByName(near.select("a", "b")).distinct(), "several")
    own = kept_table(sieved(own, "a", several.select(F.col("a").alias("key"))).join(several, ["a", "b"], "left_semi"), "repeated")
    classes = own.groupBy("a", "b").agg(F.min(_at()).alias("first"), F.max(_at()).alias("last"))
    classes = classes.join(near, ["a", "b"], "left").where("first <> last or near < first")
    target = classes.select("a", "b", F.least("first", F.coalesce("near", "first")).alias("kept"), F.when(F.col("near") < F.col("first"), 1).otherwise(0).alias("edits"))
    # read back as a table, so that the join below can split a line that is everywhere
    target = kept_table(target, "targets")
    out = own.select("a", "b", _at().alias("at")).join(target, ["a", "b"]).where("at > kept")
    return out.select("at.doc_id", "at.line_no", F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.line_no").alias("kept_line_no"), "edits")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dropped_lines(table(spark, sf_dir, "documents"))
