"""Benchmark decontamination by templates. DataFrame functions only.

Numbers, names and units become typed placeholders, so a question whose figures or names were
exchanged keeps its template. Template windows of the documents are hash-joined with those of
the benchmark at every place, and the values that stand in the placeholders must map one to
one along each alignment. A document is contaminated by an item when consistent windows cover
at least half of the item's windows. An item shorter than a window is one window of its own
length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, fresh, kept_table, table

WINDOW = 8
#: Words of a window that must not be placeholders.
LITERALS = 3
COVERAGE = 0.5
PUNCTUATION = ".,;:!?\"'()[]{}|«»„“”‘’…"
UNITS = "mm|cm|m|km|in|ft|yd|mi|mg|g|kg|lb|oz|ml|l|s|sec|min|h|hr|hrs|hours?|minutes?|seconds?|days?|weeks?|months?|years?|met(?:er|re)s?|kilomet(?:er|re)s?|miles?|grams?|kilograms?|pounds?|lit(?:er|re)s?|dollars?|euros?|cents?|usd|eur|percent"


def _plain(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), PUNCTUATION, "")


def _template(plain: Column) -> Column:
    t = F.regexp_replace(plain, r"(?<![^\x20\x09-\x0D])[-+$€£]?[0-9]+[%€]?(?![^\x20\x09-\x0D])", "<num>")
    t = F.regexp_replace(t, r"(?<![^\x20\x09-\x0D])\p{Lu}[^\x20\x09-\x0D]*", "<name>")
    return F.lower(F.regexp_replace(t, rf"(?i)(?<=<num>[\x20\x09-\x0D])(?:{UNITS})(?![^\x20\x09-\x0D])", "<unit>"))


def _split(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _starts(n: Column, size: Column) -> Column:
    return F.when(n >= size, F.sequence(F.lit(0), n - size)).otherwise(F.array().cast("array<int>"))


def _hashes(t: Column, size: int) -> Column:
    return F.transform(_starts(F.size(t), F.lit(size)), lambda i: F.xxhash64(F.slice(t, i + 1, F.lit(size))))


def _is_slot(w: Column) -> Column:
    return w.isin("<num>", "<name>", "<unit>")


def _item_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, i, size, h, slots (place in the window and value of each placeholder)."""
    d = benchmark.where("item_id is not null").select("item_id", "text").distinct()
    d = d.select("item_id", _split(_plain(F.col("text"))).alias("_r"), _split(_template(_plain(F.col("text")))).alias("_t"))
    d = d.withColumn("size", F.least(F.size("_t"), F.lit(WINDOW)))
    d = d.select("item_id", "_r", "_t", "size", F.explode(_starts(F.size("_t"), F.col("size"))).alias("i"))
    t, r = F.slice("_t", F.col("i") + 1, F.col("size")), F.slice("_r", F.col("i") + 1, F.col("size"))
    d = d.select("item_id", "i", "size", F.xxhash64(t).alias("h"), t.alias("_t"), r.alias("_r"))
    d = d.where(F.size(F.filter("_t", lambda w: ~_is_slot(w))) >= LITERALS)
    return d.select("item_id", "i", "size", "h", _marks(F.col("_t"), F.col("_r")).alias("slots"))


def _marks(t: Column, r: Column) -> Column:
    """(place, value) of each placeholder."""
    return F.filter(F.transform(t, lambda w, k: F.when(_is_slot(w), F.struct(k.alias("place"), F.get(r, k).alias("value")))), lambda x: x.isNotNull())


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """_row (a hash of doc_id and text), doc_id, item_id, n_windows, n_item_windows of the
    contaminated documents.

    Null texts match nothing, nor do items without a window of LITERALS words that are no
    placeholders. Items that agree are reported each. Rows with the same id and text give the same rows once; other rows
    with a repeated or null id are judged apart. Extra columns are ignored.
    """
    items = kept_table(_item_windows(benchmark), "items")
    sizes = items.groupBy("item_id").agg(F.countDistinct("i").alias("n_item_windows"))
    own = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("_row"))
    # at most WINDOW lengths, whatever the benchmark holds
    lengths = sorted(r["size"] for r in items.select("size").distinct().collect()) or [WINDOW]
    t = own.select("_row", _split(_template(_plain(F.col("text")))).alias("_t"))
    probes = t.select("_row", F.explode(F.concat(*[_hashes(F.col("_t"), n) for n in lengths])).alias("h"))
    found = kept_table(probes.join(items.select("h").distinct(), "h", "left_semi").select("_row").distinct(), "found")
    again = own.join(found, "_row", "left_semi")
    ids = again.select("doc_id", "_row").distinct()
    # hashes and placeholders of a text, never a text or its words beside each window
    again = again.select("_row", _split(_plain(F.col("text"))).alias("_r"), _split(_template(_plain(F.col("text")))).alias("_t"))
    again = kept_table(again.select("_row", F.array(*[F.struct(F.lit(n).alias("size"), _hashes(F.col("_t"), n).alias("hs")) for n in lengths]).alias("all"), _marks(F.col("_t"), F.col("_r")).alias("marks")), "templates")
    windows = again.select("_row", F.inline("all")).select("_row", "size", F.posexplode("hs").alias("at", "h"))
    pairs = kept_table(windows.join(items, ["size", "h"]).select("_row", "item_id", F.col("i").alias("j"), "at", "slots").withColumn("shift", F.col("at") - F.col("j")), "pairs")
    asked = pairs.select("_row", "item_id", "shift", "at", F.inline("slots")).select("_row", "item_id", "shift", (F.col("at") + F.col("place")).alias("place"), F.col("value").alias("b")).distinct()
    values = asked.join(again.select("_row", F.inline("marks")).distinct(), ["_row", "place"]).select("_row", "item_id", "shift", "b", "value")
    # one to one: no value of the item stands for two of the document, nor the other way round
    both = values.select("_row", "item_id", "shift", F.inline(F.array(F.struct(F.lit(0).alias("side"), F.col("b").alias("key"), F.col("value").alias("other")), F.struct(F.lit(1).alias("side"), F.col("value").alias("key"), F.col("b").alias("other")))))
    clashing = both.groupBy("_row", "item_id", "shift", "side", "key").agg((F.min("other") != F.max("other")).alias("clash")).where("clash").select("_row", "item_id", "shift").distinct()
    good = pairs.select("_row", "item_id", "shift", "j").join(clashing, ["_row", "item_id", "shift"], "left_anti").groupBy("_row", "item_id").agg(F.countDistinct("j").alias("n_windows"))
    hits = good.join(sizes, "item_id").where(F.col("n_windows") >= COVERAGE * F.col("n_item_windows"))
    return kept_table(hits.join(ids, "_row").select("_row", "doc_id", "item_id", "n_windows", "n_item_windows"), "leaks")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated documents."""
    (row,) = fresh(docs, "_row")
    bad = leaks(docs, benchmark).select(F.col("_row").alias(row)).distinct()
    return docs.withColumn(row, F.xxhash64("doc_id", "text")).join(bad, row, "left_anti").select(*docs.columns)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("_row")


_UNIT = f"^(?:{UNITS})$"
_WORD = rf"""case when regexp_matches(x, '^[-+$€£]?[0-9]+[%€]?$') then '<num>' when regexp_matches(x, '^\p{{Lu}}') then '<name>'
  when i > 1 and regexp_matches(r[i - 1], '^[-+$€£]?[0-9]+[%€]?$') and regexp_matches(lower(x), '{_UNIT}') then '<unit>' else lower(x) end"""


def _side(name: str, key: str) -> str:
    marks = PUNCTUATION.replace("'", "''")
    return rf"""
{name}_r as (select {key}, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{marks}', ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as r from (select distinct {key}, text from {name})),
{name}_t as (select {key}, r, list_transform(r, lambda x, i: {_WORD}) as t from {name}_r where len(r) >= {WINDOW}),
{name}_i as (select {key}, unnest(range(1, len(r) - {WINDOW - 2})) as i, r, t from {name}_t),
{name}_w as (select {key}, i, r[i:i+{WINDOW - 1}] as r, t[i:i+{WINDOW - 1}] as t, array_to_string(t[i:i+{WINDOW - 1}], ' ') as w from {name}_i
  where len(list_filter(t[i:i+{WINDOW - 1}], lambda x: x not in ('<num>', '<name>', '<unit>'))) >= {LITERALS})"""


SQL = rf"""
with {_side("benchmark", "item_id")},
{_side("documents", "doc_id")},
sizes as (select item_id, count(*) as n_item_windows from benchmark_w group by 1),
pairs as (select d.doc_id, b.item_id, b.i as j, d.i - b.i as shift, b.r as br, d.r as dr, b.t as t from documents_w d join benchmark_w b using (w)),
vals as (select doc_id, item_id, shift, unnest(br) as b, unnest(dr) as d, unnest(t) as t from pairs),
slots as (select * from vals where t in ('<num>', '<name>', '<unit>')),
clash as (select doc_id, item_id, shift from slots group by doc_id, item_id, shift, b having min(d) <> max(d)
  union select doc_id, item_id, shift from slots group by doc_id, item_id, shift, d having min(b) <> max(b)),
good as (select doc_id, item_id, count(distinct j) as n_windows from pairs anti join clash using (doc_id, item_id, shift) group by all)
select doc_id, item_id, n_windows, n_item_windows from good join sizes using (item_id) where n_windows >= {COVERAGE} * n_item_windows"""
