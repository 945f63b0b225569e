"""Quality rules whose cutoffs carry a guarantee on false rejections. DataFrame functions only.

Base counts come from whole texts. Each rule rejects a document when its measure lies over a
cutoff; the cutoff of a rule in a stratum is the strictest one of the grid for which labelled
good documents prove, by the exact binomial test, that at most ``epsilon / number of rules``
of the good documents there are rejected. Cutoffs are tested from the loosest on and the
search ends at the first that fails (fixed-sequence testing), and the level is divided by the
number of (rule, stratum) pairs (Bonferroni), so all guarantees hold together with
probability 1 - delta.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import lgamma, log, pi

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept_table, table, words

#: Rule name -> measure in thousandths, as SQL over the base counts.
RULES = {
    "symbols": "cast(floor(1000.0 * n_symbols / word_chars) as bigint)",
    "repeats": "cast(floor(1000.0 * n_repeat_words / n_words) as bigint)",
    "long_words": "cast(floor(1000.0 * word_chars / n_words) as bigint)",
    "dup_lines": "cast(floor(1000.0 * n_dup_lines / n_lines) as bigint)",
}
GRIDS = {
    "symbols": [10, 20, 40, 60, 80, 100, 150, 200, 300],
    "repeats": [20, 40, 60, 80, 100, 120, 140, 160, 180],
    "long_words": [6000, 6500, 7000, 7500, 8000, 8500, 9000, 10000, 12000],
    "dup_lines": [50, 100, 150, 200, 250, 300, 400, 500, 700],
}


@dataclass(frozen=True)
class Risk:
    """epsilon: share of good documents that all rules together may reject; delta: chance
    that any guarantee fails; stratum: the column whose values get cutoffs of their own."""

    epsilon: float = 0.02
    delta: float = 0.05
    stratum: str = "lang"
    grids: dict[str, list[int]] = field(default_factory=lambda: dict(GRIDS))


def _repeat_words(w: Column) -> Column:
    """Words in 5-word windows that occur twice or more, from an array of words.

    Windows are sorted with their places, so equal ones stand side by side: n log n steps
    whatever the text."""
    n = F.size(w)
    places = F.when(n >= 5, F.sequence(F.lit(0), n - 5)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(F.slice(w, i + 1, F.lit(5))))


def base_counts(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, the columns to keep, and the base counts of every document.

    Null and blank texts have no words and fail the base rule. Rows are judged one by one, so
    repeated rows and repeated or null ids get a row each; extra columns are ignored.
    """
    t = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.translate(x, " \t\x0b\f\r", "") != "")
    d = docs.select("doc_id", *keep, t.alias("_t"), words(F.col("text")).alias("_w"), lines.alias("_l"))
    d = d.select("doc_id", *keep, "_w", "_l", F.length(F.translate("_t", "\t\n\x0b\f\r ", "")).cast("long").alias("word_chars"), (F.length("_t") - F.length(F.translate("_t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"), _repeat_words(F.col("_w")).alias("_h"))
    s = F.sort_array(F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    repeated = F.when(F.size(F.array_distinct("_h")) < F.size("_h"), s)
    d = d.select("doc_id", *keep, F.size("_w").cast("long").alias("n_words"), "word_chars", "n_symbols", F.size("_l").cast("long").alias("n_lines"), (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"), repeated.alias("_s"))
    s = F.col("_s")
    same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
    at = F.sort_array(F.transform(F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"]))
    d = d.withColumn("_s", at)
    p = F.col("_s")
    cover = F.aggregate(F.transform(p, lambda x, j: F.least(F.lit(5), F.coalesce(F.get(p, j + 1) - x, F.lit(5)))), F.lit(0), lambda a, x: a + x)
    d = d.select("doc_id", *keep, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", F.coalesce(cover, F.lit(0)).cast("long").alias("n_repeat_words"))
    return d.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def _stirling_rest(m: Column) -> Column:
    """log(m!) less Stirling's formula (m + 1/2) log(m) - m + log(2 pi) / 2: exact values for
    small m, else the series."""
    small = [0.0, *[lgamma(i + 1) - (i + 0.5) * log(i) + i - 0.5 * log(2 * pi) for i in range(1, 16)]]
    x = m.cast("double")
    series = 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - 1 / (1680 * x**7)
    return F.when(m < 16, F.get(F.array(*map(F.lit, small)), m.cast("int"))).otherwise(series)


def _log_cdf(n: Column, k: Column, p: float) -> Column:
    """Log of P(X <= k), X binomial(n, p), summed from its largest term P(X = k) down.

    Only k below n p matters, where the terms fall from k on. They are summed over twelve
    standard deviations and more; what lies beyond is under 1e-30 of the sum, far below the
    resolution of a double, so the bound is the exact one for every k.
    """
    q = k / n
    kl = F.when(k > 0, q * F.log(q / p)).otherwise(F.lit(0.0)) + (1 - q) * F.log((1 - q) / (1 - p))
    least = F.when(k > 0, _stirling_rest(n) - _stirling_rest(k) - _stirling_rest(n - k) - n * kl + 0.5 * F.log(n / (2 * pi * k * (n - k)))).otherwise(n * log(1 - p))
    reach = F.least(k, F.ceil(12 * F.sqrt(n * p * (1 - p))).cast("long") + 100)
    start = F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s"))

    def step(a: Column, j: Column) -> Column:
        t = a["t"] * ((k - j + 1) * (1 - p) / ((n - k + j) * p))
        return F.struct(t.alias("t"), (a["s"] + t).alias("s"))

    terms = F.when(reach >= 1, F.sequence(F.lit(1).cast("long"), reach)).otherwise(F.array().cast("array<bigint>"))
    return F.when(q >= p, F.lit(0.0)).otherwise(least + F.log(F.aggregate(terms, start, step, lambda a: a["s"])))


def measures(counts: DataFrame) -> DataFrame:
    """One row for each document and rule, for those that pass the base rule."""
    passed = counts.where(~F.col("base_failed"))
    return passed.select("*", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.expr(e).alias("measure")) for r, e in RULES.items()])).alias("_m")).select("*", "_m.rule", "_m.measure").drop("_m")


def cutoffs(counts: DataFrame, labels: DataFrame, risk: Risk) -> DataFrame:
    """stratum, rule, cutoff: the certified cutoffs; pairs without any certified one are absent."""
    good = labels.where(F.col("quality") == 1).select("doc_id").distinct()
    held = measures(counts.select("doc_id", F.coalesce(F.col(risk.stratum).cast("string"), F.lit("(none)")).alias("stratum"), "base_failed", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words").join(good, "doc_id", "left_semi"))
    pairs = [F.when(F.col("rule") == r, F.array(*[F.lit(c).cast("long") for c in sorted(g, reverse=True)])) for r, g in risk.grids.items()]
    # counts per cutoff stay small rows: each task sums its own before the shuffle
    hits = held.groupBy("stratum", "rule").agg(F.count("*").alias("n"), *[F.sum(F.when(F.col("measure") > F.coalesce(*[F.get(p, F.lit(i)) for p in pairs]), 1).otherwise(0)).alias(f"k{i}") for i in range(max(map(len, risk.grids.values())))])
    level = F.log(F.lit(risk.delta) / (len(RULES) * hits.agg(F.countDistinct("stratum")).first()[0] if not hits.isEmpty() else F.lit(risk.delta)))
    steps = F.posexplode(F.array(*[c for c in hits.columns if c.startswith("k")]))
    rows = hits.select("stratum", "rule", "n", steps.alias("i", "k")).withColumn("cutoff", F.coalesce(*[F.get(p, F.col("i")) for p in pairs])).where("cutoff is not null")
    rows = rows.where(_log_cdf(F.col("n"), F.col("k"), risk.epsilon / len(RULES)) <= level)
    return rows.groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"))


def verdicts(counts: DataFrame, labels: DataFrame, risk: Risk | None = None) -> DataFrame:
    """The counts with ``kept``: false if the base rule or any certified cutoff rejects.

    A null stratum is a stratum of its own. Without labels nothing is certified and only the
    base rule rejects. Repeated label rows count once; an id labelled both ways is good.
    """
    risk = risk or Risk()
    chosen = kept_table(cutoffs(counts, labels, risk), "cutoffs").groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"_c_{r}") for r in RULES])
    joined = counts.withColumn("_stratum", F.coalesce(F.col(risk.stratum).cast("string"), F.lit("(none)"))).join(chosen.withColumnRenamed("stratum", "_stratum"), "_stratum", "left")
    rejected = F.lit(False)
    for r, e in RULES.items():
        rejected = rejected | F.coalesce(F.when(~F.col("base_failed"), F.expr(e)) > F.col(f"_c_{r}"), F.lit(False))
    return joined.withColumn("kept", ~F.col("base_failed") & ~rejected).drop("_stratum", *[f"_c_{r}" for r in RULES])


def quality_rules(docs: DataFrame, labels: DataFrame, risk: Risk | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The counts and verdict of every document, with the columns to keep."""
    risk = risk or Risk()
    return verdicts(kept_table(base_counts(docs, risk.stratum, *keep), "counts"), labels, risk)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql() -> str:
    rules = "\n  union all ".join(f"select doc_id, stratum, '{r}' as rule, {e.replace('cast(floor(', 'cast(floor(')} as measure from base where not base_failed" for r, e in RULES.items())
    grid = ", ".join(f"('{r}', {c})" for r, g in GRIDS.items() for c in g)
    p = Risk().epsilon / len(RULES)
    return rf"""
with t as (select doc_id, lang, coalesce(text, '') as t from documents),
w as (select doc_id, lang, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from t),
g as (select doc_id, unnest(range(1, len(w) - 3)) as i, w from w where len(w) >= 5),
r as (select doc_id, i, count(*) over (partition by doc_id, array_to_string(w[i:i+4], ' ')) as c from g),
rw as (select doc_id, count(distinct j) as n_repeat_words from (select doc_id, unnest(range(i, i + 5)) as j from r where c > 1) group by doc_id),
counts as (select w.doc_id, coalesce(lang, '(none)') as stratum, len(w)::bigint as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
   length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols, len(l)::bigint as n_lines, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words
   from w left join rw using (doc_id)),
base as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from counts),
m as ({rules}),
held as (select * from m where doc_id in (select doc_id from labels where quality = 1)),
grid(rule, cutoff) as (values {grid}),
hits as (select stratum, rule, cutoff, count(*) as n, count(*) filter (where measure > cutoff) as k from held join grid using (rule) group by all),
tested as (select stratum, rule, cutoff, (select sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({p}) + (n - j) * ln(1 - {p}))) from (select unnest(range(0, k + 1)) as j)) as cdf from hits where k < {p} * n),
chosen as (select stratum, rule, min(cutoff) as cutoff from tested where cdf <= {Risk().delta} / ({len(RULES)} * (select count(distinct stratum) from held)) group by all),
bad as (select distinct m.doc_id from m join chosen using (stratum, rule) where measure > cutoff)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and doc_id not in (select doc_id from bad) as kept from base"""


SQL = _sql()
