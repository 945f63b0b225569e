"""Mixing sources to target weights by Poisson replication. DataFrame functions only.

Every document appears Poisson(rate of its source) times. The count is the inverse of the
Poisson distribution at a number that a hash of seed and document gives, so it is the same
in every run and needs no state; the copies are then put in a global random order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh, kept_table, table

SEED = 17
#: Default weights are document counts to this power: less than 1 lifts the smaller sources.
TEMPERATURE = 0.7


def _key(col: str = "source") -> Column:
    return F.coalesce(F.concat(F.lit("s:"), F.col(col).cast("string")), F.lit("none"))


def _uniform(*parts: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of an MD5."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def poisson_tables(rates: DataFrame) -> DataFrame:
    """``rates`` (_key, rate) with cdf: the values P(X <= k), k from 0, for X Poisson(rate).

    Terms are summed as logarithms, so large rates do not underflow. A table ends where the rest
    is below the resolution of a number of 52 bits, so its size follows the rate alone.
    """
    top = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 30).cast("int")
    rows = rates.where("rate > 0").select("_key", "rate", F.explode(F.sequence(F.lit(0), top)).alias("_k"))
    upto = Window.partitionBy("_key").orderBy("_k")
    term = F.exp(F.col("_k") * F.log("rate") - F.col("rate") - F.sum(F.log(F.greatest(F.col("_k"), F.lit(1)))).over(upto))
    rows = rows.withColumn("_term", term).withColumn("_cdf", F.sum("_term").over(upto)).where("_term > 1e-18 or _cdf < 0.5")
    cdf = F.transform(F.sort_array(F.collect_list(F.struct("_k", "_cdf"))), lambda x: x["_cdf"])
    return rows.groupBy("_key").agg(F.first("rate").alias("rate"), cdf.alias("cdf"))


def source_rates(docs: DataFrame, weights: DataFrame | None = None, size: float = 1.0) -> DataFrame:
    """_key, rate: the mean number of copies that brings each source to its share of
    ``size`` times the documents. weights: (source, weight); sources without one get none."""
    n = docs.groupBy(_key().alias("_key")).agg(F.count("*").alias("n"))
    if weights is None:
        n = n.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(TEMPERATURE)))
    else:
        w = weights.groupBy(_key().alias("_key")).agg(F.sum("weight").alias("weight"))
        n = n.join(w, "_key", "left").withColumn("weight", F.greatest(F.lit(0.0), F.coalesce(F.col("weight"), F.lit(0.0))))
    n = kept_table(n, "sources")
    total = n.agg(F.sum("weight").alias("w"), F.sum("n").alias("n")).first()
    if not total["w"]:
        return n.select("_key", F.lit(0.0).alias("rate"))
    return n.select("_key", (F.lit(float(size)) * F.lit(total["n"]) * F.col("weight") / F.lit(total["w"]) / F.col("n")).alias("rate"))


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, size: float = 1.0, seed: int = SEED, shuffle: bool = True) -> DataFrame:
    """Columns of ``docs`` with copy (from 1) and shuffle_key, in global random order.

    A null source is a source of its own. Rows that agree in doc_id and text draw the same
    count. Null ids and texts take part; an empty table gives an empty one. Columns named
    copy or shuffle_key are replaced; all others stay, whatever their names.

    The shuffle keys are uniform, so equal ranges of them are equal shares: rows go straight to
    their range and are sorted there, without the second pass that sampling ranges would take.
    """
    # a table per source; read back from a file its size is known, so it is broadcast only while
    # it is under Spark's threshold
    tables = kept_table(poisson_tables(source_rates(docs, weights, size)), "rates")
    docs = docs.drop("copy", "shuffle_key")
    key, cdf, count = fresh(docs, "_key", "_cdf", "_count")
    u = _uniform(F.lit(seed), F.col("doc_id"), F.md5(F.coalesce(F.col("text"), F.lit(""))))
    d = docs.withColumn(key, _key()).join(tables.select(F.col("_key").alias(key), F.col("cdf").alias(cdf)), key)
    # the least k with P(X <= k) > u; u is taken once, not at each step
    start = F.struct(u.alias("u"), F.lit(0).alias("k"))
    k = F.aggregate(cdf, start, lambda a, c: F.struct(a["u"].alias("u"), (a["k"] + F.when(c <= a["u"], 1).otherwise(0)).alias("k")), lambda a: a["k"])
    d = d.withColumn(count, F.array_repeat(F.lit(0), k))
    d = d.select(*docs.columns, F.posexplode(count).alias(key, cdf))
    d = d.select(*docs.columns, (F.col(key) + 1).alias("copy"))
    name = F.concat_ws(":", F.lit(seed + 1), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("copy"))
    d = d.withColumn("shuffle_key", F.md5(name))
    if not shuffle:
        return d
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = F.conv(F.substring("shuffle_key", 1, 8), 16, 10).cast("long") * parts / F.lit(1 << 32)
    return d.repartitionById(parts, F.floor(share).cast("int")).sortWithinPartitions("shuffle_key")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "copy", "shuffle_key", F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("text_sha256"))


SQL = f"""
with n as (select coalesce('s:' || source, 'none') as key, count(*) as n, pow(count(*)::double, {TEMPERATURE}) as weight from documents group by 1),
rates as (select key, 1.0::double * (select sum(n) from n) * weight / (select sum(weight) from n) / n as rate from n),
cdf as (select key, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) over (partition by key order by k) as c from rates, (select unnest(range(0, 200)) as k)),
d as (select doc_id, source, coalesce('s:' || source, 'none') as key, coalesce(text, '') as t, coalesce(doc_id::varchar, 'null') as id from documents),
u as (select *, (('0x' || substr(md5('{SEED}:' || id || ':' || md5(t)), 1, 13))::bigint + 0.5) / {1 << 52}.0::double as u from d),
k as (select doc_id, source, id, t, (select count(*) from cdf where cdf.key = u.key and c <= u.u) as n from u),
copies as (select *, unnest(range(1, n + 1)) as copy from k)
select doc_id, source, copy::integer as copy, md5('{SEED + 1}:' || id || ':' || copy) as shuffle_key, sha256(t) as text_sha256 from copies"""
