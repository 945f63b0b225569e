"""Queries of payloads, the raw archive and publishing over the driver's tables, with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text
from .plans import publish
from .session import table
from .sources import portals, readers


def docket_blocks(spark: SparkSession, d: str) -> DataFrame:
    block = F.concat(F.lit("Actions\n"), F.date_format("o_orderdate", "MM/dd/yy"), F.lit("  Filed  as "), "o_orderpriority", F.lit("\n   and read\n\n 01/02/24\tSigned "), "o_orderstatus", F.lit("\n01/03/24\n"))
    o = table(spark, d, "orders").select("o_orderkey", F.inline(portals.docket_block(block)))
    return o.select("o_orderkey", "sequence", "date", "description")


def session_numbers(spark: SparkSession, d: str) -> DataFrame:
    y = F.year("o_orderdate")
    o = table(spark, d, "orders").groupBy(F.concat(y.cast("string"), F.lit("-"), (y + 1).cast("string")).alias("session")).agg(F.count("*").alias("n"))
    s = F.col("session")
    return o.select("session", "n", portals.session_number(s, portals.CONGRESS).alias("congress"), portals.texas_code(s).alias("texas"), portals.session_number(s, portals.ILLINOIS).alias("illinois"), portals.illinois_session_id(s).alias("illinois_id"), portals.session_number(s, portals.OHIO).alias("ohio"))


def api_records(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    who = F.array(F.struct(F.concat(F.lit(" Ann  "), "n_name").alias("name")))
    act = F.array(F.struct(F.lit("2024-01-01").alias("date"), F.lit("Filed").alias("description"), F.lit("House").alias("chamber")))
    item = F.struct(F.concat(F.when(F.col("n_nationkey") % 2 == 0, "SB ").otherwise("HB "), F.col("n_nationkey").cast("string")).alias("number"), F.col("n_name").alias("shortTitle"), who.alias("sponsors"), act.alias("actions"))
    page = F.when(F.col("n_nationkey") % 5 == 0, "{}").otherwise(F.to_json(F.struct(F.array(item).alias("items"))))
    items, errors = readers.api_items(n.select("n_nationkey", page.alias("body")), portals.API_ITEM)
    good = portals.api_records(items, "n_nationkey").select("n_nationkey", "identifier", "title", "chamber", F.array_join("sponsors", ",").alias("sponsors"), F.size("actions").alias("n_actions"))
    return good.unionByName(errors.select("error"), allowMissingColumns=True).fillna({"n_nationkey": -1, "n_actions": 0})


def xml_records(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("n_nationkey")
    person = lambda x: F.concat(F.lit("<item><fullName> "), F.lit(x), F.lit("</fullName></item>"))
    bill = F.concat(F.lit("<bill><type>"), F.when(k % 2 == 0, "s").otherwise("hr"), F.lit("</type><number>"), k.cast("string"), F.lit("</number><title>"), "n_name", F.lit("</title><sponsors>"), person("Al"), F.lit("</sponsors><cosponsors>"), person("Bo"), person("Cy"), F.lit("</cosponsors><actions><item><actionDate>2024-01-01</actionDate><text>Filed</text></item></actions></bill>"))
    doc = F.when(k % 6 == 0, "<manifest><file>1</file></manifest>").when(k % 7 == 0, "a checksum").when(k % 8 == 1, F.concat(F.lit('<?xml version="1.0"?><billStatus>'), bill, F.lit("</billStatus>"))).when(k % 8 == 2, "<bill><title>none</title></bill>").otherwise(bill)
    good, errors = portals.xml_records(table(spark, d, "nation").select("n_nationkey", doc.alias("payload")), "payload", "n_nationkey")
    good = good.select("n_nationkey", "identifier", "title", "chamber", F.array_join("sponsors", ",").alias("sponsors"), F.size("actions").alias("n_actions"))
    return good.unionByName(errors, allowMissingColumns=True).fillna({"n_actions": 0})


def archive_stats(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "pages").select("page_id", F.lit("ZZ").alias("jurisdiction"), F.lit(None).cast("timestamp").alias("fetched_at"), F.when(F.col("page_id") % 7 == 0, 404).otherwise(200).alias("status"), F.col("html").alias("body"))
    return readers.archive_stats(readers.archivable(p), readers.archive_keys(p.where("page_id % 3 = 0")))


def snapshots(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    row = lambda t, n: (F.col("o_orderkey").alias("document_id"), F.lit(t).alias("title"), F.lit(n).alias("ord"))
    batch = o.where("o_orderkey % 3 = 0").select(*row("first", 1)).union(o.where("o_orderkey % 3 = 0").select(*row("second", 2)))
    return publish.snapshot(o.where("o_orderkey % 2 = 0").select(*row("old", 0)), batch).select("document_id", "title")


_CELLS = [["Public Health -- Hospitals", " Weather "], ["K-12 Schools", "weather", "Weather", "weather"], ["Odd  thing", "Odd thing", "State income tax relief", ""]]


def subject_gaps(spark: SparkSession, d: str) -> DataFrame:
    cells = F.element_at(F.array(*[F.array(*map(F.lit, c)) for c in _CELLS]), (F.col("p_partkey") % len(_CELLS) + 1).cast("int"))
    p = table(spark, d, "part").select("p_partkey", text.subject_list(cells).alias("s"))
    return p.select("p_partkey", F.array_join("s.subjects", ",").alias("subjects"), F.array_join("s.unmapped", ",").alias("unmapped"))


QUERIES = {f.__name__: f for f in (docket_blocks, session_numbers, api_records, xml_records, archive_stats, snapshots, subject_gaps)}

SQL = {
    "docket_blocks": "select o_orderkey, 0::integer as sequence, strftime(o_orderdate, '%m/%d/%y') as date, 'Filed as ' || o_orderpriority || ' and read' as description from orders union all select o_orderkey, 1, '01/02/24', 'Signed ' || o_orderstatus || ' 01/03/24' from orders",
    "session_numbers": "with y as (select year(o_orderdate) as y, count(*) as n from orders group by 1) select y || '-' || (y + 1) as session, n, (floor((y - 1789) / 2) + 1)::integer as congress, (floor((y - 1846) / 2) + 1)::integer || 'R' as texas, (floor((y - 2023) / 2) + 103)::integer as illinois, (floor((y - 2023) / 2) + 88)::integer as illinois_id, (floor((y - 2023) / 2) + 135)::integer as ohio from y",
    "api_records": "with n as (select *, n_nationkey % 5 = 0 as bad, n_nationkey % 2 = 0 as up from nation) select case when not bad then n_nationkey else -1 end as n_nationkey, case when not bad then case when up then 'SB ' else 'HB ' end || n_nationkey end as identifier, case when not bad then n_name end as title, case when not bad then case when up then 'upper' else 'lower' end end as chamber, case when not bad then 'Ann ' || n_name end as sponsors, case when not bad then 1 else 0 end::integer as n_actions, case when bad then 'missing envelope' end as error from n",
    "xml_records": "with n as (select *, case when n_nationkey % 6 = 0 then 'no bill element' when n_nationkey % 7 = 0 then 'payload is not XML' when n_nationkey % 8 = 2 then 'no identifier' end as error, n_nationkey % 2 = 0 as up from nation) select n_nationkey, case when error is null then case when up then 'S' else 'HR' end || n_nationkey end as identifier, case when error is null then n_name end as title, case when error is null then case when up then 'upper' else 'lower' end end as chamber, case when error is null then 'Al,Bo,Cy' end as sponsors, case when error is null then 1 else 0 end::integer as n_actions, error from n",
    "archive_stats": "with p as (select html, page_id % 7 <> 0 as ok, page_id % 3 = 0 as old from pages), w as (select count(distinct html) as written from p where ok and html not in (select html from p where old)) select written, (select count(*) from p where ok) - written as skipped, (select count(*) from p where ok) as objects from w",
    "snapshots": "select o_orderkey as document_id, case when o_orderkey % 3 = 0 then 'second' else 'old' end as title from orders where o_orderkey % 2 = 0 or o_orderkey % 3 = 0",
    "subject_gaps": "select p_partkey, ['health', 'education', 'revenue'][p_partkey % 3 + 1] as subjects, ['Weather', 'weather,Weather', 'Odd thing'][p_partkey % 3 + 1] as unmapped from part",
}
