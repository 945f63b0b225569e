"""Queries of changes, loads, crawls and state over the driver's tables, with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import names, text
from .operators import changes, crawl, documents, upsert
from .plans import state
from .session import table

_WORDS = "a b c d e f g h i j"


def _pick(key: str, of: dict[int, object], other: object) -> Column:
    r = F.col("o_orderkey") % 10
    c = F.when(F.lit(False), F.lit(other))
    for k, v in of.items():
        c = c.when(r == k, F.lit(v))
    return c.otherwise(F.lit(other)).alias(key)


def _version(words: Column) -> Column:
    return F.struct(F.lit("v").alias("label"), words.alias("text"), F.lit("2024-01-05").cast("date").alias("published_on"), F.sha2(words, 256).alias("semantic_hash"))


def _documents(spark: SparkSession, d: str, later: bool) -> DataFrame:
    """Orders as documents, before and after: the last digit of the key says what changed."""
    o = table(spark, d, "orders")
    status = {2: "withdrawn", 3: "signed", 4: "introduced"} if later else {3: "enrolled", 4: "enacted"}
    words = {5: "a b c d e f g h i k", 6: "x y"} if later else {}
    t, day = _pick("title", {} if later else {1: "old"}, "A title"), F.to_date("o_orderdate").alias("introduced_on")
    act = lambda s: F.struct(F.to_date("o_orderdate").alias("occurred_on"), F.lit(s).alias("description"), F.lit("lower").alias("chamber"))
    who = lambda role, name: F.struct(F.lit(role).alias("role"), F.lit(name).alias("name"))
    r = F.col("o_orderkey") % 10
    actions = F.when((r == 8) & F.lit(later), F.array(act("Filed"), act("Read"))).otherwise(F.array(act("filed")))
    sponsors = F.when((r == 9) & F.lit(later), F.array(who("primary", "BO"), who("primary", "Al"))).otherwise(F.array(who("primary", "Al"), who("primary", "Bo")))
    v = _version(_pick("w", words, _WORDS))
    versions = F.when((r == 7) & F.lit(not later), F.slice(F.array(v), 1, 0)).otherwise(F.array(v))
    rows = o if later else o.where("o_orderkey % 6 <> 0")
    return rows.select(F.col("o_orderkey").alias("document_id"), t, F.lit("s").alias("summary"), _pick("status", status, "introduced"), F.lit("lower").alias("chamber"), F.lit("bill").alias("kind"), day, day.alias("last_action_on"), F.array("o_orderpriority").alias("subjects"), sponsors.alias("sponsors"), actions.alias("actions"), versions.alias("versions"))


def document_diffs(spark: SparkSession, d: str) -> DataFrame:
    out = changes.diff_documents(_documents(spark, d, True), _documents(spark, d, False))
    return out.select("document_id", "kind", F.array_join("fields", ",").alias("fields"), "similarity", "new_actions", "notable")


def upsert_plan(spark: SparkSession, d: str) -> DataFrame:
    docs = _documents(spark, d, True).withColumns({"jurisdiction": F.lit("zz"), "session": F.lit("2024"), "identifier": F.lit("HB1"), "citation": F.lit("zz")})
    return upsert.plan_summary(docs, changes.diff_documents(_documents(spark, d, True), _documents(spark, d, False)))


def finding_rows(spark: SparkSession, d: str) -> DataFrame:
    from .queries import _batch

    found = documents.findings(_batch(spark, d))
    return found.groupBy("check", "severity", "message", "expected").agg(F.count("*").alias("n"), F.countDistinct("observed").alias("n_observed"))


def quality_report(spark: SparkSession, d: str) -> DataFrame:
    from .queries import _batch

    return documents.report(documents.findings(_batch(spark, d)))


def checkpoints(spark: SparkSession, d: str) -> DataFrame:
    none = F.array().cast("array<string>")
    n = table(spark, d, "nation").select(F.lower("n_name").alias("jurisdiction"), F.lit("bills").alias("stream"), F.col("n_nationkey").cast("string").alias("cursor"), F.lit(1).alias("attempt"), F.array(F.lit("s1")).alias("completed"), none.alias("pending"))
    n = n.withColumn("pending", state.enqueue(F.col("pending"), F.col("completed"), F.array(*map(F.lit, ["s2", "", "s3", "s1", "s2"]))))
    left, done = state.mark_done(F.col("pending"), F.col("completed"), F.when(F.col("cursor").cast("int") % 2 == 0, "s2").otherwise("s1"))
    n = n.select("jurisdiction", "stream", "cursor", "attempt", left.alias("pending"), done.alias("completed"))
    n = n.withColumn("json", state.checkpoint_json(n))
    return n.select("jurisdiction", F.regexp_replace("json", '"metadata":\\{\\},', "").alias("json"), F.size(state.read_checkpoint(F.col("json"))["pending"]).alias("remaining"))


def watermark_writes(spark: SparkSession, d: str) -> DataFrame:
    u = table(spark, d, "events").select(F.col("user_id").cast("string").alias("jurisdiction"), F.lit("default").alias("stream"), "user_id").distinct()
    stored = u.where("user_id % 5 <> 0").select("jurisdiction", "stream", (F.col("user_id") % 3 + 1).alias("revision"))
    put = state.put_watermarks(stored, u.select("jurisdiction", "stream", (F.col("user_id") % 4).alias("revision")))
    return put.groupBy("accepted").agg(F.count("*").alias("n"), F.min("jurisdiction").alias("first_jurisdiction"))


def _ledger(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "signup", "start").when(F.col("event_type") == "view", "finish").otherwise("record")
    n = lambda t: F.when(F.col("event_type") == t, 1).otherwise(0).cast("long")
    e = table(spark, d, "events")
    return state.run_ledger(e.select(F.col("user_id").alias("run_id"), F.lit("zz").alias("jurisdiction"), F.struct("ts", "event_id").alias("at"), kind.alias("event"), F.when(F.col("event_id") % 7 == 0, "failed").otherwise("succeeded").alias("state"), F.lit(1).cast("long").alias("seen"), n("click").alias("written"), n("error").alias("skipped"), F.lit(0).cast("long").alias("failures"), (n("purchase") * (F.col("user_id") % 2)).alias("blocking")))


def run_ledger(spark: SparkSession, d: str) -> DataFrame:
    return _ledger(spark, d).select("run_id", "state", F.col("started_at.event_id").alias("first_event"), "seen", "written", "skipped")


def run_totals(spark: SparkSession, d: str) -> DataFrame:
    return state.totals(_ledger(spark, d))


def listed_runs(spark: SparkSession, d: str) -> DataFrame:
    runs = _ledger(spark, d).withColumn("started_at", F.col("started_at.event_id"))
    return state.list_runs(runs, "ZZ ", "partial", F.lit(10)).select("run_id", "started_at")


def metrics_snapshot(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_type", F.floor("value").cast("double").alias("value"), F.struct("ts", "event_id").alias("at"))
    key = lambda name: state.metric_key(F.lit(name), F.create_map(F.lit("type"), F.col("event_type")))
    samples = e.select("at", F.inline(F.array(F.struct(key("events").alias("key"), F.lit("counter").alias("kind"), F.lit(1.0).alias("value")), F.struct(F.lit("depth").alias("key"), F.lit("gauge").alias("kind"), F.col("value")), F.struct(key("size").alias("key"), F.lit("observation").alias("kind"), F.col("value")))))
    return state.metrics_snapshot(samples)


def crawl_order(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "pages").select(F.col("page_id").alias("ord"), text.canonical_url(F.col("url")).alias("url"), (F.col("page_id") % 3).alias("priority"), (F.col("page_id") % 6).alias("depth"))
    taken = crawl.accepted_links(p, p.where("ord % 9 = 0"), 4, "www.example.com")
    return crawl.drained(taken, 40)


def response_classes(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("page_id")
    status = F.when(k % 10 == 0, 503).when(k % 7 == 0, 404).when(k % 11 == 0, 500).when(k % 13 == 0, 301).otherwise(200)
    body = F.when(k % 5 == 0, "short").when(k % 3 == 0, F.concat(F.lit("<p>Scheduled\n Maintenance</p>"), F.repeat(F.lit(" "), 600))).otherwise(F.col("html"))
    p = table(spark, d, "pages").select(status.alias("status"), crawl.classify_response(status, body).alias("kind"))
    return p.groupBy("status", "kind").agg(F.count("*").alias("n"))


def request_budgets(spark: SparkSession, d: str) -> DataFrame:
    h = table(spark, d, "nation").select(F.col("n_name").alias("host"), F.col("n_nationkey").alias("hour"))
    own = table(spark, d, "nation").where("n_regionkey = 1").select(F.col("n_name").alias("host"), F.lit(10).alias("requests_per_minute"), F.lit(20).alias("off_start"), F.lit(4).alias("off_end"), F.lit(0.05).alias("multiplier"))
    w = crawl.with_policy(h, own)
    return w.select("host", crawl.budget_at(F.col("hour") % 24).cast("int").alias("budget"), crawl.delay_for(F.col("hour")).alias("delay"))


def parsed_datetimes(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    forms = ["yyyy-MM-dd'T'HH:mm:ss'Z'", "M/d/yyyy", "MMMM d, yyyy' at 10:45'", "yyyy-MM-dd HH:mm:ss"]
    at = F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    raw = F.coalesce(*[F.when(F.col("o_orderkey") % 4 == i, F.date_format(at, f)) for i, f in enumerate(forms)])
    return o.select("o_orderkey", F.date_format(text.parse_datetime(raw), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


def latest_versions(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").where("event_id % 3 = 0")
    v = F.struct("event_id", F.when((F.col("event_type") != "click") & (F.col("user_id") % 4 != 0), F.to_date("ts")).alias("published_on"))
    g = e.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(v)), lambda x: F.struct(x["event_id"].alias("label"), x["published_on"].alias("published_on"))).alias("versions"))
    return g.select("user_id", changes.latest_version(F.col("versions"))["label"].alias("label"))


_CELLS = ["Sen. Jane Smith (D-12)", "Representative JOHN McDONALD (R)", "n/a", "Committee on Ways and Means"]


def sponsor_cells(spark: SparkSession, d: str) -> DataFrame:
    raw = F.element_at(F.array(*map(F.lit, _CELLS)), (F.col("n_nationkey") % len(_CELLS) + 1).cast("int"))
    n = table(spark, d, "nation").select("n_nationkey", raw.alias("raw")).withColumn("s", names.sponsor(F.col("raw")))
    return n.select("n_nationkey", F.col("s.name").alias("name"), F.col("s.party").alias("party"), F.col("s.district").alias("district"), F.col("s.chamber").alias("chamber"))


def sections(spark: SparkSession, d: str) -> DataFrame:
    t = F.when(F.col("n_nationkey") % 5 == 0, F.col("n_name")).otherwise(F.concat(F.lit("To amend.\nSECTION 1. (a) Of "), "n_name", F.lit("\nSec. 2. Rest of it.\nARTICLE IV\n")))
    n = table(spark, d, "nation").select("n_nationkey", F.posexplode(text.split_sections(t)).alias("place", "s"))
    return n.select("n_nationkey", "place", "s.heading", "s.body")


def resolved_links(spark: SparkSession, d: str) -> DataFrame:
    base = F.lit("https://Example.org/a/b/page.html?q=1")
    links = ["../up", "/root?b=2&a=x%20y&utm_source=z", "next.html#part", "//CDN.example.org:443/x/", "?page=2", "HTTPS://user@Example.net:443/p/?flag&b=1", "./same/./x"]
    raw = F.element_at(F.array(*map(F.lit, links)), (F.col("n_nationkey") % len(links) + 1).cast("int"))
    return table(spark, d, "nation").select("n_nationkey", text.absolutise(base, raw).alias("url"))


def registry(spark: SparkSession, d: str) -> DataFrame:
    from .queries import _places

    return state.select_jurisdictions(_places(spark, d), method="http", tag="large").select("code")


QUERIES = {f.__name__: f for f in (document_diffs, upsert_plan, finding_rows, quality_report, checkpoints, watermark_writes, run_ledger, run_totals, listed_runs, metrics_snapshot, crawl_order, response_classes, request_budgets, parsed_datetimes, latest_versions, sponsor_cells, sections, resolved_links, registry)}

_DIFF = """d as (select o_orderkey as document_id, case when o_orderkey % 6 = 0 then 'new' else ['unchanged', 'metadata_only', 'withdrawn', 'status_advanced', 'status_regressed', 'text_revised', 'superseded', 'superseded', 'metadata_only', 'unchanged'][(o_orderkey % 10)::int + 1] end as kind,
 case when o_orderkey % 6 = 0 then '' else coalesce(['title', 'status', 'status', 'status'][(o_orderkey % 10)::int], '') end as fields, o_orderkey % 6 = 0 as fresh, o_orderkey % 10 as r from orders)"""
_LEDGER = """ev as (select *, (ts, event_id) as moment, case event_type when 'signup' then 'start' when 'view' then 'finish' else 'record' end as ev from events),
 g as (select user_id as run_id, arg_min(event_id, moment) filter (where ev = 'start') as first_event, arg_max(case when event_id % 7 = 0 then 'failed' else 'succeeded' end, moment) filter (where ev = 'finish') as fin,
  count(*) filter (where ev = 'record') as seen, count(*) filter (where event_type = 'click') as written, count(*) filter (where event_type = 'error') as skipped, count(*) filter (where event_type = 'purchase') * (user_id % 2) as blocking from ev group by user_id),
 runs as (select *, case when fin is null then 'running' when fin = 'succeeded' and blocking > 0 then 'partial' else fin end as state from g)"""


def sql(url: str, places: str, findings: str) -> dict[str, str]:
    """url, places and findings: the catalogue's SQL that these queries build on."""
    return {
        "document_diffs": f"with {_DIFF} select document_id, kind, fields, case when fresh then null when r = 5 then 0.9 when r in (6, 7) then 0.0 else 1.0 end::double as similarity, (case when fresh then case when r = 8 then 2 else 1 end when r = 8 then 1 else 0 end)::integer as new_actions, kind not in ('unchanged', 'metadata_only') as notable from d",
        "upsert_plan": f"with {_DIFF}, n as (select count(*) as n, count(*) filter (where kind <> 'unchanged') as c, count(*) filter (where r = 8) as a from d) select 0 as place, 'documents' as tab, n as n_rows, 0::bigint as n_replaced from n union all select 1, 'document_versions', n, 0 from n union all select 2, 'document_actions', n + a, n from n union all select 3, 'document_sponsors', 2 * n, n from n union all select 4, 'document_subjects', n, n from n union all select 5, 'document_changes', c, 0 from n",
        "finding_rows": f"with {findings} select \"check\", severity, message, expected, count(*) as n, count(distinct observed) as n_observed from f group by all",
        "quality_report": f"with {findings} select 'check' as section, \"check\" as name, count(*) as n from f group by \"check\" union all select 'severity', s, (select count(*) from f where severity = s) from (select unnest(['info', 'warn', 'error', 'critical']) as s)",
        "checkpoints": """select lower(n_name) as jurisdiction, '{"attempt":1,"completed":["s1"' || case when n_nationkey % 2 = 0 then ',"s2"' else '' end || '],"cursor":"' || n_nationkey || '","jurisdiction":"' || lower(n_name) || '","pending":[' || case when n_nationkey % 2 = 0 then '' else '"s2",' end || '"s3"],"schema":2,"stream":"bills"}' as json, case when n_nationkey % 2 = 0 then 1 else 2 end::integer as remaining from nation""",
        "watermark_writes": "select coalesce(case when user_id % 5 <> 0 then user_id % 4 > user_id % 3 + 1 end, true) as accepted, count(*) as n, min(user_id::varchar) as first_jurisdiction from (select distinct user_id from events) group by 1",
        "run_ledger": f"with {_LEDGER} select run_id, state, first_event, seen, written, skipped from runs",
        "run_totals": f"with {_LEDGER} select 0::bigint as pending, count(*) filter (where state = 'running') as running, count(*) filter (where state = 'succeeded') as succeeded, count(*) filter (where state = 'partial') as partial, count(*) filter (where state = 'failed') as failed, 0::bigint as abandoned, sum(written)::bigint as documents_written from runs",
        "listed_runs": f"with {_LEDGER} select run_id, first_event as started_at from runs where state = 'partial' and first_event >= 10",
        "metrics_snapshot": "select 'counter' as kind, 'events{type=' || event_type || '}' as name, count(*)::double as value from events group by event_type union all select 'gauge', 'depth', arg_max(floor(value), (ts, event_id)) from events union all select 'summary', 'size{type=' || event_type || '}#count', count(*)::double from events group by event_type union all select 'summary', 'size{type=' || event_type || '}#sum', sum(floor(value))::double from events group by event_type",
        "crawl_order": f"with u as (select page_id, {url} as url from pages) select url, min(page_id) as ord, min(page_id) % 3 as priority, min(page_id) % 6 as depth from u where page_id % 6 <= 4 and regexp_matches(url, '^[a-z]+://([^/:?#]*[.])?example[.]com([/:?#]|$)') and url not in (select url from u where page_id % 9 = 0) group by url order by 3 desc, 2 limit 40",
        "response_classes": "with p as (select case when page_id % 10 = 0 then 503 when page_id % 7 = 0 then 404 when page_id % 11 = 0 then 500 when page_id % 13 = 0 then 301 else 200 end as status, page_id % 5 = 0 or page_id % 3 = 0 or strlen(html) < 512 as empty from pages) select status, case when status = 503 then 'rate_limited' when status = 500 then 'fetch' when status = 200 and empty then 'unavailable' end as kind, count(*) as n from p group by all",
        "request_budgets": "select n_name as host, case when n_regionkey = 1 then case when n_nationkey % 24 >= 20 or n_nationkey % 24 < 4 then 1 else 10 end when n_nationkey % 24 < 5 then 45 else 30 end::integer as budget, case when n_nationkey <= 1 then 0.0 else least(60.0, power(2.0, n_nationkey - 2)) end::double as delay from nation",
        "parsed_datetimes": "select o_orderkey, strftime(case o_orderkey % 4 when 1 then date_trunc('day', o_orderdate + interval (o_orderkey % 24) hour) when 2 then date_trunc('day', o_orderdate + interval (o_orderkey % 24) hour) + interval 645 minute else o_orderdate + interval (o_orderkey % 24) hour end, '%Y-%m-%d %H:%M:%S') as parsed from orders",
        "latest_versions": "with v as (select user_id, event_id, case when event_type <> 'click' and user_id % 4 <> 0 then ts::date end as p from events where event_id % 3 = 0) select user_id, coalesce(arg_max(event_id, (p, -event_id)) filter (where p is not null), max(event_id)) as label from v group by user_id",
        "sponsor_cells": "select n_nationkey, ['Jane Smith', 'John McDonald', null, 'Committee on Ways and Means'][n_nationkey % 4 + 1] as name, ['D', 'R', null, null][n_nationkey % 4 + 1] as party, ['12', null, null, null][n_nationkey % 4 + 1] as district, ['upper', 'lower', null, 'unknown'][n_nationkey % 4 + 1] as chamber from nation",
        "sections": "select n_nationkey, 0 as place, case when n_nationkey % 5 = 0 then 'body' else 'preamble' end as heading, case when n_nationkey % 5 = 0 then n_name else 'To amend.' end as body from nation union all select n_nationkey, 1, 'SECTION 1', 'Of ' || n_name from nation where n_nationkey % 5 <> 0 union all select n_nationkey, 2, 'Sec. 2', 'Rest of it.' from nation where n_nationkey % 5 <> 0",
        "resolved_links": "select n_nationkey, ['https://example.org/a/up', 'https://example.org/root?a=x+y&b=2', 'https://example.org/a/b/next.html', 'https://cdn.example.org/x', 'https://example.org/a/b/page.html?page=2', 'https://example.net/p?b=1&flag=', 'https://example.org/a/b/same/x'][n_nationkey % 7 + 1] as url from nation",
        "registry": f"with {places} select code from places where method = 'http' and large",
    }
