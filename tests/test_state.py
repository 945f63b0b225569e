"""Rules of folds, gates, state and addresses that the tables do not show."""

import itertools
import unicodedata
from urllib.parse import urljoin

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from docketlake.functions import ids, text
from docketlake.operators import changes, crawl, documents
from docketlake.plans import state


def folded(rows):
    """The rule, one row after the other."""
    kept = None
    for row in rows:
        if kept is None or (kept[1] is None and row[1] is not None) or (kept[2] is None and row[2] is not None):
            kept = row
    return kept


def test_actions_fold_in_order(spark):
    kinds = [(None, None), ("upper", None), (None, "Ways"), ("upper", "Ways")]
    cases = [c for n in (1, 2, 3, 4) for c in itertools.product(kinds, repeat=n)]
    rows = [(k, "2024-01-01", "Read", *x, i) for k, c in enumerate(cases) for i, x in enumerate(c)]
    d = spark.createDataFrame(rows, "id long, occurred_on string, description string, chamber string, committee string, ord long")
    got = {r["id"]: (r["ord"], r["chamber"], r["committee"]) for r in documents.merge_actions(d, "id").collect()}
    assert got == {k: folded([(i, *x) for i, x in enumerate(c)]) for k, c in enumerate(cases)}


def test_gate(spark):
    found = spark.createDataFrame([("a", "error"), ("b", "critical"), ("c", "warn")], "check string, severity string")
    docs = spark.range(10)
    one = lambda **k: documents.gate(found, docs, **k).first()
    assert (one()["passed"], one()["blocked_by"], one()["worst"]) == (False, "b,a", "critical")
    assert one(waived=("a", "b"))["passed"] and one(waived=("a", "b"))["warn"] == 3
    assert one(waived=("b",), max_rate=0.2)["passed"] and not one(waived=("b",), max_rate=0.05)["passed"]
    assert one(waived=("b",), max_errors=1)["passed"] and one(waived=("b",), max_errors=5, max_rate=0.05)["blocked_by"].endswith("error_rate")
    with pytest.raises(PySparkException):
        documents.enforce(documents.gate(found, docs)).collect()
    assert documents.enforce(documents.gate(found.where("check = 'c'"), docs)).first()["passed"]


def test_report_and_order(spark):
    found = spark.createDataFrame([("a", "warn", 2, "m"), ("b", "error", 1, "m"), ("a", "warn", 1, "m")], "check string, severity string, subject long, message string")
    assert [(r["check"], r["subject"]) for r in documents.ordered_findings(found).collect()] == [("b", 1), ("a", 1), ("a", 2)]
    got = {(r["section"], r["name"]): r["n"] for r in documents.report(found.where("check = 'a'")).collect()}
    assert got == {("severity", "info"): 0, ("severity", "warn"): 2, ("severity", "error"): 0, ("severity", "critical"): 0, ("check", "a"): 2}


def test_checkpoints(spark):
    d = spark.createDataFrame([('{"jurisdiction":" ZZ ","completed":["a","a"],"pending":["b","a","b"]}',), ('{"schema":3,"jurisdiction":"zz"}',), ("broken",), ('{"schema":2}',)], "raw string")
    got = [r["c"] for r in d.select(state.read_checkpoint(F.col("raw")).alias("c")).collect()]
    assert got[0].asDict() == {"jurisdiction": "zz", "stream": "default", "cursor": "", "completed": ["a"], "pending": ["b"], "attempt": 0} and got[1:] == [None] * 3


def test_counters_cannot_fall(spark):
    d = spark.createDataFrame([("k", "counter", -1.0, 1)], "key string, kind string, value double, at int")
    with pytest.raises(PySparkException):
        state.metrics_snapshot(d).collect()
    with pytest.raises(ValueError):
        state.select_jurisdictions(spark.createDataFrame([("aa", True)], "code string, enabled boolean"), ["zz"])


def test_addresses(spark):
    base = "https://example.org/a/b/page.html?q=1"
    hrefs = ["../up", "../../../up", "/root", "next", "./x/../y", "//other.org/z", "?page=2", "http://a.org/", "x?y=1#z"]
    d = spark.createDataFrame([(h,) for h in hrefs], "h string")
    got = [r[0] for r in d.select(text.absolutise(F.lit(base), F.col("h"))).collect()]
    assert got == [urljoin(base, h).split("#")[0] for h in hrefs]
    urls = ["https://e.org/p?b&a=x%20y", "  not a url ", None, "HTTP://U@E.org:80/?_=1&z=%C3%A9*~", "https://e.org/?a=1&a=0"]
    d = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in d.select(text.canonical_url(F.col("u"))).collect()] == ["https://e.org/p?a=x+y&b=", "not a url", "", "http://e.org/?z=%C3%A9%2A~", "https://e.org/?a=0&a=1"]
    assert d.select(text.strip_params(F.lit("https://e.org/?A=1&b=2"), ("a",))).first()[0] == "https://e.org/?b=2"


def test_responses(spark):
    rows = [(200, "x" * 600), (200, "x"), (200, "site is  down for maintenance" + " " * 600), (404, ""), (503, ""), (502, ""), (301, ""), (200, " " * 20_000 + "request blocked"), (200, None)]
    d = spark.createDataFrame(rows, "status int, body string")
    assert [r[0] for r in d.select(crawl.classify_response(F.col("status"), F.col("body"))).collect()] == [None, "unavailable", "unavailable", None, "rate_limited", "fetch", None, None, "unavailable"]


def test_texts(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    raw = "“A ﬁne­  day”\r\n\r\n\r\n\r\n\tnext  line "
    assert one(text.clean_text(F.lit(raw))) == unicodedata.normalize("NFKC", '"A ﬁne day"\n\nnext line')
    assert one(text.strip_leading_enumerator(F.lit("(a) Of the matter"))) == "Of the matter"
    assert one(text.dedent_block(F.lit("\n    a\n      b\n\n    c\n"))) == "a\n  b\n\nc"
    assert one(text.extract_body_text(F.lit("<div>Text &amp; more</div><script>x</script>"))) == "Text & more"
    assert one(text.extract_body_text(F.lit("%PDF-1.7"))) is None
    assert [str(x) for x in one(text.day_range(F.lit("2024-02-28").cast("date"), F.lit("2024-03-01").cast("date")))] == ["2024-02-28", "2024-02-29", "2024-03-01"]
    assert one(text.day_range(F.lit("2024-03-01").cast("date"), F.lit("2024-02-28").cast("date"))) == []
    assert one(text.iso_format(F.lit("2024-03-01 10:00:00").cast("timestamp"))) == "2024-03-01T10:00:00Z"
    assert one(ids.short_digest(F.lit("a" * 64))) == "a" * 12


def test_latest_version(spark):
    d = spark.sql("select 1 as id, array(named_struct('label', 'a', 'published_on', date '2024-01-02'), named_struct('label', 'b', 'published_on', date '2024-01-02'), named_struct('label', 'c', 'published_on', date '2024-01-01')) as v union all select 2, array(named_struct('label', 'a', 'published_on', cast(null as date)), named_struct('label', 'z', 'published_on', cast(null as date)))")
    assert [r[0] for r in d.orderBy("id").select(changes.latest_version(F.col("v"))["label"]).collect()] == ["a", "z"]
