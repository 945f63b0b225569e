import hashlib
import uuid

from pyspark.sql import functions as F

from docketlake import queries
from docketlake.functions import docket, ids, text
from docketlake.operators import documents as ops


def column(spark, values, f):
    rows = [(i, v) for i, v in enumerate(values)]
    out = spark.createDataFrame(rows, "i int, v string").select("i", f(F.col("v")).alias("o")).orderBy("i").collect()
    return [r["o"] for r in out]


def test_docket_wording(spark):
    lines = ["Veto overridden", "Vetoed by Governor", "PASSED Senate", "Referred to Ways", "pre-filed", "Amendment adopted", "nothing"]
    assert column(spark, lines, docket.status_from_action) == ["veto_overridden", "vetoed", "passed_origin", "in_committee", "introduced", None, None]
    assert column(spark, lines, docket.classify_action)[0] == "floor_vote"
    assert column(spark, ["enacted", "dead", "unknown"], docket.status_rank) == [13, 14, 0]


def test_ids(spark):
    assert column(spark, ["H.B. 1234", "sb12-a", "A resolution"], lambda c: ids.citation(F.lit("CA"), F.lit("2023-2024"), c)) == ["ca-2023-2024-HB1234", "ca-2023-2024-SB12A", "ca-2023-2024-A-RESOLUTION"]
    assert column(spark, ["HB 1000000"], lambda c: ids.citation(F.lit("CA"), F.lit("2024"), c)) == ["ca-2024-HB-1000000"]
    want = str(uuid.uuid5(uuid.UUID(ids.NAMESPACE), "bill::x"))
    assert column(spark, ["x"], lambda c: ids.document_id(c, F.lit("bill"))) == [want]


def test_dates_and_urls(spark):
    got = column(spark, ["2024-02-03", "2/3/24", "20240203", "February 3, 2024", "3 Feb 2024", "2024-02-30", "1/5/75", "", None, "soon"], lambda c: text.parse_date(c).cast("string"))
    assert got == ["2024-02-03"] * 5 + [None, "1975-01-05", None, None, None]
    assert column(spark, ["HTTPS://u@Ex.org:443/a/?b=2&utm_source=x&a=1#f", "not a url"], text.canonical_url) == ["https://ex.org/a?a=1&b=2", "not a url"]


def test_lists_and_subjects(spark):
    assert column(spark, ["A; a, B|  c ", None], text.split_list) == [["A", "B", "c"], []]
    assert column(spark, ["Public Health -- x", "Weather"], text.subject) == ["health", None]


def test_merge_and_batches(spark):
    a = spark.createDataFrame([(1, "2024-01-01", "Passed", None, None, 1), (1, "2024-01-01", "passed", "upper", None, 2), (1, "2024-01-02", "passed", None, None, 3)], "d int, occurred_on string, description string, chamber string, committee string, ord int")
    assert sorted((r["occurred_on"], r["chamber"]) for r in ops.merge_actions(a, "d").collect()) == [("2024-01-01", "upper"), ("2024-01-02", None)]
    b = ops.batches(spark.range(1003).toDF("k"), "k", 250).groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in b] == [250, 250, 250, 250, 3]


def test_semantic_digests_of_every_text(spark, tmp_path):
    texts = ["Plain text, Printed on 3 May\nend", "École  ﬁn Printed on 3 mai\nsuite", "ein­zeln Straße\x1fÜber", "Été page ١ of ２ fin", "éprinted on x", "ÀÉ session_id = é1;x y", "", None]
    want = ["plain text, end", "école fin suite", "einzeln straße über", "été fin", "éprinted on x", "àé y", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["digest"] for r in queries.semantic_digests(spark, str(tmp_path)).collect()}
    assert got == {i: w if w is None else hashlib.sha256(w.encode()).hexdigest() for i, w in enumerate(want)}


def test_strip_tags_replaces_entities(spark):
    pages = ["<p>Fish &amp; chips&nbsp;&nbsp;&copy; 2024</p><p>a &lt;b&gt; c</p>", "<script>x &amp; y</script>one&#10;two&#xA0;\n<br>\n\n<br>three&middot;", "no markup", "", None]
    assert column(spark, pages, text.strip_tags) == ["Fish & chips © 2024\n\na <b> c", "one\ntwo\n\nthree·", "no markup", "", None]


def test_findings_of_every_check(spark):
    schema = "document_id long, identifier string, title string, introduced_on string, last_action_on string, batch_observed string, status string, n_actions int, last_acted_on string, last_terminal_on string, chamber string, kind string, n_primary int, n_sponsors int"

    def row(i, introduced, last, status="introduced", acted=None, terminal=None):
        return (i, "HB 1", "A longer title", introduced, last, "2024-01-01", status, 2, acted, terminal, "upper", "bill", 1, 1)

    rows = [row(1, "2025-01-01", "2025-02-01"), row(2, None, "1850-01-01"), row(3, "2023-01-01", "2024-01-04"), row(4, None, None, "enacted", "2023-03-02", "2023-03-01"), row(5, None, None, "enacted", "2023-03-01", "2023-03-01"), row(6, None, None, "introduced", "2023-03-02", "2023-03-01"), row(7, "1850-01-01", "2025-02-01"), row(8, None, None, "enacted", "2023-03-02", None)]
    docs = spark.createDataFrame(rows, schema)
    for d in ("introduced_on", "last_action_on", "last_acted_on", "last_terminal_on"):
        docs = docs.withColumn(d, F.col(d).cast("date"))
    found = sorted((r["subject"], r["check"], r["severity"]) for r in ops.findings(docs).select("check", "severity", "subject").collect())
    bad = ("dates_plausible", "error")
    assert found == [(1, *bad), (1, *bad), (2, *bad), (4, "terminal_consistency", "warn"), (7, *bad), (7, *bad)]
    none = docs.limit(0)
    assert [tuple(r) for r in ops.findings(none).select("check", "severity", "subject").collect()] == [("batch_not_empty", "info", None)]
    assert ops.gate(ops.findings(none), none).first()["info"] == 1
