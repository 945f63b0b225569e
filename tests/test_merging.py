"""Merging of observations and HTML tables."""

from datetime import date

from pyspark.sql import functions as F

from docketlake.functions import tables
from docketlake.operators.merging import merge_documents
from docketlake.operators.normalise import normalise
from test_normalise import RECORD


def _docs(spark, rows):
    base = dict.fromkeys(["identifier", "bill_number", "title", "summary", "kind", "chamber", "status", "url", "source_url", "introduced_on", "introduced", "last_action_on", "subjects", "sponsors", "actions", "versions"])
    data = [tuple((base | r).values()) for r in rows]
    docs, _ = normalise(spark.createDataFrame(data, RECORD).coalesce(1), F.lit("zz"), F.lit("2024"))
    return docs.withColumn("ord", F.monotonically_increasing_id())


def test_merge(spark):
    rows = [
        {"identifier": "HB 1", "title": "Short", "sponsors": ["Ann Lee"], "subjects": ["Taxes"], "introduced_on": "2024-01-01"},
        {"identifier": "HB 1", "title": "A longer title", "summary": "s", "sponsors": ["Bo Li", "Ann Lee (D)"], "subjects": ["Police"], "actions": [("2024-02-01", "Introduced", None, None, None)], "versions": [("x", "one", None), ("y", "two", None)]},
        {"identifier": "HB 1", "actions": [("2024-02-01", "introduced", "lower", None, None), ("2024-03-01", "Withdrawn", None, None, None)], "versions": [("z", "two", None)]},
        {"identifier": "SB 2", "title": "Alone"},
    ]
    got = {r["identifier"]: r for r in merge_documents(_docs(spark, rows)).collect()}
    a = got["HB 1"]
    assert (a["title"], a["summary"], a["n_merged"], a["introduced_on"], a["last_action_on"]) == ("A longer title", "s", 3, date(2024, 2, 1), date(2024, 3, 1))
    assert [(x["description"], x["chamber"]) for x in a["actions"]] == [("introduced", "lower"), ("Withdrawn", "unknown")]
    assert [v["label"] for v in a["versions"]] == ["x", "y"] and a["subjects"] == ["public-safety", "revenue"]
    assert [(s["name"], s["role"], s["party"]) for s in a["sponsors"]] == [("Bo Li", "primary", None), ("Ann Lee", "primary", "D")]
    assert got["SB 2"]["actions"] == [] and got["SB 2"]["n_merged"] == 1


def test_merge_nothing(spark):
    assert merge_documents(_docs(spark, [{"identifier": None}])).count() == 0


def test_tables(spark):
    html = "<table><tr><th>Date<th>Action taken</tr><tr><td colspan=2>2024 &amp; on</td><td>extra</td></tr><tr><td></td></tr><tr><td>a<td><b>b</b>c</table><table></table>"
    assert tables.read_tables(html) == [{"headers": ["Date", "Action taken"], "rows": [["2024 & on", "", "extra"], ["a", "b c"]]}]
    assert tables.read_tables(None) == [] and tables.read_tables("<p>none") == []
    df = spark.createDataFrame([(html,), (None,)], "h string").select(tables.parse_tables("h").alias("t"))
    df = df.select(tables.records(tables.first_table(F.col("t"), "action")).alias("r"))
    assert df.first()["r"] == [{"Date": "2024 & on", "Action taken": "", "_extra": "extra"}, {"Date": "a", "Action taken": "b c"}]
