"""Portal payloads, the raw archive and publishing."""

import pytest
from pyspark.sql import functions as F

from docketlake.functions import text
from docketlake.plans import publish
from docketlake.sources import portals, readers


def test_docket_block(spark):
    blocks = ["skipped\n01/05/23 REFERRED  TO\r\n   RULES\n\n02/06/23 PASSED\n02/07/23\n1/2/23 no date", "", None, "01/05/23 a\u0001b"]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(blocks)], "i int, b string")
    got = {r["i"]: [tuple(a) for a in r["a"]] for r in df.select("i", portals.docket_block(F.col("b")).alias("a")).collect()}
    assert got[0] == [("01/05/23", "REFERRED TO RULES", 0), ("02/06/23", "PASSED 02/07/23 1/2/23 no date", 1)]
    assert got[1] == got[2] == [] and len(got[3]) == 1
    lines = spark.createDataFrame([("  01/05/23  SIGNED ",), ("more",), (None,)], "l string").select(portals.status_line(F.col("l")).alias("s"))
    assert [r["s"] and tuple(r["s"]) for r in lines.collect()] == [("01/05/23", "SIGNED"), None, None]


def test_session_numbers(spark):
    s = F.lit("2023-2024")
    row = spark.range(1).select(portals.session_number(s, portals.CONGRESS), portals.texas_code(s), portals.texas_code(s, 2), portals.session_number(s, portals.ILLINOIS), portals.illinois_session_id(s), portals.session_number(F.lit("2021"), portals.OHIO), portals.session_number(F.lit("x"), portals.OHIO)).first()
    assert tuple(row) == (118, "89R", "892", 103, 88, 134, None)


def test_api_records(spark):
    body = '{"items": [{"number": " SB  4 ", "sponsors": [{"name": "A"}, null], "actions": [{"date": "2024-01-01"}, null, {"date": "2024-01-02"}]}, {}]}'
    items, errors = readers.api_items(spark.createDataFrame([(body,), ("[]",), (None,)], "body string"), portals.API_ITEM)
    got = portals.base_records(portals.api_records(items), "oh", "2023-2024", "http").collect()
    assert [(r["identifier"], r["chamber"], r["sponsors"], [a["sequence"] for a in r["actions"]], r["versions"], r["jurisdiction"]) for r in got] == [("SB 4", "upper", ["A"], [0, 2], [], "oh"), ("unknown", "lower", [], [], [], "oh")]
    assert errors.count() == 2


def test_xml_records(spark):
    full = '<?xml version="1.0"?>\n<!-- x -->\n<billStatus><bill><billNumber>7</billNumber><billType>SJRES</billType><title>A &amp; B</title><introducedDate>2023-01-09</introducedDate><latestAction><text>Read</text></latestAction><subjects><billSubjects><legislativeSubjects><item><name>Taxes</name></item></legislativeSubjects></billSubjects></subjects><summaries><billSummaries><item><text>One.</text></item><item><text>Two.</text></item></billSummaries></summaries></bill></billStatus>'
    rows = [(0, full), (1, "<bill><type>hr</type><number>1</number></bill>"), (2, "<a><b>"), (3, "<urlset/>"), (4, "<bill><number>1</number></bill>"), (5, ""), (6, None)]
    good, bad = portals.xml_records(spark.createDataFrame(rows, "i int, p string"), "p", "i")
    got = {r["i"]: r for r in good.collect()}
    assert sorted(got) == [0, 1]
    a = got[0]
    assert (a["identifier"], a["title"], a["chamber"], a["status"], a["summary"], a["subjects"], a["introduced_on"], a["actions"]) == ("SJRES7", "A & B", "upper", "Read", "One. Two.", ["Taxes"], "2023-01-09", [])
    assert (got[1]["identifier"], got[1]["chamber"], got[1]["sponsors"]) == ("HR1", "lower", [])
    assert {r["i"]: r["error"] for r in bad.collect()} == {2: "payload is not XML", 3: "no bill element", 4: "no identifier", 5: "payload is not XML", 6: "payload is not XML"}


def test_archive(spark, tmp_path):
    rows = [("ZZ", "2024-01-05 10:00:00", 200, "a"), ("ZZ", "2024-01-05 11:00:00", 200, "a"), ("ZZ", None, 204, "b"), ("ZZ", None, 500, "c")]
    f = spark.createDataFrame(rows, "jurisdiction string, fetched_at string, status int, body string").withColumn("body", F.col("body").cast("binary"))
    none = spark.createDataFrame([], "key string")
    readers.write_archive(f, str(tmp_path / "raw"), none)
    stored = spark.read.parquet(str(tmp_path / "raw"))
    assert sorted((str(r["day"]), bytes(r["body"])) for r in stored.collect()) == [("1970-01-01", b"b"), ("2024-01-05", b"a")]
    readers.write_archive(f, str(tmp_path / "raw"), stored.select("key"))
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 2
    assert tuple(readers.archive_stats(readers.archivable(f), stored).first()) == (0, 3, 3)
    assert tuple(readers.archive_stats(f.limit(0), none).first()) == (0, 0, 0)
    assert readers.archive_keys(f, "cold").first()["key"].startswith("cold/zz/2024-01-05/")
    with pytest.raises(Exception, match="empty body"):
        readers.new_objects(f.withColumn("body", F.lit(b"")), none).collect()
    assert spark.range(1).select(readers.manifest_key(F.lit("ZZ"), F.lit("2024-01-05"), F.lit("r1"))).first()[0] == "manifests/zz/2024-01-05/r1.json"


def test_publish(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "document_id int, title string")
    batch = spark.createDataFrame([(2, "c", 1), (2, None, 2), (3, "d", 1)], "document_id int, title string, ord int")
    assert sorted(map(tuple, publish.snapshot(docs, batch).collect()), key=str) == [(1, "a"), (2, None), (3, "d")]
    path = publish.build_index(docs, str(tmp_path), "Bills", "20240105T0400")
    assert path.endswith("/bills-documents-20240105t0400")
    assert publish.flip_alias(spark, path, "bills_documents").count() == 2
    empty = publish.build_index(docs.limit(0), str(tmp_path), "Bills", "20240106")
    with pytest.raises(ValueError):
        publish.flip_alias(spark, empty, "bills_documents")
    assert spark.table("bills_documents").count() == 2
    kinds = spark.createDataFrame([("unchanged",), ("metadata_only",), ("new",)], "kind string")
    assert publish.notable(kinds).count() == 1


def test_subject_list(spark):
    df = spark.createDataFrame([(["Taxes", " Odd  one", "Odd one", "", None, "Police", "taxes"],), (None,)], "c array<string>").select(text.subject_list(F.col("c")).alias("s"))
    assert [(r["s"]["subjects"], r["s"]["unmapped"]) for r in df.collect()] == [(["public-safety", "revenue"], ["Odd one"]), ([], [])]
    got = spark.range(1).select(text.subject_aliases(F.lit("revenue")).alias("a"), text.subject_aliases(F.lit("x")).alias("b")).first()
    assert "taxes" in got["a"] or "taxation" in got["a"]
    assert got["b"] == []
