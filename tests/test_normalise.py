"""Sponsor cells and loose records."""

from datetime import date

from pyspark.sql import functions as F

from docketlake.functions import names
from docketlake.operators.normalise import normalise

RECORD = "identifier string, bill_number string, title string, summary string, kind string, chamber string, status string, url string, source_url string, introduced_on string, introduced string, last_action_on string, subjects array<string>, sponsors array<string>, actions array<struct<date:string,description:string,chamber:string,committee:string,sequence:int>>, versions array<struct<label:string,text:string,published_on:string>>"


def test_sponsor_cells(spark):
    cells = ["SMITH, J. (R-14)", "Rep. Jane McDONALD (Democratic) District 7", "Committee on Ways and Means", "--", "n/a", None, "Sen. O'NEIL-VAN DER BERG, co-sponsor", "ANNA DE LA CRUZ JR."]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string").select("i", names.sponsor(F.col("c")).alias("s"))
    got = {r["i"]: r["s"] and tuple(r["s"]) for r in df.collect()}
    assert got[0] == ("Smith, J.", "unknown", "R", "14", "unknown")
    assert got[1] == ("Jane McDonald", "unknown", "D", "7", "lower")
    assert got[2] == ("Committee on Ways and Means", "committee", None, None, "unknown")
    assert got[3] is got[4] is got[5] is None
    assert got[6][1] == "cosponsor" and got[6][4] == "upper"
    assert got[7][0] == "Anna de la Cruz JR."


def test_first_placeholder_leaves_no_primary(spark):
    df = spark.range(1).select(names.sponsors(F.array(F.lit("--"), F.lit("Ann Lee"))).alias("s"))
    assert [x["role"] for x in df.first()["s"]] == ["cosponsor"]


def test_merge_sponsors(spark):
    rows = [(1, ("Ann Lee", "cosponsor", None, "3", "unknown"), 0), (1, ("ANN LEE", "primary", "D", "4", "upper"), 1), (1, ("Bo Li", "unknown", None, None, "unknown"), 2)]
    df = spark.createDataFrame(rows, f"k int, sponsor {names.SPONSOR}, ord int")
    got = [tuple(r["sponsor"]) for r in names.merge_sponsors(df, "k").orderBy("ord").collect()]
    assert got == [("Ann Lee", "primary", "D", "3", "upper"), ("Bo Li", "unknown", None, None, "unknown")]


def test_records(spark):
    acts = [("2024-01-10", "Introduced", None, None, None), ("03/05/2024", "Referred to Health", "upper", None, 0), ("soon", "Signed by Governor", None, None, None), ("2024-02-01", " ", None, None, None)]
    rows = [("HB 12", None, " An  act ", None, None, None, "enacted", "http://X.test/a/", None, "2024-06-01", None, None, ["Public Health"], ["--", "Ann Lee (D)"], acts, [("b", "second", None), ("a", "first", "2024-01-02"), ("c", " ", None)])]
    rows += [(None,) * 16, (" ", "SR 3") + (None,) * 14]
    docs, bad = normalise(spark.createDataFrame(rows, RECORD), F.lit("zz"), F.lit("2024"))
    got = {r["identifier"]: r for r in docs.collect()}
    a, b = got["HB 12"], got["SR 3"]
    assert (a["status"], a["chamber"], a["kind"], a["title"], a["introduced_on"], a["last_action_on"]) == ("in_committee", "lower", "bill", "An act", date(2024, 3, 5), date(2024, 3, 5))
    assert a["subjects"] == ["health"] and [v["label"] for v in a["versions"]] == ["a", "b"] and len(a["actions"]) == 2 and len(a["sponsors"]) == 1
    assert (b["kind"], b["chamber"], b["status"], b["introduced_on"]) == ("resolution", "upper", "unknown", None) and bad.count() == 1
