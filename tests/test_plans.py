"""Scheduling, alerts and backfill."""

import pytest
from pyspark.sql import functions as F

from docketlake.plans import orchestration as plan

PLACE = "code string, method string, enabled boolean, tags array<string>"


def _now():
    return F.lit("2024-01-31 00:00:00").cast("timestamp")


def test_schedule(spark):
    places = [(c, "browser" if c < "d" else "http", c != "z", ["federal"] if c == "e" else []) for c in "abcdefz"]
    marks = [("a", "2024-01-01 00:00:00"), ("b", "2024-01-02 00:00:00"), ("c", "2024-01-03 00:00:00"), ("d", "2024-01-30 00:00:00"), ("e", "2024-01-30 00:00:00"), ("f", "2024-01-30 23:59:00")]
    j = spark.createDataFrame(places, PLACE)
    w = spark.createDataFrame(marks, "jurisdiction string, observed_through string").withColumn("observed_through", F.col("observed_through").cast("timestamp"))
    assert [r["code"] for r in plan.schedule(j, w, _now()).collect()] == ["a", "b", "e", "d"]
    assert [r["code"] for r in plan.schedule(j, w, _now(), parallel=3).collect()] == ["a", "b", "e"]
    got = {r["code"]: (r["reason"], r["selected"]) for r in plan.schedule_decisions(j, w, _now()).collect()}
    assert got["c"] == ("stale", False) and got["f"] == ("within freshness target", False) and got["a"] == ("stale", True) and "z" not in got


def test_alerts(spark):
    j = spark.createDataFrame([(c, "http", c != "z", []) for c in "abcz"], PLACE)
    w = spark.createDataFrame([("a", "2024-01-30 12:00:00"), ("b", "2024-02-02 00:00:00")], "jurisdiction string, observed_through string").withColumn("observed_through", F.col("observed_through").cast("timestamp"))
    # b fails four times after its success, a running run in between; a once, c succeeded last
    runs = [("b", 1, "succeeded"), *[("b", i, "failed") for i in (2, 3, 5, 6)], ("b", 4, "running"), ("a", 1, "failed"), ("c", 1, "failed"), ("c", 2, "failed"), ("c", 3, "partial")]
    r = spark.createDataFrame([(c, i, s, i) for c, i, s in runs], "jurisdiction string, run_id int, state string, started_at int")
    got = [tuple(x) for x in plan.ordered_alerts(plan.alerts(j, w, r, _now())).select("jurisdiction", "rule", "severity", "value").collect()]
    assert got == [("b", "consecutive_failures", "critical", 4.0), ("c", "never_ingested", "critical", None), ("a", "stale_watermark", "warn", 43200.0)]
    assert {x["jurisdiction"]: x["streak"] for x in plan.failure_streaks(r).collect()} == {"a": 1, "b": 4, "c": 0}
    assert plan.failure_streaks(r.limit(0)).count() == 0


def test_backfill(spark):
    j = spark.createDataFrame([("a", 2020, True), ("b", 2021, False)], "jurisdiction string, from_year int, biennial boolean")
    slices = plan.backfill(j, F.lit("2021-02-10").cast("date"))
    got = [(r["jurisdiction"], r["session"], str(r["start"]), str(r["end"])) for r in plan.take(slices, 5).collect()]
    assert got == [("a", "2021-2022", "2021-01-01", "2021-01-30"), ("a", "2021-2022", "2021-01-31", "2021-02-10"), ("b", "2021", "2021-01-01", "2021-01-30"), ("b", "2021", "2021-01-31", "2021-02-10"), ("a", "2019-2020", "2019-01-01", "2019-01-30")]
    done = slices.where("jurisdiction = 'b'").select("label")
    assert {r["jurisdiction"] for r in plan.backfill(j, F.lit("2021-02-10").cast("date"), completed=done).collect()} == {"a"}
    assert plan.backfill(j, F.lit("2021-02-10").cast("date"), max_slices=1).count() == 2
    with pytest.raises(ValueError):
        plan.take(slices, -1)
