"""The stages and the run of the corpus pipeline against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from docketlake.llm import jaccard_join
from test_jaccard_brute import components_of

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(11)
    words = [f"{a}{b}{c}" for a in "bdfglmnprst" for b in "aeiou" for c in ("n", "r", "st", "nd")]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    item = "every seventh winter the old keeper walks along that narrow northern wall alone"
    rows = []
    for i in range(60):
        rows.append((i, prose(60), "en", "a" if i % 3 else "b", 0))
    for i in range(60, 80):  # near copies
        w = rows[i - 60][1].split()
        w[30] = "changed"
        rows.append((i, " ".join(w), "en", "a", 0))
    rows += [(80, prose(20) + " " + item + " " + prose(20), "en", "b", 0), (81, "too short", "en", "a", 0), (82, None, "en", "a", 0), (83, "", None, None, 0), (84, "again and again and " * 40, "en", "a", 0), (None, prose(50), "en", "a", 0), (5, prose(50), "en", "a", 0), rows[7]]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def key(r):
    return (-1 if r["doc_id"] is None else r["doc_id"], r["text"] or "")


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {key(r) for r in docs.collect()}
    kept = pipeline.quality(spark, docs, folder)
    assert kept.columns == docs.columns
    got = sorted(map(key, kept.collect()))
    # only the base rule rejects: forty labels certify no cutoff
    assert {x for x in rows if x not in set(got)} == {x for x in rows if x[0] in (81, 82, 83, 84)}
    near = sorted(map(key, pipeline.near_copies(spark, kept, folder).collect()))
    of = components_of(got)
    first = {}
    for x in sorted(set(got), key=lambda x: (x[0] == -1, x[0])):
        first.setdefault(of[x], x)
    assert sorted(set(first.values()) - set(near)) == []
    assert len(near) == len(set(near)) == len(set(of.values()))
    assert all(x == first[of[x]] for x in near)
    clean = pipeline.benchmark_leaks(spark, spark.createDataFrame(near, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("a"), "n_chars": F.lit(0).cast("long")}), folder)
    assert {x for x in near if x not in set(map(key, clean.collect()))} == {x for x in near if x[0] == 80}


def test_run(spark, folder):
    out = pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in out} <= {*range(60), None} and len(out) > 30
    starts = sorted((r["start"], r["n_tokens"]) for r in out)
    assert [s for s, _ in starts] == [sum(n for _, n in starts[:i]) for i in range(len(starts))]
    # the order of the mixing stays: ids are not ascending along the shards
    ids = [r["doc_id"] for r in sorted(out, key=lambda r: r["start"]) if r["doc_id"] is not None]
    assert ids != sorted(ids)


def test_names_that_clash(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    extra = docs.withColumns({c: F.lit(c) for c in ("_row", "_d", "_h", "_key", "_p", "_word", "_bits", "row", "rate", "_name")})
    for stage in (pipeline.quality, pipeline.near_copies, pipeline.benchmark_leaks, pipeline.mixture):
        got = stage(spark, extra, folder)
        assert got.columns == extra.columns
        assert all(r["_row"] == "_row" and r["_h"] == "_h" and r["rate"] == "rate" and r["row"] == "row" for r in got.collect())
    assert jaccard_join.keep_one(extra).where("_d <> '_d'").count() == 0
