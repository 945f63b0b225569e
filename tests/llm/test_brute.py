"""Lines, repeated strings, slots, license recall and the binomial bound against plain Python."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketlake.llm import decontamination, license_scan, line_dedup, quality_rules, substring_dedup, suffix_dedup

SCHEMA = "doc_id long, text string"


def one_edit(x, y):
    if len(x) > len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) == 1
    return len(x) + 1 == len(y) and any(y[:i] + y[i + 1 :] == x for i in range(len(y)))


def test_lines(spark):
    r = random.Random(3)
    base = ["".join(r.choice("ab é𝄞") for _ in range(r.choice([2, 3, 4, 5, 31, 32, 33, 34, 64, 65, 97]))) for _ in range(90)]
    docs = []
    for d in range(45):
        lines = []
        for _ in range(r.randrange(1, 9)):
            x = r.choice(base)
            for _ in range(r.choice([0, 1, 1, 2])):
                i, k = r.randrange(len(x) + 1), r.randrange(3)
                x = x[:i] + r.choice("ab z") + x[i:] if k == 0 else x[:i] + ("" if k == 1 else r.choice("abz")) + x[i + 1 :]
            lines.append(x)
        docs.append((d if d else None, "\n".join(lines)))
    long = "".join(r.choice("abcdef ") for _ in range(30000))
    docs += [(100, long), (101, long[:15000] + long[15001:])]
    place = [(-1 if d is None else d, i, x) for d, t in docs for i, x in enumerate(t.split("\n")) if x.strip(" \t\x0b\f\r")]
    want = []
    for d, i, x in place:
        equal = min((e, j) for e, j, y in place if y == x)
        near = [(e, j) for e, j, y in place if abs(len(x) - len(y)) < 2 and max(len(x), len(y)) >= 4 and one_edit(x, y)]
        kept = min([equal, *near])
        if (d, i) > kept:
            want.append((d, i, *kept, int(kept < equal)))
    got = line_dedup.dropped_lines(spark.createDataFrame(docs, SCHEMA)).collect()
    assert sorted((-1 if x[0] is None else x[0], x[1], -1 if x[2] is None else x[2], x[3], x[4]) for x in got) == sorted(want)


@pytest.fixture(scope="module")
def repeats(spark):
    r = random.Random(4)
    words = [f"{a}{b}" for a in "bcdfglmn" for b in ("ar", "el", "is", "on", "um", "é")]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage, other, docs = prose(40), prose(25), []
    for i in range(120):
        t = prose(r.randrange(0, 120))
        if r.random() < 0.5:
            t += " " + passage + " " + prose(r.randrange(30))
        if r.random() < 0.2:
            t = other + "\n" + t + "  " + other
        docs.append((i if i % 40 else None, docs[-1][1] if docs and r.random() < 0.1 else t))
    docs += [(7, "x" * 900), (8, ""), (9, None), (3, docs[3][1]), (3, docs[3][1])]
    return docs, spark.createDataFrame(docs, SCHEMA).repartition(4)


@pytest.mark.parametrize("few_runs", [1000, 20])
def test_bytes(repeats, few_runs):
    """With 20 runs the passage's minimisers go by windows."""
    docs, df = repeats
    raw = [(i, (x or "").encode()) for i, x in docs]
    count = Counter(b[k : k + 100] for _, b in raw for k in range(len(b) - 99))
    want = Counter()
    for i, b in raw:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 99):
            if count[b[k : k + 100]] > 1:
                gone[k : k + 100] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        want[(i, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())] += 1
    got = suffix_dedup.remove_repeated_bytes(df, 100, few_runs).drop("kept").collect()
    assert Counter(map(tuple, got)) == want


@pytest.mark.parametrize("few_runs", [1000, 20])
def test_words(repeats, few_runs):
    docs, df = repeats
    order = {(x["doc_id"], x["text"]): x["h"] for x in df.selectExpr("doc_id", "text", "xxhash64(coalesce(text, '')) as h").collect()}
    at = lambda i, x: (-math.inf if i is None else i, order[i, x])
    words = [(i, x, (x or "").encode().split()) for i, x in docs]
    first = {}
    for i, x, w in words:
        for k in range(len(w) - 19):
            key = tuple(w[k : k + 20])
            first[key] = min(first.get(key, (math.inf,)), (*at(i, x), k))
    want = Counter()
    for i, x, w in words:
        gone = {j for k in range(len(w) - 19) if first[tuple(w[k : k + 20])] < (*at(i, x), k) for j in range(k, k + 20)}
        want[(i, len(w), len(gone), hashlib.sha256(b" ".join(y for k, y in enumerate(w) if k not in gone)).hexdigest())] += 1
    got = substring_dedup.remove_repeats(df, 20, few_runs).drop("kept_text").collect()
    assert Counter(map(tuple, got)) == want


def test_suffixes_are_in_order():
    r = random.Random(1)
    data = np.frombuffer(bytes(r.choice(b"ab") for _ in range(4000)), np.uint8)
    starts = np.arange(len(data) - 9)
    at, cut = suffix_dedup.equal_suffixes(data, starts, 10)
    told = [data[i : i + 10].tobytes() for i in at]
    count = Counter(data[k : k + 10].tobytes() for k in starts)
    assert told == sorted(told) and Counter(told) == {k: v for k, v in count.items() if v > 1} and len(cut) == len(set(told))


def test_slots_agree_both_ways(spark):
    item = "In 12 days Anna walked 30 km along the old river road to find her lost brother"
    rows = [(1, item), (2, item.replace("12", "15").replace("30", "41")), (3, item.replace("30 km", "12 km"))]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted(x["doc_id"] for x in decontamination.leaks(spark.createDataFrame(rows, SCHEMA), bench).collect()) == [1, 2]
    twice = spark.createDataFrame([(1, item.replace("30", "12"))], "item_id long, text string")
    assert [x["doc_id"] for x in decontamination.leaks(spark.createDataFrame(rows, SCHEMA), twice).collect()] == [3]


def test_license_recall(spark):
    """Every template is found whole, at 75 % of its shingles, and nothing below is told."""
    r = random.Random(2)
    fill = lambda n: [f"w{r.randrange(10**6)}" for _ in range(n)]
    rows, want = [], set()
    for name, ts in license_scan.TEMPLATES.items():
        for t in ts:
            w = license_scan._words_of(t)
            for k in range(6):
                rows.append((len(rows), " ".join(fill(r.randrange(60)) + w + fill(r.randrange(60)))))
                want.add((rows[-1][0], name))
            s = len(w) - 4
            cut = s // 4
            if cut:  # words at the end go, and with them as many shingles
                rows.append((len(rows), " ".join(fill(30) + w[: len(w) - cut] + fill(30))))
                want.add((rows[-1][0], name))
            if s - cut > 1:
                rows.append((len(rows), " ".join(fill(30) + w[: 4 + math.ceil(0.75 * s) - 1] + fill(30))))
    got = {(x["doc_id"], x["license"]) for x in license_scan.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(want & got) >= 0.9 * len(want)
    missed = want - got
    assert not missed, missed


def test_binomial(spark):
    def exact(n, k, p):
        terms = [math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p) + (n - j) * math.log1p(-p) for j in range(k + 1)]
        return max(terms) + math.log(sum(math.exp(t - max(terms)) for t in terms))

    rows = [(n, k) for n in (1, 5, 100, 1000, 50_000, 10_000_000) for k in (0, 1, 3, 100, 240, 30_000) if k < 0.005 * n]
    d = spark.createDataFrame(rows, "n long, k long")
    for x in d.select("n", "k", quality_rules._log_cdf(F.col("n"), F.col("k"), 0.005).alias("v")).collect():
        want = exact(x["n"], x["k"], 0.005)
        assert abs(x["v"] - want) < 1e-6 * max(1, abs(want))
