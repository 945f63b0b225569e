"""Edge cases of every operator and brute-force versions on a small table."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from docketlake.llm import decontamination, jaccard_join, license_scan, line_dedup, mixing, quality_crf, quality_rules, substring_dedup, suffix_dedup, token_output

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, label string, at string, copy string"


def texts():
    r = random.Random(5)
    words = [f"{a}{b}" for a in "bcdfglmn" for b in ("ar", "el", "is", "on", "um", "é")]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    base, passage = prose(120), prose(60)
    lone = base.split()
    lone[50] = "changed"
    return [base, base, " ".join(lone), prose(80) + "\n" + passage, passage + "\n" + prose(90), "", None, "one two", "word " * 120, prose(3000), "Licensed under CC BY-NC 4.0.\n" + prose(30), passage + " tail"]


@pytest.fixture(scope="module")
def docs(spark):
    ids = [3, 4, 5, 6, 7, 8, 9, 10, 11, 12, None, None]
    rows = [(i, t, "en", "s" if k % 3 else None, 0, 1, "x", "y", "z") for k, (i, t) in enumerate(zip(ids, texts(), strict=True))]
    return spark.createDataFrame([*rows, rows[3]], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(docs):
    return sorted(((r["doc_id"] if r["doc_id"] is not None else -1, r["text"] or "") for r in docs.collect()), key=lambda x: x[0])


def test_elias_fano():
    for v in ([0], [0, 0, 5], sorted(random.Random(1).randrange(1 << 40) for _ in range(5000)), list(range(1000))):
        ef = token_output.EliasFano.from_bytes(token_output.EliasFano.build(np.array(v)).to_bytes())
        assert ef.select(np.arange(len(v))).tolist() == v
        assert ef.select(len(v) - 1)[0] == v[-1]


def test_tokens(spark, docs, none):
    got = token_output.token_output(spark, docs).collect()
    from tokenizers import Tokenizer
    import public_tokenizers

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter((i, zlib.crc32(np.array(t.encode(x, add_special_tokens=False).ids + [2], "<u4").tobytes())) for i, x in plain(docs))
    assert Counter((-1 if r["doc_id"] is None else r["doc_id"], r["ids_crc32"]) for r in got) == want
    assert sorted(r["start"] for r in got)[0] == 0 and token_output.token_output(spark, none).count() == 0


def test_word_repeats(docs, none):
    seen, want = {}, Counter()
    rows = plain(docs)
    for i, x in rows:
        w = x.encode().split()
        for k in range(len(w) - 19):
            seen.setdefault(b" ".join(w[k : k + 20]), []).append((i, k))
    got = substring_dedup.remove_repeats(docs).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add((r["n_words"], r["n_removed"], r["kept_sha256"]))
    for i, x in rows:
        if i in (-1, 6):  # ties of ids are in the docstring
            continue
        w = x.encode().split()
        gone = set()
        for k in range(len(w) - 19):
            if seen[b" ".join(w[k : k + 20])] and min(seen[b" ".join(w[k : k + 20])]) < (i, k):
                gone |= set(range(k, k + 20))
        kept = b" ".join(y for k, y in enumerate(w) if k not in gone)
        assert by[i] == {(len(w), len(gone), hashlib.sha256(kept).hexdigest())}
    assert len(got) == len(rows) and substring_dedup.remove_repeats(none).count() == 0


def test_byte_repeats(docs, none):
    rows = plain(docs)
    count = Counter(x.encode()[k : k + 100] for _, x in rows for k in range(len(x.encode()) - 99))
    got = Counter((-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], r["kept_sha256"]) for r in suffix_dedup.remove_repeated_bytes(docs, 100).collect())
    want = Counter()
    for i, x in rows:
        b, gone = x.encode(), np.zeros(len(x.encode()), bool)
        for k in range(len(b) - 99):
            if count[b[k : k + 100]] > 1:
                gone[k : k + 100] = True
        want[(i, len(b), int(gone.sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())] += 1
    assert got == want and suffix_dedup.remove_repeated_bytes(none).count() == 0


def test_jaccard(docs, none):
    got = jaccard_join.jaccard_components(docs)
    by = {r["doc_id"]: r["component_id"] for r in got.collect() if r["doc_id"] is not None}
    assert by[3] == by[4] == by[5] == 3 and by[7] == 7 and by[8] == 8 and by[9] == 9 and by[6] == 6
    kept = [r["doc_id"] for r in jaccard_join.keep_one(docs).collect()]
    assert 4 not in kept and 5 not in kept and kept.count(6) == 1 and {8, 9} <= set(kept)
    assert jaccard_join.jaccard_components(none).count() == 0


def test_lines(spark, none):
    rows = [(1, "a line of more than twenty letters\nshort\nshort"), (2, "a line of more than twenty lettrs\nshorts"), (None, ""), (3, None)]
    d = spark.createDataFrame([(i, t, "", "", 0, 0, "", "", "") for i, t in rows], SCHEMA)
    got = {(r["doc_id"], r["line_no"], r["kept_doc_id"], r["kept_line_no"], r["edits"]) for r in line_dedup.dropped_lines(d).collect()}
    assert got == {(1, 2, 1, 1, 0), (2, 0, 1, 0, 1), (2, 1, 1, 1, 1)} and line_dedup.dropped_lines(none).count() == 0


def test_licenses(docs, none):
    assert [(r["doc_id"], r["license"]) for r in license_scan.scan(docs).collect()] == [(None, "CC-BY-NC-4.0")]
    assert license_scan.scan(none).count() == 0


def test_leaks(spark, none):
    item = "In 12 days Anna walked 30 km along the old river road to find her lost brother"
    other = item.replace("12", "15").replace("Anna", "Paul").replace("30", "41")
    clash = item.replace("30 km along", "12 km along")
    bench = spark.createDataFrame([(1, item), (2, None), (3, "too short")], "item_id long, text string")
    d = spark.createDataFrame([(i, t, "", "", 0, 0, "", "", "") for i, t in ((1, "Before it. " + item), (2, other + " after"), (3, "nothing of the kind stands in this text at all"), (None, None))], SCHEMA)
    assert sorted(r["doc_id"] for r in decontamination.leaks(d, bench).collect()) == [1, 2]
    assert sorted(r["doc_id"] or 0 for r in decontamination.decontaminate(d, bench).collect()) == [0, 3]
    assert decontamination.leaks(none, bench).count() == 0 and clash != item


def test_mixing(docs, none, spark):
    a = mixing.mix_sources(docs, size=3.0).select("doc_id", "copy", "shuffle_key").collect()
    assert [r["shuffle_key"] for r in a] == sorted(r["shuffle_key"] for r in a)
    w = spark.createDataFrame([("s", 1.0)], "source string, weight double")
    assert {r["source"] for r in mixing.mix_sources(docs, w).select("source").collect()} <= {"s"}
    assert mixing.mix_sources(none).count() == 0


def test_quality_rules(spark, docs, none):
    labels = spark.createDataFrame([(3, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = [(r["n_words"], r["n_repeat_words"], r["base_failed"]) for r in quality_rules.quality_rules(docs, labels).collect()]
    assert len(got) == 13 and (120, 120, True) in got and (0, 0, True) in got and (2, 0, True) in got and (120, 0, False) in got
    assert quality_rules.quality_rules(none, labels).count() == 0


def test_crf(docs, none):
    good = ["This is a line of prose, and it ends.\nAnother line follows it."] * 30
    bad = ["### $$$ %%% &&&\n*** ### |||"] * 30
    model = quality_crf.fit(good + bad, np.array([1.0] * 30 + [0.0] * 30), steps=40)
    s = model.score([good[0], bad[0], "", "\n\n"])
    assert s[0] > 0.5 > s[1] and ((s >= 0) & (s <= 1)).all()
    assert quality_crf.score_documents(docs, model).count() == 13 and quality_crf.score_documents(none, model).count() == 0


def test_leaks_at_every_place(spark):
    words = "the slow river bends twice below an old mill".split()
    items = {n: " ".join(words[:n]) for n in (3, 5, 8, 9)} | {2: "old mill", 10: "seven grey horses crossed that wide field before any rain"}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    rows = [(100 * n + k, " ".join(["filler"] * k + [items[n]] + ["more"] * 9)) for n in items for k in range(4)]
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(spark.createDataFrame([*rows, (7, "river bends")], "doc_id long, text string"), bench).collect()}
    held = lambda n, k: {m for m in items if m > 2 and (items[m] in items[n] or (n, m) == (8, 9))}
    assert got == {(100 * n + k, m) for n in items for k in range(4) for m in held(n, k)}
