"""A large group of near copies and what is left just outside it: nothing meets the whole group."""

import random

import pytest

from docketlake.llm import jaccard_join
from test_jaccard_brute import components_of, shingles


def variants(r, base, n, edits, vocab):
    out = []
    for _ in range(n):
        w = list(base)
        for at in r.sample(range(len(w)), r.choice(edits)):
            kind = r.randrange(3)
            w[at : at + (kind != 2)] = [r.choice(vocab)] * (kind != 1)  # changed, left out, put in
        out.append(" ".join(w))
    return out


def test_group(spark, monkeypatch):
    r = random.Random(7)
    vocab = [f"v{i}" for i in range(3000)]
    base = [f"w{i}" for i in range(150)]
    texts = [" ".join(base)]
    for k in [1, 2, 2, 3, 3, 4, 4, 4, 4] * 28:
        w = list(base)
        for at in r.sample(range(len(w)), k):
            w[at] = r.choice(vocab)
        texts.append(" ".join(w))
    rows = list(enumerate(texts))
    compared = []
    linked = jaccard_join._linked
    monkeypatch.setattr(jaccard_join, "_linked", lambda pairs, sets: compared.append(pairs.count()) or linked(pairs, sets))
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    of = components_of(rows)
    assert sorted((x["doc_id"], x["n_shingles"], x["component_id"]) for x in got) == sorted((d, len(shingles(t)), of[d, t]) for d, t in rows)
    assert compared[-1] < 2 * len(rows), compared


@pytest.mark.parametrize("seed", [1, 2])
def test_beside(spark, monkeypatch, seed):
    """Every open list as a long one, with groups of many sizes, close groups, and other texts."""
    monkeypatch.setattr(jaccard_join, "LONG", 1)
    monkeypatch.setattr(jaccard_join, "LEAST_TURNS", 1)
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    rows = []
    for size in [6, 9, 15, 30, 30, 60, 200]:
        base = [r.choice(vocab) for _ in range(size)]
        near = [r.choice(vocab) if r.random() < 4 / size / 2 else w for w in base]
        for b in (base, near, base[: size * 4 // 5]):
            rows += variants(r, b, 12, [0, 1, 1, 2, 3], vocab[:40])
    rows = list(enumerate(rows))
    of = components_of(rows)
    seen = []
    beside = jaccard_join._beside

    def spy(*args):
        links, pairs = beside(*args)
        seen.append((links.count(), pairs.count()))
        return links, pairs

    monkeypatch.setattr(jaccard_join, "_beside", spy)
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert sorted((x["doc_id"], x["n_shingles"], x["component_id"]) for x in got) == sorted((d, len(shingles(t)), of[d, t]) for d, t in rows)
    assert seen and sum(seen[0]) > 0
