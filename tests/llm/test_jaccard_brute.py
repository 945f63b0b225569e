"""The Jaccard join against all pairs, on sets of every size class and similarities around 0.75."""

import random

import pytest

from docketlake.llm import jaccard_join


def shingles(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components_of(rows):
    """Smallest place of each row's component; rows: (id, text)."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    out = {}
    for i, x in enumerate(rows):
        out.setdefault(x, find(i))
    return out


@pytest.mark.parametrize("bits", [64, 6])
def test_components(spark, bits):
    """With names of 6 bits nearly all sets collide and are told apart by the second hash."""
    r = random.Random(4)
    vocab = [f"w{i}" for i in range(400)]
    bases = [[r.choice(vocab) for _ in range(r.choice([3, 4, 5, 6, 12, 30, 60, 200, 900]))] for _ in range(30)]
    rows = []
    for i in range(260):
        w = list(r.choice(bases))
        for _ in range(r.choice([0, 0, 1, 1, 2, 3, 5])):
            w[r.randrange(len(w))] = r.choice(vocab)
        rows.append((i if i % 50 else None, " ".join(w).upper() if i % 10 == 0 else " ".join(w)))
    rows += [(1000, ""), (1001, None), (1002, " \n"), (5, rows[5][1]), (5, rows[6][1])]
    of = components_of(rows)
    least = {}
    for x in rows:
        if x[0] is not None:
            least[of[x]] = min(least.get(of[x], x[0]), x[0])
    want = sorted((str(d), len(shingles(t)), str(least.get(of[d, t]) if shingles(t) else d)) for d, t in rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = jaccard_join.jaccard_components(docs, bits).collect()
    assert sorted((str(x["doc_id"]), x["n_shingles"], str(x["component_id"])) for x in got) == want
