"""The last step moves the sets that it needs, not all sets."""

from docketlake.llm import jaccard_join


def test_pivots(spark, monkeypatch):
    sets = spark.range(2000).selectExpr("id as sid", "array(id, id + 100000, id + 200000, 1L) as els")
    rows = [(7, s, 5 if s < 15 else s, 4, 10, 5, True) for s in range(10, 20)]
    rest = spark.createDataFrame(rows, "sig long, sid long, label long, n long, central long, main long, long boolean")
    frame, moved = type(rest), []
    join = frame.join

    def spy(self, other, *args, **more):
        if {"sid", "ep"} <= set(other.columns):
            moved.append(other.count())
        return join(self, other, *args, **more)

    monkeypatch.setattr(frame, "join", spy)
    jaccard_join._beside(rest, sets)
    assert moved and moved[0] < 20, moved
