"""Super-k-mers: what the exact substring operators share.

A sequence (words, or bytes) is cut into runs of consecutive windows with the same minimiser,
the gram of least hash in each window. Equal windows have equal minimisers, so a run can hold
a repeated window only if its minimiser occurs more than once in the corpus. Those runs alone
travel, each as one packed string, to the bucket of their minimiser.

Steps: minimisers of all texts -> minimisers with several occurrences -> packed strings of
their runs, equal ones of a task merged -> windows compared in each bucket -> covered spans
of each document. A group of copies thus sends one string for each task and run, whatever
its size; tasks stream, and a bucket is worked off in groups of whole minimisers.

A minimiser that alone would outweigh a task (a passage that very many documents share has as
many different runs as neighbours) gets no bucket. Its windows travel one by one under two
64-bit names, are counted by partial sums, and meet their counts in a join that can be split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept_table, lean

_MASK = np.uint64((1 << 24) - 1)
PIECE = 1 << 21
NO_ID = -(1 << 63)
#: Bytes of packed strings that a task merges before it passes them on.
MERGE_BYTES = 24 << 20
BUCKET_BYTES = 3 << 20
#: A minimiser of more runs than the mean task has, within these bounds, goes by windows.
FEW_RUNS, MANY_RUNS = 1000, 200_000

def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    p = 1
    while 2 * p <= width:
        x = np.minimum(x[:-p], x[p:])
        p *= 2
    return np.minimum(x[: len(x) - (width - p)], x[width - p :]) if width > p else x


def runs_of(grams: np.ndarray, valid: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, first window, end, occurrences) of each run; valid: places where windows start.

    The key holds the hash's upper bits and the place, so the least is the leftmost of equals.
    """
    key = (grams & ~_MASK) | np.arange(len(grams), dtype=np.uint64)
    at = (sliding_min(key, width) & _MASK).astype(np.int64)[valid]
    mini = grams[at]
    new = np.r_[True, (mini[1:] != mini[:-1]) | (valid[1:] != valid[:-1] + 1)]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(valid)] - 1
    moved = np.cumsum(np.r_[0, at[1:] != at[:-1]])
    return mini[first].view(np.int64), valid[first], valid[last] + 1, moved[last] - moved[first] + 1


class Kind:
    """How a text becomes units, grams and packed strings; see the two operators.

    units: the units of a text; join: parts put together, as grams takes them; grams: a hash of
    the gram at each place; marks: a name of the window at each place; pack: some units as one
    string; repeated: (string, first window, end) of the windows that are covered.
    """

    window: int
    gram: int
    first_stays: bool

    def units(self, text: bytes):
        raise NotImplementedError

    def join(self, parts: list) -> np.ndarray:
        raise NotImplementedError

    def grams(self, units: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def marks(self, units: np.ndarray, seed: int) -> np.ndarray:
        raise NotImplementedError

    def pack(self, units, a: int, b: int) -> bytes:
        raise NotImplementedError

    def repeated(self, strings: list[bytes], where: list[tuple]) -> Iterator[tuple[int, int, int]]:
        raise NotImplementedError


def minimisers(kind: Kind, docs: DataFrame) -> DataFrame:
    """mini, _d, _h, a, b, n: the runs of every text."""
    k, width = kind.window, kind.window - kind.gram + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, h, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
            pending: list[tuple[int, int, object]] = []
            size = 0
            for i in range(batch.num_rows + 1):
                if i == batch.num_rows or size >= PIECE:
                    if pending:
                        yield from emit(pending, d, h)
                    pending, size = [], 0
                if i < batch.num_rows:
                    u = kind.units(texts[i].as_py())
                    for a in range(0, max(1, len(u) - k + 1), PIECE):  # very long texts in overlapping pieces
                        part = u[a : a + PIECE + k - 1] if len(u) > PIECE + k - 1 else u
                        if len(part) >= k:
                            pending.append((i, a, part))
                            size += len(part)
                        if size >= 2 * PIECE:
                            yield from emit(pending, d, h)
                            pending, size = [], 0

    def emit(pending, d, h):
        sizes = np.array([len(p) for _, _, p in pending], dtype=np.int64)
        first = np.cumsum(sizes) - sizes
        grams = kind.grams(kind.join([p for _, _, p in pending]))
        n = sizes - k + 1
        owner = np.repeat(np.arange(len(pending)), n)
        valid = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        mini, a, b, occ = runs_of(grams, valid, width)
        who = owner[np.searchsorted(valid, a)]
        doc = np.array([i for i, _, _ in pending])[who]
        shift = np.array([s for _, s, _ in pending], dtype=np.int64)[who] - first[who]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (mini, d[doc], h[doc], a + shift, b + shift, occ.astype(np.int64))], ["mini", "_d", "_h", "a", "b", "n"])

    return docs.select("_d", "_h", "_text").mapInArrow(lean(run), "mini long, _d long, _h long, a long, b long, n long")


_MOVED = "mini long, packed binary, _d long, _h long, a long, b long"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["mini", "packed", "_d", "_h", "a", "b"])


class _Merged:
    """Equal packed strings met so far. A span is told as soon as it is known to be covered.

    If the first occurrence stays, the earliest place of a string goes on and all later ones
    are covered; else all are covered once a string was met twice, and it goes on without one.
    """

    def __init__(self, first_stays: bool):
        self.first_stays, self.at, self.size = first_stays, {}, 0

    def add(self, mini: int, packed: bytes, place: tuple | None, told: list[tuple]) -> None:
        key = (mini, packed)
        if key not in self.at:
            self.at[key] = place
            self.size += len(packed) + 200
            return
        old = self.at[key]
        if self.first_stays:
            if place[:3] == old[:3]:
                return
            if place < old:
                self.at[key], place = place, old
            told.append((None, None, *place))
        else:
            told += [(None, None, *p) for p in (old, place) if p]
            self.at[key] = None

    def rows(self) -> list[tuple]:
        return [(m, s, *(p or (None,) * 4)) for (m, s), p in self.at.items()]


def _moved(kind: Kind, joined: DataFrame) -> DataFrame:
    k = kind.window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged, told = _Merged(kind.first_stays), []
        for batch in batches:
            d, h = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i in range(batch.num_rows):
                u = kind.units(batch.column(2)[i].as_py())
                for s in batch.column(3)[i].as_py():
                    merged.add(s["mini"], kind.pack(u, s["a"], s["b"] + k - 1), (d[i], h[i], s["a"], s["b"]), told)
                if merged.size > MERGE_BYTES:
                    yield _batch(merged.rows())
                    merged = _Merged(kind.first_stays)
                if len(told) > 20000:
                    yield _batch(told)
                    told = []
        yield _batch(told + merged.rows())

    return joined.mapInArrow(lean(run), _MOVED)


def _compared(kind: Kind, moved: DataFrame) -> DataFrame:
    """Spans (_d, _h, a, b) that the comparison in the buckets finds covered."""

    def work(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        merged, told = _Merged(kind.first_stays), []
        for mini, packed, *place in rows:
            merged.add(mini, packed, None if place[0] is None else tuple(place), told)
        keys = list(merged.at)
        places = [merged.at[x] for x in keys]
        for i, a, b in kind.repeated([s for _, s in keys], places):
            d, h, start, _ = places[i]
            told.append((None, None, d, h, start + a, start + b))
        if told:
            yield _batch(told).select(["_d", "_h", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, last = [], 0, None
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if size > BUCKET_BYTES and row[0] != last:
                    yield from work(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[1])
                last = row[0]
        if rows:
            yield from work(rows)

    dealt = moved.where("mini is not null").repartition("mini").sortWithinPartitions("mini")
    return dealt.mapInArrow(lean(run), "_d long, _h long, a long, b long")


def prepared(docs: DataFrame) -> DataFrame:
    """doc_id, _d and _h (order of documents: id with null first, then a hash of the text), _text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_d"), F.xxhash64(text).alias("_h"), text.cast("binary").alias("_text"))


def _by_window(kind: Kind, joined: DataFrame) -> DataFrame:
    """Spans (_d, _h, a, b) that are covered among the windows of hot minimisers."""
    k = kind.window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                u = kind.units(batch.column(2)[i].as_py())
                for s in batch.column(3)[i].as_py():
                    part = kind.join([u[s["a"] : s["b"] + k - 1]])
                    n = s["b"] - s["a"]
                    yield pa.RecordBatch.from_arrays([*[pa.array(kind.marks(part, seed).view(np.int64)) for seed in (0, 1)], pa.repeat(batch.column(0)[i], n), pa.repeat(batch.column(1)[i], n), pa.array(np.arange(s["a"], s["b"]))], ["f", "g", "_d", "_h", "a"])

    rows = kept_table(joined.mapInArrow(lean(run), "f long, g long, _d long, _h long, a long"), "windows")
    first = F.min(F.struct("_d", "_h", "a")).alias("first")
    groups = kept_table(rows.groupBy("f", "g").agg(first, F.count("*").alias("n")).where("n > 1").select("f", "g", "first"), "counts")
    met = rows.join(groups, ["f", "g"])
    if kind.first_stays:
        met = met.where(F.struct("_d", "_h", "a") > F.col("first"))
    return met.select("_d", "_h", "a", (F.col("a") + 1).alias("b")).distinct()


def covered_spans(kind: Kind, own: DataFrame, few_runs: int = FEW_RUNS) -> DataFrame:
    """_d, _h, spans: the windows of each document that the operator removes, as [a, b) runs of
    window starts, of every document that has any."""
    runs = kept_table(minimisers(kind, own), "minimisers")
    often = kept_table(runs.groupBy("mini").agg(F.sum("n").alias("n"), F.count("*").alias("runs")).where("n > 1").select("mini", "runs"), "often")
    tasks = int(own.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mean = (often.agg(F.sum("runs")).first()[0] or 0) // tasks
    hot = F.col("runs") > min(MANY_RUNS, max(few_runs, mean))
    found = runs.join(often, "mini").groupBy("_d", "_h", hot.alias("hot")).agg(F.collect_set(F.struct("mini", "a", "b")).alias("runs"))
    found = kept_table(found, "runs")
    joined = lambda which: own.join(found.where(which).drop("hot"), ["_d", "_h"]).select("_d", "_h", "_text", "runs")
    moved = kept_table(_moved(kind, joined("not hot")), "packed")
    told = moved.where("mini is null").select("_d", "_h", "a", "b")
    spans = told.unionByName(_compared(kind, moved))
    if not found.where("hot").isEmpty():
        spans = spans.unionByName(_by_window(kind, joined("hot")))
    return kept_table(spans.groupBy("_d", "_h").agg(F.collect_list(F.struct("a", "b")).alias("spans")), "spans")


def covered(spans: list[dict] | None, n: int, window: int) -> np.ndarray:
    """Which of n units any span covers."""
    delta = np.zeros(n + 1, dtype=np.int32)
    if spans:
        a = np.array([s["a"] for s in spans], dtype=np.int64)
        b = np.array([s["b"] for s in spans], dtype=np.int64) + window - 1
        np.add.at(delta, a, 1)
        np.add.at(delta, b, -1)
    return np.cumsum(delta[:n]) > 0
