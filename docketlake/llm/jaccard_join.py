"""Exact Jaccard self-join on word shingles: a size-aware heavy-light join.

Equal sets collapse first. A set whose partner must share ``need`` of its n shingles can only
have one if enough of its first shingles (in the order of their hashes) occur in other sets;
the rest of the sets leave. What remains is ordered by document frequency, rarest first, and
split by size at a boundary chosen by cost:

- small sets enumerate the fixed-size subsets (pairs of shingles) of their prefix; similar
  sets have at least two prefix shingles in common, so they share a subset;
- large sets are found by scanning the inverted lists of their prefix shingles, of which
  similar sets share at least one.

Sets near the boundary do both. In every list, sets are first compared with one pivot; then
only sets that are still in different components are compared, so a group of near copies costs
a few comparisons for each set. What near copies of a group are then left outside its component
is told from the group by what each set has other than the group's pivot (see ``_beside``), so
that nothing is compared with the whole group. Comparisons are exact intersections. Shingles are known by
64-bit hashes, which two sets that are compared would have to share by chance; sets whose 64-bit
names agree are told apart by a second hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, kept_table, lean, parted, sieved, table
from .substring_dedup import _combined, hashed
from .superkmers import NO_ID, mix

SHINGLE = 5
PERCENT = 75
#: Shingles beyond the first that must be shared by the first test; see ``_prefix``.
EXTRA = 32
FLUSH = 1 << 20
_RATIO = 1.25
#: A posting costs as many comparisons as its list has sets, up to this: longer lists are
#: settled by their pivot.
SCAN = 16
#: Open lists are compared with one pivot each, at least so many turns, until what is left open
#: takes no more comparisons than there are postings, or a turn leaves more than this share open.
LEAST_TURNS, GAIN = 2, 0.75
#: Open lists of more sets than this, half of them of one component, are not gone through pair by pair.
LONG = 64
_SALT = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text: A-Z in lower case, words by ASCII
    white space; a text of fewer words than a shingle is one shingle."""
    words = text.lower().split()  # bytes.lower changes A-Z alone
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = hashed(words)
    return np.unique(_combined(h, SHINGLE) if len(h) >= SHINGLE else _combined(h ^ np.uint64(len(h)), len(h)))


def _set_ids(s: np.ndarray, bits: int = 64) -> tuple[int, int]:
    """Two independent names of a set; the first is cut to ``bits``."""
    if not len(s):
        return 0, 0
    i = mix(s ^ _SALT) * (np.arange(len(s), dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    j = mix(s + _SALT) * (np.arange(len(s), dtype=np.uint64) * np.uint64(2) + np.uint64(3))
    one, two = mix(np.array([i.sum(dtype=np.uint64) ^ np.uint64(len(s)), j.sum(dtype=np.uint64)], dtype=np.uint64))
    return int((one >> np.uint64(64 - bits)).view(np.int64)), int(two.view(np.int64))


class Names:
    """Names of sets: the first hash, or the second for the few sets whose first hash is that of
    another set as well (about n^2 / 2^65 of n sets)."""

    def __init__(self, bits: int = 64, taken: frozenset[tuple[int, int]] = frozenset()):
        self.bits, self.taken = bits, taken

    def __call__(self, s: np.ndarray) -> int:
        ids = _set_ids(s, self.bits)
        return ids[ids in self.taken]


def _need(n: int) -> int:
    return -(-PERCENT * n // 100)


def _prefix(n: int) -> int:
    """Two sets that share ``need`` elements share at least EXTRA of their first n - need +
    EXTRA ones (all, if there are fewer)."""
    return min(n, n - _need(n) + EXTRA)


def features(own: DataFrame, bits: int = 64) -> tuple[DataFrame, Names]:
    """_d, _h, sid, n of every document, and how sets are named."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [(*_set_ids(s, bits), len(s)) for s in (shingles(t.as_py()) for t in batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array([x[i] for x in ids], pa.int64()) for i in range(3)]], ["_d", "_h", "sid", "check", "n"])

    found = kept_table(own.select("_d", "_h", "_text").mapInArrow(lean(run), "_d long, _h long, sid long, check long, n long"), "features")
    twice = found.where("n > 0").groupBy("sid").agg(F.min("check").alias("lo"), F.max("check").alias("hi")).where("lo <> hi")
    taken = found.where("n > 0").join(twice, "sid").where("check <> lo").select("sid", "check").distinct().collect()
    if taken:
        renamed = spark_rows(found.sparkSession, taken)
        found = found.join(renamed, ["sid", "check"], "left").withColumn("sid", F.when(F.col("_taken"), F.col("check")).otherwise(F.col("sid"))).drop("_taken")
    return found.drop("check"), Names(bits, frozenset((r["sid"], r["check"]) for r in taken))


def spark_rows(spark: SparkSession, taken: list) -> DataFrame:
    return spark.createDataFrame([(r["sid"], r["check"], True) for r in taken], "sid long, check long, _taken boolean")


def _cuts(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal values."""
    cut = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, int)
    return cut, np.r_[cut[1:], len(x)][: len(cut)]


def _postings(own: DataFrame, buckets: int, name: Names, prefix: bool) -> DataFrame:
    """bucket, packed: hashes, ids of sets and, without prefix, sizes of sets. Of a prefix only
    half of each hash goes, as its test may find too much but never too little."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hs: list[np.ndarray] = []
        ids: list[tuple[int, int]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            h = np.concatenate(hs)
            times = [len(x) for x in hs]
            parts = [np.repeat(np.array(ids, dtype=np.int64)[:, 0], times)]
            if not prefix:
                parts.append(np.repeat(np.array(ids, dtype=np.int64)[:, 1], times).astype(np.int32))
            bucket = (mix(h) % np.uint64(buckets)).astype(np.int64)
            return _packed(bucket, [(h >> np.uint64(32)).astype(np.uint32) if prefix else h, *parts])

        for batch in batches:
            for t in batch.column(0):
                s = shingles(t.as_py())
                if len(s) > 1:
                    ids.append((name(s), len(s)))
                    hs.append(s[: _prefix(len(s))] if prefix else s)
                    size += len(hs[-1])
                if size > FLUSH:
                    yield flush()
                    hs, ids, size = [], [], 0
        if hs:
            yield flush()

    return own.select("_text").mapInArrow(lean(run), "bucket long, packed binary")


def _unpacked(held: list[bytes], kinds: list) -> list[np.ndarray]:
    width = sum(np.dtype(k).itemsize for k in kinds)
    out = []
    for i, k in enumerate(kinds):
        before = sum(np.dtype(x).itemsize for x in kinds[:i])
        out.append(np.concatenate([np.frombuffer(x, k, len(x) // width, before * (len(x) // width)) for x in held]))
    return out


def _whole_buckets(postings: DataFrame, work, schema: str) -> DataFrame:
    """work gets the packed values of each whole bucket of a task, one bucket after the other."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
        held: list[bytes] = []
        last = None
        for batch in batches:
            for b, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if b != last and held:
                    yield held
                    held = []
                last = b
                held.append(x.as_py())
        if held:
            yield held

    return postings.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lean(lambda batches: work(groups(batches))), schema)


def _lists(held: list[bytes], kinds: list) -> list[np.ndarray]:
    """Distinct postings of shingles in several sets, and the number of those sets."""
    h, who, *rest = _unpacked(held, kinds)
    order = np.lexsort((who, h))
    h, who, rest = h[order], who[order], [x[order] for x in rest]
    fresh = np.r_[True, (h[1:] != h[:-1]) | (who[1:] != who[:-1])]
    h, who, rest = h[fresh], who[fresh], [x[fresh] for x in rest]
    cut, end = _cuts(h)
    df = np.repeat(end - cut, end - cut)
    return [x[df > 1] for x in (h, who, *rest, df.astype(np.int32))]


def _shared_counts(groups: Iterator[list[bytes]]) -> Iterator[pa.RecordBatch]:
    def flush(kept: list[np.ndarray]) -> pa.RecordBatch:
        ids, n = np.unique(np.concatenate(kept), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n.astype(np.int64))], ["sid", "shared"])

    kept, size = [], 0
    for held in groups:
        kept.append(_lists(held, [np.uint32, np.int64])[1])
        size += len(kept[-1])
        if size > FLUSH:
            yield flush(kept)
            kept, size = [], 0
    if size:
        yield flush(kept)


def _packed(bucket: np.ndarray, parts: list[np.ndarray]) -> pa.RecordBatch:
    """A row for each bucket: its values of each part, one part after the other."""
    order = np.argsort(bucket, kind="stable")
    bucket, parts = bucket[order], [x[order] for x in parts]
    cut, end = _cuts(bucket)
    return pa.RecordBatch.from_arrays([pa.array(bucket[cut]), pa.array([b"".join(p[x:y].tobytes() for p in parts) for x, y in zip(cut, end, strict=True)], pa.binary())], ["bucket", "packed"])


def _by_set(buckets: int):
    """The postings of shingles in several sets, dealt again by their sets: a task packs what it
    has for a bucket of sets into few rows, however many sets there are."""

    def flush(kept: list[list[np.ndarray]]) -> pa.RecordBatch:
        parts = [np.concatenate(x) for x in zip(*kept, strict=True)]
        return _packed((mix(parts[1].view(np.uint64)) % np.uint64(buckets)).astype(np.int64), parts)

    def work(groups: Iterator[list[bytes]]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        for held in groups:
            kept.append(_lists(held, [np.uint64, np.int64, np.int32]))
            size += len(kept[-1][0])
            if size > FLUSH:
                yield flush(kept)
                kept, size = [], 0
        if size:
            yield flush(kept)

    return work


def _ordered(groups: Iterator[list[bytes]]) -> Iterator[pa.RecordBatch]:
    """sid, n, els (shingles in several sets, rarest first), q1, q2 (their number within the
    prefix for single shingles and for pairs), scan (cost of its lists), central (mean
    frequency: highest for a set that near copies stem from)."""
    for held in groups:
        h, who, size, df = _unpacked(held, [np.uint64, np.int64, np.int32, np.int32])
        order = np.lexsort((h, df, who))
        h, who, size, df = h[order], who[order], size[order], df[order]
        out: list[tuple] = []
        for x, y in zip(*_cuts(who), strict=True):
            n, d = int(size[x]), df[x:y]
            spare = n - _need(n) - (n - int(y - x))
            q1, q2 = max(0, spare + 1), max(0, spare + 2) if n > 1 else 0
            scan = int(np.minimum(d[:q1], SCAN).sum())
            out.append((int(who[x]), n, h[x:y].view(np.int64), int(min(q1, y - x)), int(min(q2, y - x)), scan, int(d.sum(dtype=np.int64) // len(d))))
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        for a in range(0, len(out), 2000):
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out[a : a + 2000]], t) for i, t in enumerate(kinds)], ["sid", "n", "els", "q1", "q2", "scan", "central"])


def boundary(costs: list[tuple[int, float, float]]) -> int:
    """The size up to which sets enumerate subsets. costs: (size class, subsets, postings
    scanned) sums; class c holds sizes from _RATIO ** c on. Pairs with a larger set are left
    to the lists, so sets from PERCENT of the boundary on are scanned too."""
    best, at = None, 0
    tops = [0, *[int(_RATIO ** (c + 1)) for c, _, _ in sorted(costs)]]
    for top in tops:
        cost = sum(pairs for c, pairs, _ in costs if _RATIO**c <= top) + sum(scan for c, _, scan in costs if _RATIO ** (c + 1) > top * PERCENT / 100)
        if best is None or cost < best:
            best, at = cost, top
    return at


def _signatures(sets: DataFrame, top: int) -> DataFrame:
    """sig, light, sid, n, room (shingles that can be shared if these are the first shared
    ones), all (those in any other set), central"""
    names = ["sig", "light", "sid", "n", "room", "all", "central"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig, rooms, meta, size = [], [], [], 0
            lists = batch.column(2)
            values, ends = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
            for k, (sid, n, q1, q2, central) in enumerate(zip(*[batch.column(i).to_pylist() for i in (0, 1, 3, 4, 5)], strict=True)):
                e = values[ends[k] : ends[k + 1]]
                if n <= top and q2 > 1:
                    i, j = np.triu_indices(q2, 1)
                    sig.append(mix(mix(e[i]) * _SALT + e[j]))
                    rooms.append(len(e) - j + 1)
                    meta.append((True, sid, n, len(e), central, len(i)))
                    size += len(i)
                if 100 * n >= PERCENT * (top + 1) and q1:
                    sig.append(e[:q1])
                    rooms.append(len(e) - np.arange(q1))
                    meta.append((False, sid, n, len(e), central, q1))
                    size += q1
                if size > 200_000:
                    yield batch_of(sig, rooms, meta)
                    sig, rooms, meta, size = [], [], [], 0
            if meta:
                yield batch_of(sig, rooms, meta)

    def batch_of(sig, rooms, meta):
        times = [m[5] for m in meta]
        light, sid, n, total, central = (np.repeat(np.array(x), times) for x in list(zip(*meta, strict=True))[:5])
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (np.concatenate(sig).view(np.int64), light, sid, n, np.concatenate(rooms).astype(np.int64), total, central)], names)

    return sets.select("sid", "n", "els", "q1", "q2", "central").mapInArrow(lean(run), "sig long, light boolean, sid long, n long, room long, all long, central long")


def _fit(a: str, b: str, top: int, room: str) -> Column:
    """Sizes and rooms allow the similarity, and the pair is this signature's to find. With
    room, the first shared signature of a similar pair always passes; with all, each one."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    room = F.least(F.col(f"{a}.{room}"), F.col(f"{b}.{room}"))
    return (F.col(f"{a}.light") | (n > top) | (m > top)) & ((100 + PERCENT) * room >= PERCENT * (n + m))


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (x, y) that reach the similarity: exact intersections."""
    ends = pairs.select(F.col("x").alias("key")).union(pairs.select(F.col("y").alias("key")))
    s = sieved(sets.select("sid", "n", "els"), "sid", ends)
    p = pairs.join(s.selectExpr("sid as x", "n as nx", "els as ex"), "x").join(s.selectExpr("sid as y", "n as ny", "els as ey"), "y")
    inter = F.size(F.array_intersect("ex", "ey"))
    return p.where(100 * inter >= PERCENT * (F.col("nx") + F.col("ny") - inter)).select("x", "y")


def components(edges: DataFrame) -> DataFrame:
    """v, label (least vertex reachable) of every vertex with an edge (x, y).

    Each round every vertex takes its least neighbour, or itself, as its parent; the graph is
    then drawn together to the parents, so that edges within a parent are gone and the rounds
    shrink. Each round is a table.
    """
    left = kept_table(edges.select("x", "y").where("x <> y").distinct(), "edges")
    labels = None
    while True:
        ends = left.select(F.inline(F.array(F.struct(F.col("x").alias("v"), F.col("y").alias("w")), F.struct(F.col("y").alias("v"), F.col("x").alias("w")))))
        parents = kept_table(ends.groupBy("v").agg(F.min("w").alias("w")).select("v", F.least("v", "w").alias("label")), "parents")
        up = parents.select(F.col("v").alias("label"), F.col("label").alias("far"))
        parents = kept_table(parents.join(up, "label").select("v", F.col("far").alias("label")), "parents")
        if labels is None:
            labels = parents
        else:
            next_ = parents.select(F.col("v").alias("label"), F.col("label").alias("far"))
            labels = kept_table(labels.join(next_, "label", "left").select("v", F.coalesce("far", "label").alias("label")), "labels")
        of = lambda end: parents.select(F.col("v").alias(end), F.col("label").alias(f"_{end}"))
        drawn = left.join(of("x"), "x").join(of("y"), "y").select(F.least("_x", "_y").alias("x"), F.greatest("_x", "_y").alias("y"))
        left = kept_table(drawn.where("x <> y").distinct(), "edges")
        if left.isEmpty():
            return labels


def joined_components(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """The labels after more links (x, y): only what the links join is gone through again."""
    if labels is None:
        return components(links)
    of = lambda end: labels.select(F.col("v").alias(end), F.col("label").alias(f"_{end}"))
    drawn = kept_table(links.join(of("x"), "x", "left").join(of("y"), "y", "left").select(F.coalesce("_x", "x").alias("x"), F.coalesce("_y", "y").alias("y")).where("x <> y"), "drawn")
    if drawn.isEmpty():
        return labels
    more = components(drawn)
    new = more.select(F.col("v").alias("label"), F.col("label").alias("far"))
    known = labels.join(new, "label", "left").select("v", F.coalesce("far", "label").alias("label"))
    return kept_table(known.unionByName(more.join(known.select("v"), "v", "left_anti")), "labels")


def _open(named: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """The rows of lists that hold several components (and of others, where most are of such), those
    lists with their largest component, and the number of pairs that a comparison of all that is
    open would take."""
    key = ["sig", "light"]
    named = kept_table(named, "labelled")
    parts = named.groupBy(*key, "label").agg(F.count("*").alias("n"))
    lists = parts.groupBy(*key).agg(F.sum("n").alias("_all"), F.max("n").alias("_most"), F.max(F.struct("n", "label")).alias("m")).where("_most < _all")
    long = (F.col("_all") > LONG) & (2 * F.col("_most") >= F.col("_all"))
    lists = kept_table(lists.select(*key, F.col("m.label").alias("main"), long.alias("long"), ((F.col("_all") - F.col("_most")) * F.col("_all")).cast("double").alias("cost"), "_all"), "open")
    cost, rows = lists.agg(F.sum("cost"), F.sum("_all")).first()
    pending = int(cost or 0)
    lists = lists.drop("cost", "_all")
    if pending and 2 * rows < named.count():  # else a filter moves more than it saves
        named = kept_table(sieved(named, "sig", lists.select(F.col("sig").alias("key"))).join(lists.select(*key), key), "named")
    return named, lists, pending


def _beside(rest: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links, pairs) (x, y) of the long lists: every similar pair of sets in different components
    that have such a list in common is a link, or one of the pairs, or joined by the links.

    The sets of all lists with one main component are held against a pivot p of it. With D(s) for
    what is in s or in p but not in both, s and t of n and m shingles differ by |D(s)| + |D(t)|
    less twice what D(s) and D(t) share. So they are similar if 2 (100 + PERCENT) times the shared
    part reaches w(s) + w(t), w(s) = (100 + PERCENT) |D(s)| - (100 - PERCENT) n. Always w(t) >=
    -(100 - PERCENT) |p|, and w(s) > (100 - PERCENT) |p| unless s and p are similar, which is a
    link. So each pair with such an s must share one of D(s) and D(t), and the first ones will do:
    in D(t) about half. What near copies have beside p comes first, as it is rarely shared; then
    p's own shingles, those in most sets first; last those that only p has.
    """
    c, e = 100 + PERCENT, 100 - PERCENT
    members = kept_table(rest.where("long").groupBy("main", "sid", "label").agg(F.first("n").alias("n"), F.max("central").alias("central")), "members")
    held = sieved(sets.select("sid", "els"), "sid", members.select(F.col("sid").alias("key")))
    members = kept_table(members.join(held, "sid"), "members")
    # what a near copy has of its own is rare or no one else's: the pivot is the set with the least of that
    usual = F.struct(F.col("central") * F.size("els") / F.col("n"), F.col("sid"))
    pivots = members.where("label = main").groupBy("main").agg(F.max_by(F.struct("sid", "n"), usual).alias("p"))
    pivots = pivots.select(F.col("p.sid").alias("sid"), F.col("p.n").alias("np"), "main")
    pivots = kept_table(pivots, "pivots")
    of = sieved(sets.select("sid", F.col("els").alias("ep")), "sid", pivots.select(F.col("sid").alias("key")))
    pivots = kept_table(pivots.join(of, "sid").withColumnRenamed("sid", "p"), "pivots")
    d = members.join(pivots, "main").where("sid <> p")
    d = d.withColumns({"up": F.array_except("els", "ep"), "down": F.reverse(F.array_except("ep", "els"))})
    d = d.withColumn("size", F.col("n") + F.col("np") - 2 * (F.size("els") - F.size("up")))
    d = d.withColumns({"w": c * F.col("size") - e * F.col("n"), "outside": F.col("label") != F.col("main"), "alone": F.col("n") - F.size("els"), "last": F.col("np") - F.size("ep")})
    d = d.withColumn("similar", c * F.col("size") <= e * (F.col("n") + F.col("np")))
    only_p = F.when(F.col("last") > 0, F.sequence(F.lit(1).cast("long"), F.col("last"))).otherwise(F.array().cast("array<long>"))
    d = kept_table(d.select("main", "sid", "label", "p", "np", "size", "w", "alone", (F.col("outside") & ~F.col("similar")).alias("asks"), (F.col("outside") & F.col("similar")).alias("linked"), F.concat("up", "down", only_p).alias("els")), "beside")

    def first(rows: DataFrame, least: Column) -> DataFrame:
        """at: place within D; what a set alone has comes before all else and needs no row."""
        n = F.col("size") - F.greatest(F.lit(1), F.ceil(least / F.lit(2.0 * c))) + 1 - F.col("alone")
        rows = rows.where(n > 0).select("main", "sid", "label", "size", "w", "alone", "asks", F.posexplode(F.slice("els", F.lit(1), n.cast("int"))).alias("_at", "el"))
        return rows.withColumn("room", F.col("size") - F.col("alone") - F.col("_at")).drop("size", "alone", "_at")

    asking = first(d.where("asks"), F.col("w") - e * F.col("np")).alias("a")
    others = first(d, F.col("w") + e * F.col("np") + 1).alias("b")
    pairs = asking.join(others, ["main", "el"]).where("a.label <> b.label and (not b.asks or a.sid > b.sid)")
    pairs = pairs.where(2 * c * F.least("a.room", "b.room") >= F.col("a.w") + F.col("b.w"))
    return d.where("linked").select(F.col("sid").alias("x"), F.col("p").alias("y")), pairs.select(F.col("a.sid").alias("x"), F.col("b.sid").alias("y"))


def similar_sets(own: DataFrame, found: DataFrame, name: Names) -> DataFrame | None:
    """v, label: components of different sets; found: features of the documents."""
    spark = own.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    classes = kept_table(found.where("n > 1").groupBy("sid").agg(F.min("n").alias("n"), F.min(F.struct("_d", "_h")).alias("rep")), "classes")
    counts = _whole_buckets(_postings(own, buckets, name, True), _shared_counts, "sid long, shared long").groupBy("sid").agg(F.sum("shared").alias("shared"))
    left = counts.join(classes, "sid").where(F.col("shared") >= F.least(F.lit(EXTRA), F.ceil(PERCENT * F.col("n") / 100)))
    left = kept_table(left.select("rep._d", "rep._h"), "candidates")
    texts = sieved(own.withColumn("key", F.xxhash64("_d", "_h")), "key", left.select(F.xxhash64("_d", "_h").alias("key"))).drop("key")
    texts = texts.join(left, ["_d", "_h"]).dropDuplicates(["_d", "_h"])
    lists = _whole_buckets(_postings(texts, buckets, name, False), _by_set(buckets), "bucket long, packed binary")
    sets = kept_table(_whole_buckets(lists, _ordered, "sid long, n long, els array<long>, q1 long, q2 long, scan long, central long"), "sets")
    live = sets.where("q1 > 0")
    costs = live.groupBy(F.floor(F.log(F.col("n")) / float(np.log(_RATIO)) + 1e-9).alias("c")).agg(F.sum(F.col("q2") * (F.col("q2") - 1) / 2).alias("pairs"), F.sum("scan").cast("double").alias("scan"))
    top = boundary([(int(r["c"]), r["pairs"], r["scan"]) for r in costs.collect()])
    signatures = kept_table(_signatures(live, top), "signatures")
    key = ["sig", "light"]
    postings = signatures.count()
    named, open_, pending = _open(signatures.withColumn("label", F.col("sid")))
    labels, turn, stars, before = None, 0, None, pending
    while pending:
        # the first turn's pivots are the most central sets, the later ones' differ from list to
        # list; only sets outside the pivot's component meet it, so each turn is linear in the
        # postings of open lists
        order = F.struct("central", "sid") if not turn else F.struct(F.xxhash64("sid", "sig", F.lit(turn)), "sid")
        pivots = named.groupBy(*key).agg(F.max_by(F.struct("sid", "n", "all", "light", "label"), order).alias("p"))
        pivots = kept_table(pivots, "pivots")  # a table, so that the join can split a long list
        met = named.join(pivots, key).where("label <> p.label").withColumn("a", F.struct("n", "all", "light")).where(_fit("a", "p", top, "all")).select(F.col("sid").alias("x"), F.col("p.sid").alias("y")).distinct()
        met = kept_table(met if stars is None else met.join(stars, ["x", "y"], "left_anti"), "pairs")
        stars = met if stars is None else stars.union(met)
        new = kept_table(_linked(met, sets), "links")
        turn += 1
        if not new.isEmpty():
            labels = joined_components(labels, new)
            before = pending
            named, open_, pending = _open(named.drop("label").join(labels.withColumnRenamed("v", "sid"), "sid", "left").withColumn("label", F.coalesce("label", "sid")))
        if turn >= LEAST_TURNS and (new.isEmpty() or pending <= postings or pending > GAIN * before):
            break
    if not pending:
        return labels
    # lists that still hold several components: sets outside the largest against all others
    rest = kept_table(named.join(open_, key), "rest")
    links, beside = _beside(rest, sets)
    short = rest.where("not long")
    pairs = short.where("label <> main").alias("a").join(short.alias("b"), key)
    more = pairs.where("a.label <> b.label and (b.label = b.main or a.sid > b.sid)").where(_fit("a", "b", top, "room")).select(F.col("a.sid").alias("x"), F.col("b.sid").alias("y"))
    known = stars.union(stars.selectExpr("y as x", "x as y"))
    # a table, as the test of the pairs reads them several times
    more = kept_table(more.union(beside).distinct().join(known, ["x", "y"], "left_anti"), "pairs")
    added = kept_table(_linked(more, sets).union(links).distinct(), "links")
    return labels if added.isEmpty() else joined_components(labels, added)


def jaccard_components(docs: DataFrame, bits: int = 64) -> DataFrame:
    """doc_id, _d, _h, n_shingles, component_id (least id reachable by links, itself included),
    and _c, which tells components apart that have the same component_id because their rows
    share a doc_id.

    Null and blank texts have no shingles and no links. Documents with equal sets are linked,
    rows that agree in id and text as well. A null id never names a component unless no other
    is in it. Extra columns are ignored. ``docs`` is read several times and must give the same
    rows each time. bits: of the first hash that names a set, fewer only for tests.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_d"), F.xxhash64(text).alias("_h"), text.cast("binary").alias("_text"))
    found, name = features(own, bits)
    labels = similar_sets(own, found, name)
    named = found.withColumn("label", F.col("sid"))
    if labels is not None:
        named = found.join(labels.withColumnRenamed("v", "sid"), "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    # named by label; partial sums keep a hot component small, and the join back is by label
    ids = kept_table(named.where("n > 0").groupBy("label").agg(F.min(F.when(F.col("_d") != NO_ID, F.col("_d"))).alias("component_id")), "names")
    doc_id = F.when(F.col("_d") != NO_ID, F.col("_d"))
    out = named.join(ids, "label", "left")
    return out.select(doc_id.alias("doc_id"), "_d", "_h", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(doc_id).alias("component_id"), F.col("label").alias("_c"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component: the one with the least id; of rows with
    that id the first by a hash of the text; of rows that agree in both, one."""
    found = kept_table(jaccard_components(docs), "components")
    own_group = F.when(F.col("n_shingles") > 0, F.struct(F.lit(0).cast("long").alias("k"), F.col("_c").alias("c"))).otherwise(F.struct(F.xxhash64("_d", "_h").alias("k"), F.lit(None).cast("long").alias("c")))
    d, h, key = fresh(docs, "_d", "_h", "_key")
    kept = kept_table(found.groupBy(own_group.alias("g")).agg(F.min(F.struct("_d", "_h")).alias("r")).select(F.col("r._d").alias(d), F.col("r._h").alias(h)).distinct(), "kept")
    rows = found.groupBy(F.col("_d").alias(d), F.col("_h").alias(h)).count()
    odd = kept_table(rows.join(kept.withColumn("kept", F.lit(True)), [d, h], "left").where("kept is null or count > 1").select(F.xxhash64(d, h).alias("key")), "odd")
    own = docs.withColumn(d, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).withColumn(h, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    # documents that stay and stand once don't move; the others meet the list of what is kept
    clear, rest = parted(own.withColumn(key, F.xxhash64(d, h)), key, odd)
    rest = rest.join(kept, [d, h], "left_semi").dropDuplicates([d, h])
    return clear.select(*docs.columns).unionByName(rest.select(*docs.columns))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
