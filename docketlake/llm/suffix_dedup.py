"""Repeated byte strings by a depth-limited radix sort of suffixes.

Only suffixes that can be repeated through the threshold (400 bytes) are sorted: those in runs
whose minimiser occurs more than once (superkmers.py brings them to one bucket, which is the
first partition of the sort). There the suffixes are ordered by most-significant-digit passes:
two of 8 bytes, then wider ones, each digit named by a hash; after every pass groups of one
leave. Groups that are still equal at the threshold are compared byte by byte with their first
member and are exactly the repeated strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import lean, table
from .superkmers import FEW_RUNS, Kind, covered, covered_spans, mix, prepared

WINDOW = 400
_C = np.random.default_rng(8).integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _eights(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one number, most significant first."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data),), dtype=">u8", buffer=padded, strides=(1,))


def equal_suffixes(data: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(places in ``starts`` in the order of their suffixes, first place of each group) of the
    suffixes equal to another through ``depth`` bytes.

    Most-significant-digit passes of 8 bytes each: a pass orders every group by its next digit
    and cuts it where the digit changes; groups of one leave. Groups that agree in the digit
    stay as they are.
    """
    digits = _eights(data).astype(np.uint64)
    at, cut = np.arange(len(starts)), np.zeros(min(1, len(starts)), dtype=np.int64)
    for o in range(0, depth, 8):
        if not len(at):
            break
        digit = digits[starts[at] + o]
        if depth - o < 8:
            digit >>= np.uint64(8 * (8 - depth + o))
        sizes = np.diff(np.r_[cut, len(at)])
        mixed = np.logical_or.reduceat(digit != np.repeat(digit[cut], sizes), cut)
        if not mixed.any():
            if o:
                continue
        group = np.repeat(np.arange(len(cut)), sizes)
        inside = np.flatnonzero(np.repeat(mixed, sizes))
        order = np.arange(len(at))
        order[inside] = inside[np.argsort(digit, kind="stable") if len(cut) == 1 and len(inside) else np.lexsort((digit[inside], group[inside]))]
        at, digit = at[order], digit[order]
        new = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])])
        sizes = np.diff(np.r_[new, len(at)])
        at = at[np.repeat(sizes > 1, sizes)]
        sizes = sizes[sizes > 1]
        cut = np.cumsum(sizes) - sizes
    return at, cut


class Bytes(Kind):
    first_stays = False

    def __init__(self, window: int = WINDOW, gram: int = 24):
        self.window, self.gram = window, max(1, min(gram, window // 2))

    def units(self, text: bytes) -> np.ndarray:
        return np.frombuffer(text, dtype=np.uint8)

    def join(self, parts: list[np.ndarray]) -> np.ndarray:
        return np.concatenate(parts)

    def grams(self, units: np.ndarray) -> np.ndarray:
        n, m = len(units) - self.gram + 1, self.gram
        eights = _eights(units)
        if m < 8:
            return mix((eights[:n].astype(np.uint64) >> np.uint64(8 * (8 - m))) * _C[0])
        out = np.zeros(n, dtype=np.uint64)
        for j, o in enumerate([*range(0, m - 8, 8), m - 8]):
            out += mix(eights[o : n + o].astype(np.uint64) ^ _C[j]) * _C[32 + j]
        return mix(out)

    def marks(self, units: np.ndarray, seed: int) -> np.ndarray:
        n = len(units) - self.window + 1
        places = [*range(0, self.window - 8, 8), self.window - 8] if self.window >= 8 else range(self.window)
        eights = _eights(units).astype(np.uint64) if self.window >= 8 else units.astype(np.uint64)
        out = np.zeros(n, dtype=np.uint64)
        for j, o in enumerate(places):  # a polynomial in an odd number over mixed digits
            out = out * _C[seed] + mix(eights[o : n + o] ^ _C[2 + (j + seed) % 62])
        return mix(out)

    def pack(self, units: np.ndarray, a: int, b: int) -> bytes:
        return units[a:b].tobytes()

    def repeated(self, strings: list[bytes], where: list[tuple]) -> Iterator[tuple[int, int, int]]:
        if not strings:
            return
        sizes = np.array([len(s) for s in strings], dtype=np.int64)
        n = sizes - self.window + 1
        first = np.cumsum(sizes) - sizes
        starts = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        at, _ = equal_suffixes(np.frombuffer(b"".join(strings), dtype=np.uint8), starts, self.window)
        at = np.sort(at)
        if not len(at):
            return
        owner = np.repeat(np.arange(len(strings)), n)[at]
        place = starts[at] - first[owner]
        cut = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1)])
        end = np.r_[cut[1:], len(at)] - 1
        for o, a, b in zip(owner[cut].tolist(), place[cut].tolist(), place[end].tolist(), strict=True):
            if where[o] is not None:  # else told already
                yield o, a, b + 1


def remove_repeated_bytes(docs: DataFrame, window: int = WINDOW, few_runs: int = FEW_RUNS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and kept (the remaining bytes).

    Null texts are empty. Rows that agree in id and text are two occurrences of one string, so
    both lose what is long enough; other rows with a repeated or null id are documents of
    their own. few_runs: see superkmers.py; it moves work, not results. Extra columns are
    ignored. ``docs`` is read several times and must give the same rows each time.
    """
    own = prepared(docs)
    spans = covered_spans(Bytes(window), own, few_runs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 1000):
                piece = batch.slice(part, 1000)
                n, gone, runs, sha, kept = [], [], [], [], []
                for i in range(piece.num_rows):
                    raw = piece.column(1)[i].as_py()
                    s = piece.column(2)[i].as_py()
                    left, removed, spans_ = raw, 0, 0
                    if s:
                        c = covered(s, len(raw), window)
                        left = np.frombuffer(raw, np.uint8)[~c].tobytes()
                        removed = int(c.sum())
                        spans_ = int(c[0]) + int((c[1:] & ~c[:-1]).sum())
                    n.append(len(raw))
                    gone.append(removed)
                    runs.append(spans_)
                    sha.append(hashlib.sha256(left).hexdigest())
                    kept.append(left)
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    joined = own.join(spans.hint("shuffle_hash"), ["_d", "_h"], "left").select("doc_id", "_text", "spans")
    return joined.mapInArrow(lean(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(table(spark, sf_dir, "documents")).drop("kept")
