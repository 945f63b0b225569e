"""Substring dedup by super-k-mer partitioning over words; see superkmers.py.

Windows of 20 words that also start earlier (smaller doc_id, or same document and earlier) are
removed with all words they cover; the first occurrence stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from .common import lean, table
from .superkmers import FEW_RUNS, Kind, covered, covered_spans, mix, prepared

WINDOW = 20
_ODD = np.random.default_rng(20).integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def _combined(h: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(len(h) - n + 1, dtype=np.uint64)
    for j in range(n):
        out += mix(h[j : len(h) - n + 1 + j] ^ _ODD[32 + j]) * _ODD[j]
    return mix(out)


class Words(Kind):
    first_stays = True

    def __init__(self, window: int = WINDOW, gram: int = 4):
        self.window, self.gram = window, min(gram, window)

    def units(self, text: bytes) -> list[bytes]:
        return text.split()

    def join(self, parts: list[list[bytes]]) -> np.ndarray:
        return hashed([w for p in parts for w in p])

    def grams(self, units: np.ndarray) -> np.ndarray:
        return _combined(units, self.gram)

    def marks(self, units: np.ndarray, seed: int) -> np.ndarray:
        return _combined(mix(units ^ np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))), self.window)

    def pack(self, units: list[bytes], a: int, b: int) -> bytes:
        return b" ".join(units[a:b])

    def repeated(self, strings: list[bytes], where: list[tuple]) -> Iterator[tuple[int, int, int]]:
        """Sort all windows by fingerprint; where neighbours agree, sort the words themselves.
        Of equal windows all but the earliest are told."""
        k = self.window
        words = [s.split(b" ") for s in strings]
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        if not len(sizes):
            return
        n = sizes - k + 1
        first = np.cumsum(sizes) - sizes
        marks = _combined(self.join(words), k)
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        owner = np.repeat(np.arange(len(strings)), n)
        order = np.argsort(marks[at], kind="stable")
        m = marks[at][order]
        same = np.r_[False, m[1:] == m[:-1]]
        same[:-1] |= same[1:]
        left = order[same]
        if not len(left):
            return
        exact = []
        for i in left.tolist():
            o = int(owner[i])
            j = int(at[i] - first[o])
            d, h, start, _ = where[o]
            exact.append((b" ".join(words[o][j : j + k]), d, h, start + j, o, j))
        exact.sort()
        told: dict[int, list[int]] = {}
        for p, q in zip(exact, exact[1:]):
            if p[0] == q[0]:  # q isn't the first of its group
                told.setdefault(q[4], []).append(q[5])
        for o, js in told.items():
            js.sort()
            a = b = js[0]
            for j in js[1:]:
                if j != b + 1:
                    yield o, a, b + 1
                    a = j
                b = j
            yield o, a, b + 1


def remove_repeats(docs: DataFrame, window: int = WINDOW, few_runs: int = FEW_RUNS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, and kept_text (kept words joined by spaces).

    Null texts have no words. Documents with a null id come first; documents with the same id
    are taken in the order of a hash of their texts, and rows that agree in both are one
    document listed twice: each row gets its result. Words that are no UTF-8 show as replacement characters in kept_text alone. few_runs: see superkmers.py; it
    moves work, not results. Extra columns are ignored. ``docs`` is
    read several times and must give the same rows each time.
    """
    own = prepared(docs)
    kind = Words(window)
    spans = covered_spans(kind, own, few_runs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 1000):
                piece = batch.slice(part, 1000)
                n, gone, sha, kept = [], [], [], []
                for i in range(piece.num_rows):
                    words = piece.column(1)[i].as_py().split()
                    s = piece.column(2)[i].as_py()
                    left = words
                    if s:
                        left = [w for w, c in zip(words, covered(s, len(words), window).tolist(), strict=True) if not c]
                    text = b" ".join(left)
                    n.append(len(words))
                    gone.append(len(words) - len(left))
                    sha.append(hashlib.sha256(text).hexdigest())
                    kept.append(text.decode(errors="replace"))
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    joined = own.join(spans.hint("shuffle_hash"), ["_d", "_h"], "left").select("doc_id", "_text", "spans")
    return joined.mapInArrow(lean(run), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")
