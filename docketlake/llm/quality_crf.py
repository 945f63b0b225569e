"""Document quality from a linear-chain conditional random field over lines.

Every line gets features of its own and of the lines beside it. A chain of two states (bad,
good) is fitted to the lines of labelled documents by maximum likelihood; scoring runs the
forward-backward recursions over each document and takes the mean of the lines' marginals of
"good", weighted by length. A logistic step fitted on the same documents turns that mean into
the score. Labels, language, source and id are never features.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept_table, table

#: Bounds of the fit: labelled documents, and bytes and lines of all their texts, which are never
#: cut; documents that no longer fit are left out. Scoring has none.
TRAIN_DOCS = 3000
TRAIN_BYTES = 32 << 20
TRAIN_LINES = 400_000
STEPS = 160
CHUNK_BYTES = 3 << 20

_KINDS = 8
_LUT = np.full(256, 7, dtype=np.int64)  # 7: beyond ASCII
for _c in range(128):
    _s = chr(_c)
    _LUT[_c] = 0 if _s.islower() else 1 if _s.isupper() else 2 if _s.isdigit() else 3 if _s in " \t\r\x0b\x0c" else 4 if _s in ".,;:!?'\"()-" else 5 if _s in "#*$%&|<>" else 6
N_OWN = _KINDS + 8


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of each line with its neighbours', lines of each text, length of each line)."""
    lines = [x.split("\n") for x in texts]
    counts = np.array([len(x) for x in lines], dtype=np.int64)
    raw = "\n".join(texts).encode()
    data = np.frombuffer(raw, dtype=np.uint8)
    ends = np.r_[np.flatnonzero(data == 10), len(data)]
    starts = np.r_[0, ends[:-1] + 1]
    size = ends - starts
    place = np.repeat(np.arange(len(size)) * _KINDS, np.diff(np.r_[starts, len(data) + 1]))[: len(data)]
    kinds = np.bincount(place + _LUT[data], minlength=len(size) * _KINDS).reshape(-1, _KINDS).astype(np.float64)
    kinds[:, 6] -= np.r_[np.ones(len(size) - 1), 0]  # the line ends themselves
    seen_before = np.fromiter((a for x in lines for a in _repeats(x)), dtype=np.float64, count=len(size))
    echo = np.fromiter((1 - len(set(w)) / len(w) for x in lines for w in (y.split(" ") for y in x)), dtype=np.float64, count=len(size))[:, None]
    n = np.maximum(size, 1)[:, None]
    words = kinds[:, 3] + 1
    f = np.concatenate([kinds / n, np.log1p(size)[:, None], np.minimum(size / words, 40)[:, None] / 10, seen_before[:, None], (size == 0)[:, None], (kinds[:, 5] > 2)[:, None], (kinds[:, 5] / words)[:, None], echo, echo > 0.6], axis=1)
    first = np.cumsum(counts) - counts
    before, after = np.roll(f, 1, axis=0), np.roll(f, -1, axis=0)
    before[first] = 0
    after[first + counts - 1] = 0
    edge = np.zeros((len(f), 2))
    edge[first, 0] = 1
    edge[first + counts - 1, 1] = 1
    return np.concatenate([f, before, after, edge], axis=1), counts, size


def _repeats(lines: list[str]) -> list[float]:
    if len(set(lines)) == len(lines):
        return [0.0] * len(lines)
    seen: set[str] = set()
    return [0.0 if not x or x not in seen and not seen.add(x) else 1.0 for x in lines]


def forward_backward(unary: np.ndarray, counts: np.ndarray, trans: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, float]:
    """(marginals of state 1, expected transitions, sum of log partition functions).

    unary: log-odds of state 1 for each line; all chains advance together, one line a step.
    weight: of each line in the sum of transitions.
    """
    first = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    s, left = first[order], -counts[order]
    psi = np.ones((len(unary), 2))
    psi[:, 1] = np.exp(np.clip(unary, -30, 30))
    a, alpha, beta, scale = np.exp(trans), np.empty_like(psi), np.ones_like(psi), np.empty(len(unary))
    x = psi[s]
    for t in range(int(counts.max(initial=0))):
        k = int(np.searchsorted(left, -t, side="left"))  # chains longer than t
        at = s[:k] + t
        x = psi[at] if not t else (alpha[at - 1] @ a) * psi[at]
        scale[at] = x.sum(1)
        alpha[at] = x / scale[at, None]
    for t in range(int(counts.max(initial=0)) - 2, -1, -1):
        k = int(np.searchsorted(left, -t - 1, side="left"))
        at = s[:k] + t
        x = (psi[at + 1] * beta[at + 1]) @ a.T
        beta[at] = x / x.sum(1, keepdims=True)
    both = alpha * beta
    both /= both.sum(1, keepdims=True)
    inner = np.ones(len(unary), dtype=bool)
    inner[first] = False
    at = np.flatnonzero(inner)
    pair = alpha[at - 1][:, :, None] * a[None] * (psi[at] * beta[at])[:, None, :]
    pair /= pair.sum((1, 2), keepdims=True)
    if weight is not None:
        pair *= weight[at][:, None, None]
    return both[:, 1], pair.sum(0), float(np.log(scale).sum())


@dataclass
class Model:
    mean: np.ndarray
    sd: np.ndarray
    weights: np.ndarray
    trans: np.ndarray
    platt: tuple[float, float]

    def mean_marginal(self, texts: list[str]) -> np.ndarray:
        x, counts, size = line_features(texts)
        return self._mean(x, counts, size)

    def _mean(self, x: np.ndarray, counts: np.ndarray, size: np.ndarray) -> np.ndarray:
        u = np.clip((x - self.mean) / self.sd, -6, 6) @ self.weights[:-1] + self.weights[-1]
        p = forward_backward(u, counts, self.trans)[0]
        first = np.cumsum(counts) - counts
        w = size + 1e-6
        return np.add.reduceat(p * w, first) / np.add.reduceat(w, first)

    def score(self, texts: list[str]) -> np.ndarray:
        out: list[np.ndarray] = []
        a = 0
        while a < len(texts):
            b, n = a, 0
            while b < len(texts) and (b == a or n + len(texts[b]) < CHUNK_BYTES):
                n += len(texts[b])
                b += 1
            out.append(_sigmoid(self.platt[0] * _logit(self.mean_marginal(texts[a:b])) + self.platt[1]))
            a = b
        return np.concatenate(out) if out else np.zeros(0)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(texts: list[str], quality: np.ndarray, steps: int = STEPS) -> Model:
    """Maximum likelihood with a small quadratic penalty, by Adam on the whole sample. The log
    likelihood of a document is divided by its number of lines, so that documents count alike;
    lines and transitions have the same weight."""
    n_features = 3 * N_OWN + 2
    if not len(texts) or len(set(quality.tolist())) < 2:  # nothing to tell apart: the base rate
        p = float(np.clip(quality.mean(), 0.05, 0.95)) if len(texts) else 0.5
        return Model(np.zeros(n_features), np.ones(n_features), np.zeros(n_features + 1), np.zeros((2, 2)), (0.0, float(np.log(p / (1 - p)))))
    x, counts, size = line_features(texts)
    mean, sd = x.mean(0), x.std(0) + 1e-3
    z = np.concatenate([np.clip((x - mean) / sd, -6, 6), np.ones((len(x), 1))], axis=1)
    y = np.repeat(quality, counts).astype(np.float64)
    weight = np.repeat(1.0 / counts, counts)
    inner = np.ones(len(y), dtype=bool)
    inner[np.cumsum(counts) - counts] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[at - 1].astype(int), y[at].astype(int)), weight[at])
    w = np.zeros(z.shape[1] + 4)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        p, pairs, _ = forward_backward(z @ w[:-4], counts, w[-4:].reshape(2, 2), weight)
        g = np.r_[z.T @ ((p - y) * weight), (pairs - seen).ravel()] / len(counts)
        g += 1e-4 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.08 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model = Model(mean, sd, w[:-4], w[-4:].reshape(2, 2), (1.0, 0.0))
    s = _logit(model._mean(x, counts, size))
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps of the logistic fit
        p = _sigmoid(a * s + b)
        r = p * (1 - p)
        h = np.array([[(r * s * s).sum() + 1e-3, (r * s).sum()], [(r * s).sum(), r.sum() + 1e-3]])
        d = np.linalg.solve(h, [((p - quality) * s).sum() + 1e-3 * a, (p - quality).sum()])
        a, b = a - d[0], b - d[1]
        if np.abs(d).max() < 1e-8:
            break
    return Model(mean, sd, model.weights, model.trans, (float(max(a, 1e-3)), float(b)))


def held_out(column: str = "doc_id"):
    """crc32 of the id as text, modulo 3, is 1; null ids are held out of the fit too."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS) -> tuple[list[str], np.ndarray]:
    """The bounded sample: labelled ids in the order of a hash, without held-out ones and ids
    labelled both ways. An id that stands in several documents brings one of them."""
    agreed = labels.where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("_hi")).where("quality = _hi").drop("_hi")
    chosen = kept_table(agreed.where(~held_out()).orderBy(F.md5(F.col("doc_id").cast("string"))).limit(limit), "sample")
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    rows = docs.select("doc_id", text).join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("quality").alias("quality"))
    rows = kept_table(rows, "texts")
    fit_in, n_bytes, n_lines = [], 0, 0
    for r in rows.select("doc_id", F.octet_length("text").alias("b"), (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).alias("n")).orderBy(F.md5(F.col("doc_id").cast("string"))).collect():
        if n_bytes + r["b"] <= TRAIN_BYTES and n_lines + r["n"] <= TRAIN_LINES:
            fit_in.append(r["doc_id"])
            n_bytes, n_lines = n_bytes + r["b"], n_lines + r["n"]
    rows = rows.where(F.col("doc_id").isin(fit_in))
    got = sorted(rows.collect(), key=lambda r: zlib.crc32(str(r["doc_id"]).encode()))
    return [r["text"] for r in got], np.array([float(r["quality"] > 0) for r in got])


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of each row; null texts count as empty, extra columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                texts = [x or "" for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.score(texts), pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def op7_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(*training_rows(docs, table(spark, sf_dir, "labels")))
    return score_documents(docs, model).select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
