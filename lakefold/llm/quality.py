"""Quality: random-indexing word vectors, pooled, and a two-layer network.

Word vectors: every hashed word has a fixed random vector of -1, 0 and 1;
a word's vector is the sum of those of the words around it, over all
documents.  The sums are integers, so they do not depend on the order in
which partitions are added.  The table has a fixed number of rows, whatever
the size of the corpus.

A document pools the vectors of its words (mean and spread, and the mean of
the product of neighbours, which repetition raises).  A small numpy network
learns from a bounded sample of labelled documents; a temperature fitted on
labelled documents set aside calibrates its probabilities.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakefold.llm.common import crc_of_id
from lakefold.llm.textnum import class_rates, encode, labelled_sample, slices, sums, word_hashes

_TOKENS = re.compile(r"\w+|[^\w\s]+").findall
_CACHE_WORDS = 400_000


@dataclass(frozen=True)
class Settings:
    """``low`` and ``good`` bound the labelled documents learnt from."""

    low: int = 4000
    good: int = 6000
    buckets: int = 1 << 14
    dim: int = 24
    window: int = 2
    hidden: int = 32
    epochs: int = 60
    rate: float = 0.01
    seed: int = 5


def index_vectors(s: Settings) -> np.ndarray:
    """The fixed random vector of each bucket: a third each of -1, 0, 1."""
    return np.random.default_rng(s.seed).integers(-1, 2, (s.buckets, s.dim)).astype(np.int8)


class _Buckets:
    """Bucket of each token, remembered by the worker."""

    def __init__(self, buckets: int):
        self.n, self.cache = buckets, {}

    def of(self, words: list[str]) -> np.ndarray:
        new = [w for w in words if w not in self.cache]
        if len(self.cache) + len(new) > _CACHE_WORDS:
            self.cache.clear()
            new = words
        self.cache.update(zip(new, (word_hashes(new) % np.uint64(self.n)).tolist()))
        return np.array([self.cache[w] for w in words], np.int64)


_WORKER: dict[int, _Buckets] = {}


def _tokens(texts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    known = _WORKER.setdefault(buckets, _Buckets(buckets))
    codes, offsets, words = encode(texts, _TOKENS)
    return (known.of(words)[codes] if words else codes.astype(np.int64)), offsets


def context_sums(texts, s: Settings, into: np.ndarray | None = None, index: np.ndarray | None = None) -> np.ndarray:
    """Add to each bucket's row the index vectors of the words around it."""
    index = index_vectors(s) if index is None else index
    into = np.zeros((s.buckets, s.dim), np.int64) if into is None else into
    for _, part in slices(texts):
        t, offsets = _tokens(part, s.buckets)
        doc = np.repeat(np.arange(len(part)), np.diff(offsets))
        around = np.zeros((len(t), s.dim), np.int16)
        for d in range(1, s.window + 1):
            same = (doc[d:] == doc[:-d])[:, None]
            around[:-d] += index[t[d:]] * same
            around[d:] += index[t[:-d]] * same
        order = np.argsort(t.astype(np.uint16 if s.buckets <= 1 << 16 else np.int64), kind="stable")
        ranked = t[order]
        first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(t) else np.zeros(0, int)
        if len(first):
            into[ranked[first]] += np.add.reduceat(around[order], first, axis=0, dtype=np.int64)
    return into


def word_vectors(docs: DataFrame, s: Settings = Settings()) -> np.ndarray:
    """The vector of each bucket from all documents, of unit length.

    Each task adds up its own rows; the driver gets one row a bucket."""
    names = [f"v{k}" for k in range(s.dim)]
    schema = ", ".join(["bucket int", *(f"{n} long" for n in names)])

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, total = index_vectors(s), np.zeros((s.buckets, s.dim), np.int64)
        for b in batches:
            context_sums(b["text"].tolist(), s, total, index)
        used = np.flatnonzero(total.any(axis=1))
        yield pd.DataFrame(total[used], columns=names).assign(bucket=used.astype(np.int32))[["bucket", *names]]

    rows = docs.select("text").filter(F.col("text").isNotNull()).mapInPandas(add, schema)
    got = rows.groupBy("bucket").agg(*(F.sum(n).alias(n) for n in names)).toPandas()  # at most ``buckets`` rows
    out = np.zeros((s.buckets, s.dim), np.float64)
    out[got["bucket"].to_numpy(int)] = got[names].to_numpy(np.float64)
    used = out.any(axis=1)
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
    if used.any():
        out[used] -= out[used].mean(0)  # the direction that all words share tells nothing
        out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
    return out.astype(np.float32)


def pooled(texts, vectors: np.ndarray, s: Settings) -> np.ndarray:
    """One row of features a text: mean and spread of its word vectors, mean
    product of neighbours, and their closeness.  No words: zeros."""
    dim = vectors.shape[1]
    out = np.zeros((len(texts), 3 * dim + 2), np.float32)
    for at, part in slices(texts):
        t, offsets = _tokens(part, s.buckets)
        v = vectors[t]
        n = np.maximum(np.diff(offsets), 1)[:, None]
        mean = sums(v, offsets) / n
        near = np.zeros_like(v)
        near[1:] = v[1:] * v[:-1]
        near[offsets[:-1][np.diff(offsets) > 0]] = 0
        beside = sums(near, offsets) / n
        spread = np.sqrt(np.maximum(sums(v * v, offsets) / n - mean ** 2, 0))
        out[at:at + len(part)] = np.concatenate(
            [mean, spread, beside, beside.sum(1, keepdims=True), np.linalg.norm(mean, axis=1, keepdims=True)], axis=1)
    return out


@dataclass(frozen=True)
class Network:
    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh(((x - self.shift) / self.scale) @ self.w1 + self.b1)
        return (h @ self.w2 + self.b2) / self.temperature

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(x.astype(np.float64)), -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, aside: np.ndarray, s: Settings, rate: float | None = None) -> Network:
    """Two layers by Adam on the rows not set aside, the temperature on those
    set aside.  ``rate``: share of class 1 outside the sample (the sample's
    if None).  With one class only, every score is that share."""
    dim = x.shape[1]
    rate = float(np.clip(np.mean(y) if rate is None and len(y) else (rate or 0.0), 1e-6, 1 - 1e-6))
    odds = float(np.log(rate / (1 - rate)))
    if len(set(y.tolist())) < 2:
        return Network(np.zeros(dim), np.ones(dim), np.zeros((dim, s.hidden)), np.zeros(s.hidden), np.zeros(s.hidden), odds, 1.0)
    rng = np.random.default_rng(s.seed)
    learn = ~aside if len(set(y[~aside].tolist())) == 2 else np.ones(len(y), bool)
    a, t = x[learn].astype(np.float64), y[learn].astype(np.float64)
    shift, scale = a.mean(0), a.std(0) + 1e-4
    a = (a - shift) / scale
    p = [rng.normal(0, dim ** -0.5, (dim, s.hidden)), np.zeros(s.hidden), rng.normal(0, s.hidden ** -0.5, s.hidden), np.zeros(1)]
    m, v, k = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p], 0
    for epoch in range(s.epochs):
        step = s.rate * (1 - epoch / s.epochs)
        perm = rng.permutation(len(t))
        for i in range(0, len(t), 128):
            r = perm[i:i + 128]
            h = np.tanh(a[r] @ p[0] + p[1])
            err = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -40, 40))) - t[r]) / len(r)
            dh = np.outer(err, p[2]) * (1 - h * h)
            grads = [a[r].T @ dh + 1e-4 * p[0], dh.sum(0), h.T @ err + 1e-4 * p[2], np.array([err.sum()])]
            k += 1
            for j, g in enumerate(grads):
                m[j] = 0.9 * m[j] + 0.1 * g
                v[j] = 0.999 * v[j] + 0.001 * g * g
                p[j] -= step * (m[j] / (1 - 0.9 ** k)) / (np.sqrt(v[j] / (1 - 0.999 ** k)) + 1e-8)
    raw = Network(shift, scale, p[0], p[1], p[2], float(p[3][0]), 1.0)
    temperature = 1.0
    if aside.any():
        z, u = raw.logits(x[aside].astype(np.float64)), y[aside]
        options = np.exp(np.linspace(np.log(0.5), np.log(8), 60))
        loss = [np.mean(np.logaddexp(0, np.where(u == 1, -z, z) / o)) for o in options]
        temperature = float(options[int(np.argmin(loss))])
    sample = float(np.clip(np.mean(y), 1e-6, 1 - 1e-6))
    return Network(shift, scale, p[0], p[1], p[2], raw.b2 + temperature * (odds - float(np.log(sample / (1 - sample)))), temperature)


def learnable(col: str = "doc_id") -> Column:
    """Rows that may be learnt from; the others are held out."""
    return F.pmod(crc_of_id(col), F.lit(5)) != 0


def _pooling(vectors, s: Settings):
    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(list(pooled(texts.tolist(), vectors.value, s)))

    return features


def with_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, s: Settings = Settings()) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.

    Null and empty texts pool to zeros and are scored like any other;
    without labels every score is the same; repeated rows score alike."""
    spark = docs.sparkSession
    vectors = spark.sparkContext.broadcast(word_vectors(docs, s))  # buckets x dim floats
    neg, pos = class_rates(labels, "quality", learnable())
    sample = labelled_sample(docs, labels, "quality", learnable(), s.low, s.good)
    rows = sample.select("doc_id", "y", _pooling(vectors, s)("text").alias("x"),
                         (F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(5)) == 0).alias("aside")).collect()
    rows.sort(key=lambda r: (r.doc_id, list(r.x)))
    x = np.array([r.x for r in rows], np.float32).reshape(len(rows), 3 * s.dim + 2)
    net = spark.sparkContext.broadcast(fit(x, np.array([r.y for r in rows], int), np.array([r.aside for r in rows], bool), s,
                                           pos / (neg + pos) if neg + pos else 0.0))

    @F.pandas_udf(T.DoubleType())
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(net.value.scores(pooled(texts.tolist(), vectors.value, s)))

    out = docs.select("doc_id", scored("text").alias("score"))
    return out.select("doc_id", (~learnable()).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
