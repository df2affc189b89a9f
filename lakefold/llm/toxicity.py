"""Toxicity: averaged subword embeddings and a linear softmax.

A document is the bag of the character n-grams of its words (and the words
themselves), hashed into a fixed number of buckets.  Bucket embeddings are
averaged and fed to a linear softmax; both are trained jointly in numpy on a
bounded sample of labelled documents.  A misspelt word shares most n-grams
with the word it comes from, and so most of its vector.

After training, the two class weights reduce every bucket to one number, its
share of the log odds; scoring sums these numbers over whole texts.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakefold.llm.common import crc_of_id, give_back
from lakefold.llm.textnum import class_rates, encode, labelled_sample, slices, subwords

_TOKENS = re.compile(r"\w+").findall
_CACHE_WORDS = 100_000  # of each Python worker, all of which share an executor's memory
_SLICE = 1_000_000      # characters that are split into words at once


@dataclass(frozen=True)
class Settings:
    """``clean`` and ``toxic`` bound the labelled documents learnt from."""

    clean: int = 5000
    toxic: int = 2500
    buckets: int = 1 << 17
    dim: int = 4
    low: int = 3
    high: int = 6
    epochs: int = 6
    batch: int = 32
    rate: float = 0.1
    decay: float = 0.02  # pulls subwords without evidence back to 0
    gain: float = 64.0  # times the average, so that rare subwords weigh enough
    seed: int = 11


@dataclass(frozen=True)
class Model:
    """Log-odds share of each bucket, the bias, and the score of a text without words."""

    weights: np.ndarray
    bias: float
    low: int
    high: int


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _bags(texts: list[str], s: Settings) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each text's buckets, and how many of its subwords fall in each (65,535 stands for more)."""
    bags = []
    for _, part in slices(texts, _SLICE):
        codes, offsets, words = encode([t.lower() for t in part], _TOKENS)
        number, bucket = subwords(words, s.low, s.high, s.buckets)
        bucket = bucket[np.argsort(number, kind="stable")].astype(np.int32)
        starts = np.append(0, np.cumsum(np.bincount(number, minlength=len(words))))
        for a, b in zip(offsets[:-1], offsets[1:]):
            w, n = np.unique(codes[a:b], return_counts=True)
            sizes = starts[w + 1] - starts[w]
            ends = np.cumsum(sizes)
            at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[w] - (ends - sizes), sizes)
            subs, back = np.unique(bucket[at], return_inverse=True)
            bags.append((subs, np.minimum(np.bincount(back, np.repeat(n, sizes), len(subs)), 65_535).astype(np.uint16)))
    return bags


def fit(texts: list[str], y: np.ndarray, s: Settings, prior: float | None = None) -> Model:
    """Train on the texts; ``prior`` is the rate of class 1 to be assumed
    (the sample's if None).  With one class only, every score is that rate."""
    rate = float(np.clip(prior if prior is not None else (np.mean(y) if len(y) else 0.0), 0.0, 1.0))
    if len(set(np.asarray(y).tolist())) < 2:
        odds = math.log(max(rate, 1e-6) / max(1 - rate, 1e-6))
        return Model(np.zeros(s.buckets, np.float32), odds, s.low, s.high)
    bags = _bags(texts, s)
    rng = np.random.default_rng(s.seed)
    # One row a dimension: every pass over the buckets then runs along memory.
    emb = np.ascontiguousarray(rng.normal(0, 0.01, (s.buckets, s.dim)).astype(np.float32).T)
    grad, held = np.empty_like(emb), np.empty_like(emb)
    soft, bias = np.zeros((s.dim, 2), np.float32), np.zeros(2, np.float32)
    soft[:, 1] = rng.normal(0, 1.0, s.dim)
    soft[:, 0] = -soft[:, 1]
    g_emb, g_soft, g_bias = np.full(s.buckets, 1e-6, np.float32), np.full(soft.shape, 1e-6), np.full(2, 1e-6)
    classes = np.eye(2, dtype=np.float32)[np.asarray(y, int)]
    weight = (0.5 / classes.mean(0))[np.asarray(y, int)]
    known = np.array([d for d in range(len(y)) if len(bags[d][0])], int)
    for epoch in range(s.epochs):
        step = s.rate * (1 - epoch / s.epochs)
        perm = rng.permutation(known)
        for at in range(0, len(perm), s.batch):
            rows = perm[at:at + s.batch]
            subs = np.concatenate([bags[d][0] for d in rows])
            part = np.concatenate([bags[d][1] * np.float32(s.gain / bags[d][1].sum()) for d in rows])  # average, times the gain
            sizes = np.array([len(bags[d][0]) for d in rows])
            first = np.append(0, np.cumsum(sizes))[:-1]
            pooled = np.add.reduceat(emb[:, subs] * part, first, axis=1).T
            logit = pooled @ soft + bias
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            err = ((p - classes[rows]) * weight[rows][:, None]).astype(np.float32)
            for j, d_doc in enumerate((err @ soft.T).T):
                grad[j] = np.bincount(subs, np.repeat(d_doc, sizes) * part, s.buckets)
            grad += np.multiply(emb, np.float32(s.decay), out=held)
            g_emb += np.square(grad, out=held).mean(0)
            grad *= np.float32(step)
            emb -= np.divide(grad, np.sqrt(g_emb), out=grad)
            d_soft, d_bias = pooled.T @ err, err.sum(0)
            g_soft += d_soft ** 2
            g_bias += d_bias ** 2
            soft -= (0.1 * step * d_soft / np.sqrt(g_soft)).astype(np.float32)
            bias -= (step * d_bias / np.sqrt(g_bias)).astype(np.float32)
    # The classes weighed alike in training: the assumed rate moves the bias.
    prior_odds = math.log(max(rate, 1e-6) / max(1 - rate, 1e-6))
    return Model((s.gain * (emb.T @ (soft[:, 1] - soft[:, 0]))).astype(np.float32), float(bias[1] - bias[0]) + prior_odds, s.low, s.high)


_CACHES: dict[str, dict[str, tuple[float, int]]] = {}


def score_texts(texts, model: Model, cache: dict[str, tuple[float, int]] | None = None) -> np.ndarray:
    """Probability of class 1 of each whole text (None counts as "")."""
    cache = {} if cache is None else cache
    out = np.empty(len(texts))
    for at, part in slices(texts, _SLICE):
        codes, offsets, words = encode([t.lower() for t in part], _TOKENS)
        new = [w for w in words if w not in cache]
        if len(cache) + len(new) > _CACHE_WORDS:
            cache.clear()
            new = words
        number, bucket = subwords(new, model.low, model.high, len(model.weights))
        share = np.bincount(number, model.weights[bucket], len(new))
        cache.update(zip(new, zip(share.tolist(), np.bincount(number, minlength=len(new)).tolist())))
        each = np.array([cache[w] for w in words]).reshape(-1, 2)[codes]
        total = np.vstack([np.zeros((1, 2)), np.cumsum(each, axis=0)])
        got = total[offsets[1:]] - total[offsets[:-1]]
        out[at:at + len(part)] = _sigmoid(got[:, 0] / np.maximum(got[:, 1], 1) + model.bias)
    return out


def score(text: Column, model: Model, spark) -> Column:
    """Toxicity of a text column, 0 to 1.  A text without words scores by the
    bias alone."""
    shared, key = spark.sparkContext.broadcast(model), uuid.uuid4().hex

    @F.pandas_udf(T.DoubleType())
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if key not in _CACHES:
            _CACHES.clear()
            _CACHES[key] = {}
        for texts in batches:
            got = pd.Series(score_texts(texts.tolist(), shared.value, _CACHES[key]))
            give_back()
            yield got

    return scored(text)


def learnable(col: str = "doc_id") -> Column:
    """Rows that may be learnt from; the others are held out."""
    return F.pmod(crc_of_id(col), F.lit(4)) != 2


def train(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Model:
    """Fit on a bounded sample of the learnable labelled documents, in one
    task: the driver gets the weights only, and a lost executor's task is run
    again on the same sample."""
    neg, pos = class_rates(labels, "toxic", learnable())
    rate = pos / (neg + pos) if neg + pos else 0.0
    sample = labelled_sample(docs, labels, "toxic", learnable(), s.clean, s.toxic)

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        if not parts:
            return
        rows = pd.concat(parts).sort_values("doc_id", kind="stable")
        parts.clear()
        model = fit(rows["text"].tolist(), rows["y"].to_numpy(int), s, rate)
        give_back()
        yield pd.DataFrame({"weights": [model.weights.tobytes()], "bias": [model.bias]})

    got = sample.repartition(1).mapInPandas(learn, "weights binary, bias double").first()
    if got is None:  # nothing to learn from
        return fit([], np.zeros(0, int), s, rate)
    return Model(np.frombuffer(got.weights, np.float32), got.bias, s.low, s.high)


def with_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, s: Settings = Settings()) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.  Null and empty
    texts score by the bias; without labels every score is near 0."""
    model = train(docs, labels, s)
    rows = docs.select("doc_id", score(F.col("text"), model, docs.sparkSession).alias("score"))
    return rows.select("doc_id", (~learnable()).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, s: Settings = Settings()) -> DataFrame:
    """The documents that score below the threshold, as they were."""
    model = train(docs, labels, s)
    keep = docs.withColumn("_llm_score", score(F.col("text"), model, docs.sparkSession))
    return keep.filter(F.col("_llm_score") < threshold).select(*docs.columns)
