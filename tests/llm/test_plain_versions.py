"""Classifiers and pipeline stages against plain loops."""

import collections
import hashlib
import math
import re

import numpy as np

import corpus_pipeline
from lakefold.llm import pii, quality, toxicity
from lakefold.llm.common import LOWER, UPPER
from lakefold.llm.queries import MIX_WEIGHTS
from tests.llm.test_corpuswise import plain_targets

SF = "/root/testdata/sf0.001"
MASK, PRIME = 2**64 - 1, 0x9E3779B97F4A7C15


def finish(h):
    h ^= h >> 31
    h = h * 0xBF58476D1CE4E5B9 & MASK
    h ^= h >> 27
    h = h * 0x94D049BB133111EB & MASK
    return h ^ h >> 31


def word_hash(word):
    total = 0
    for k, c in enumerate(word, 1):
        total += finish((ord(c) + 1) * PRIME & MASK) * pow(PRIME, k, 2**64)
    return finish(total & MASK)


def subword_buckets(word, model):
    marked = f"<{word}>"
    yield word_hash(marked) % len(model.weights)
    for n in range(model.low, model.high + 1):
        for i in range(len(marked) - n + 1):
            rolled = 0
            for c in marked[i:i + n]:
                rolled = (rolled * PRIME + ord(c) + 1) & MASK
            yield finish((rolled + n) & MASK) % len(model.weights)


def plain_toxicity(text, model):
    total = n = 0
    for word in re.findall(r"\w+", (text or "").lower()):
        for b in subword_buckets(word, model):
            total, n = total + float(model.weights[b]), n + 1
    return 1 / (1 + math.exp(-(total / max(n, 1) + model.bias)))


def some_texts(spark, n=25):
    texts = sorted((r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect() if r.text), key=len)
    return [*texts[:n], "", None, "É ß ÀB 日本 a_b x1", "the the the"]


def test_toxicity_scores_like_a_plain_forward_pass(spark):
    rng = np.random.default_rng(0)
    model = toxicity.Model(rng.normal(0, 3, 4096).astype(np.float32), -0.5, 3, 6)
    texts = some_texts(spark)
    assert np.allclose(toxicity.score_texts(texts, model), [plain_toxicity(t, model) for t in texts], atol=1e-6)


def plain_features(text, vectors, s):
    rows = [vectors[word_hash(w) % s.buckets].astype(float) for w in quality._TOKENS(text or "")]
    if not rows:
        return np.zeros(3 * vectors.shape[1] + 2)
    mean = sum(rows) / len(rows)
    spread = np.sqrt(np.maximum(sum(r * r for r in rows) / len(rows) - mean**2, 0))
    beside = sum((a * b for a, b in zip(rows, rows[1:])), np.zeros(len(mean))) / len(rows)
    return np.concatenate([mean, spread, beside, [beside.sum(), math.sqrt(float(mean @ mean))]])


def test_quality_pools_and_scores_like_plain_loops(spark):
    s = quality.Settings()
    rng = np.random.default_rng(1)
    vectors = rng.normal(0, 0.3, (s.buckets, s.dim)).astype(np.float32)
    texts = some_texts(spark)
    got = quality.pooled(texts, vectors, s)
    want = np.array([plain_features(t, vectors, s) for t in texts])
    assert np.allclose(got, want, atol=2e-4)
    dim = got.shape[1]
    net = quality.Network(rng.normal(0, 1, dim), rng.uniform(0.5, 2, dim), rng.normal(0, 0.2, (dim, s.hidden)), rng.normal(0, 0.2, s.hidden),
                          rng.normal(0, 0.2, s.hidden), 0.3, 1.7)
    for x, p in zip(want, net.scores(want)):
        z = 0.3
        for h in range(s.hidden):
            z += math.tanh(sum((x[i] - net.shift[i]) / net.scale[i] * net.w1[i, h] for i in range(dim)) + net.b1[h]) * net.w2[h]
        assert math.isclose(p, 1 / (1 + math.exp(-z / 1.7)), rel_tol=1e-6)


def windows_of(text, n=10):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(UPPER, LOWER)))
    return w, min(n, len(w))


def plain_decontamination(rows, items):
    found = collections.defaultdict(set)
    for r in items:
        w, size = windows_of(r.text)
        if r.item_id is not None and size:
            found[size] |= {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}
    for r in rows:
        w, _ = windows_of(r.text)
        if not any(tuple(w[i:i + size]) in got for size, got in found.items() for i in range(len(w) - size + 1)):
            yield r.doc_id


def plain_mix(rows):
    size = {id(r): len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows}
    total = collections.Counter()
    for r in rows:
        total[r.source] += size[id(r)]
    target, out = plain_targets(dict(total), MIX_WEIGHTS), collections.Counter()
    for source, words in total.items():
        e = min(target[source] / words, 2.0) if words else 0.0
        p, left, order = e - math.floor(e), target[source], []
        for r in rows:
            if r.source == source:
                out[r.doc_id] += math.floor(e)
                left -= size[id(r)] * math.floor(e)
                u = (int(hashlib.md5(f"{r.doc_id}:{r.text or ''}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
                if p > 0 and size[id(r)]:
                    order.append((u * (1 - p) / (u * (1 - p) + (1 - u) * p), r))
        for _, r in sorted(order, key=lambda x: x[0]):
            if size[id(r)] <= left:
                out[r.doc_id] += 1
                left -= size[id(r)]
    return +out


def test_pipeline_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    rows = docs.collect()
    clean = {r.doc_id for r in stages["toxicity"](spark, docs, SF).collect()}
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    some = sorted(rows, key=lambda r: len(r.text or ""))[:60]
    assert {r.doc_id for r in some if r.doc_id in clean} == {r.doc_id for r in some if plain_toxicity(r.text, model) < 0.3}
    kept = {r.doc_id for r in stages["decontamination"](spark, docs, SF).collect()}
    assert kept == set(plain_decontamination(rows, spark.read.parquet(f"{SF}/benchmark.parquet").collect())) and len(kept) < len(rows)
    masked = {r.doc_id: (r.text, r.n_chars) for r in stages["pii"](spark, docs, SF).collect()}
    tagger = pii.Tagger(pii.default_field())
    for r, spans in zip(rows, tagger.spans([r.text for r in rows])):
        text, cut = r.text, [(a, b, k) for a, b, k, _ in spans]
        assert all(x[1] <= y[0] for x, y in zip(cut, cut[1:])) or len(cut) < 2
        for a, b, kind in reversed(cut):
            text = f"{text[:a]}[{kind.upper()}]{text[b:]}"
        assert masked[r.doc_id] == (text, len(text) if cut else r.n_chars)
    copies = collections.Counter(r.doc_id for r in stages["mixing"](spark, docs, SF).collect())
    assert copies == plain_mix(rows)


def test_stages_with_awkward_rows(spark):
    """Nulls in any column, empty texts, repeated rows and no rows at all."""
    kind = spark.read.parquet(f"{SF}/documents.parquet").schema
    rows = [(1, "a b c d e f", "en", "s", 11), (1, "a b c d e f", "en", "s", 11), (2, None, None, None, None), (3, "", "", "", 0),
            (None, "a b c d e f g", "en", "s", 13), (4, "call +47 22 33 44 55 66 " * 3000, "no", None, 5)]
    for docs in (spark.createDataFrame(rows, kind), spark.createDataFrame([], kind)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.columns[:len(docs.columns)] == docs.columns, name
            got = out.collect()
            assert len(got) <= 2 * docs.count(), name
            if name == "near_dedup" and got:
                assert sorted((r.doc_id or 0 for r in got)) == [0, 1, 2, 3, 4]
