"""Phrase collocations against plain counts."""

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from math import floor

import numpy as np
import pytest

from lakefold.llm import collocations
from lakefold.llm.collocations import Settings
from lakefold.llm.common import LOWER, UPPER

SCHEMA = "doc_id long, text string, lang string, phrase string, n long"


def plain(rows, s):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        n[lang] += 0
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(str.maketrans(UPPER, LOWER))):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, s.longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    for lang in f:
        c = {p: a for p, a in f[lang].items() if len(p) >= 2 and a >= s.least}
        out = []
        for p, a in c.items():
            inside = (q for q in c if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)))
            if any(100 * c[q] >= s.inside * a for q in inside):
                continue
            cuts = [(floor(Fraction(10**6 * a * a, f[lang][p[:k]] * f[lang][p[k:]])), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out.append((-score, -a, " ".join(p).encode(), a, f[lang][p[:k]], f[lang][p[k:]], score))
        for rank, (_, _, p, a, l, r, score) in enumerate(sorted(out)[:s.top], 1):
            yield lang, rank, p.decode(), a, l, r, n[lang], score


def texts():
    rng = random.Random(3)
    words = ["the", "The", "of", "a", "ß", "É", "x\x01", "don't", "new", "york", "city", " ", "a\x1cb"]
    weights = [30, 5, 20, 10, 3, 2, 2, 3, 2, 2, 2, 1, 1]
    for i in range(160):
        some = rng.choices(words, weights, k=rng.randint(0, 200))
        if i % 3 == 0:
            some += ["San", "Francisco", "Bay"] * rng.randint(1, 2)
        text = "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".\n", "\x0b", "? "]) for w in some)
        yield i, text, rng.choice(["en", "en", "en", None, "de"]), "x", 1
    for i, t in enumerate([None, "", "...", " ", "one"]):
        yield 1000 + i, t, "fr", "x", 1
    yield 2000, "of the " * 9000, "en", "x", 1                    # one text, a very frequent pair
    yield 2001, "und " + " ".join(f"w{k}" for k in range(5000)), "und", "x", 1


@pytest.mark.parametrize("s", [
    Settings(),
    Settings(entries=300, bytes=300, burst=8, chunk=16, salts=2),  # spills, bursts and cuts inside texts
    Settings(longest=2, least=3, inside=60, top=5, entries=50, bytes=40, burst=4, chunk=4),
    Settings(longest=4, least=4, entries=1000, bytes=3000, burst=2),
])
def test_collocations_equal_plain_counts(spark, s):
    rows = list(texts())
    rows += rows[:20]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = [tuple(r) for r in collocations.collocations(docs, s).collect()]
    assert sorted(got) == sorted(plain([(r[1], r[2]) for r in rows], s))


def test_no_rows_and_no_words(spark):
    docs = spark.createDataFrame([(1, None, None, "", 0), (2, " . ", "en", "", 0)], SCHEMA)
    assert collocations.collocations(docs).collect() == []
    assert collocations.collocations(docs.limit(0)).collect() == []


def test_counts_whose_product_passes_64_bits(spark):
    """l and r of several thousand millions: scored from given counts."""
    a, l, r = 6_000_000_000, 7_000_000_001, 6_500_000_003
    counts = spark.createDataFrame([("en", "new york", 2, a), ("en", "new", 1, l), ("en", "york", 1, r), ("en", "", 0, 10**11)],
                                   "lang string, phrase string, words int, f long")
    import lakefold.llm.collocations as C
    was = C.phrase_counts
    C.phrase_counts = lambda docs, s: counts
    try:
        got = C.collocations(counts).first()
    finally:
        C.phrase_counts = was
    assert got.score == 10**6 * a * a // (l * r) and got.n == 10**11


def test_trie_bursts_and_spills_whole_subtrees():
    t = collocations._Trie(Settings(burst=4, shared=2), 21)
    keys = np.array([(w << 42) | (x << 21) for w in (1, 2, 3) for x in range(1, 4 * w)], np.int64)
    for _ in range(2):
        t.add(keys, np.ones(len(keys), np.int64))
    assert set(t.words.values()) == {2, 3} and t.nodes  # frequent words have containers of their own, and these burst
    t.add(keys[:2], np.array([5, 6]))
    want = dict.fromkeys(keys.tolist(), 2) | {int(keys[0]): 7, int(keys[1]): 8}
    k, c = t.spill(12)
    assert {int(x) >> 42 for x in k} == {3} and t.size == len(keys) - len(k)  # the largest subtree went whole
    rest, more = t.spill(0)
    assert dict(zip(np.append(k, rest).tolist(), np.append(c, more).tolist())) == want and t.size == 0


@pytest.mark.parametrize("bytes_", [0, 1 << 30])
def test_counts_add_up_alike_in_narrow_and_wide_offsets(monkeypatch, bytes_):
    import pyarrow as pa

    from lakefold.llm import collocations as C

    monkeypatch.setattr(C, "_SMALL", bytes_)
    t = pa.concat_tables([pa.table({"phrase": pa.array(p, pa.large_binary()), "f": pa.array(f, pa.int64())})
                          for p, f in (([b"", b"a b", b"\xff c"], [9, 1, 2]), ([b"a b", b"z"], [5, 1 << 40]), ([], []))])
    got = C._added(t)
    assert got.schema.field("phrase").type == pa.large_binary()
    assert dict(zip(*got.to_pydict().values())) == {b"": 9, b"a b": 6, b"\xff c": 2, b"z": 1 << 40}
