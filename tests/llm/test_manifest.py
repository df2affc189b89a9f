"""The Merkle manifest against a plain tree."""

import hashlib
import random
import zlib
from collections import defaultdict

from lakefold.llm import manifest
from lakefold.llm.common import LOWER, UPPER

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g string, leaf string, pos int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def beside(levels, i):
    for level in levels[:-1]:
        a = i // 16 * 16
        yield "".join(level[a:i]), "".join(level[i + 1:a + 16])
        i //= 16


def plain(rows):
    by = defaultdict(list)
    lower = str.maketrans(UPPER, LOWER)
    for r in rows:
        leaf = sha(*(field(r[c]) for c in manifest.FIELDS))
        other = None
        if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0:
            changed = dict(r, text=r["text"] and r["text"].translate(lower))
            other = sha(*(field(changed[c]) for c in manifest.FIELDS))
        by[r["source"]].append((r["doc_id"], leaf, other))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    own = {}
    for s in sources:
        by[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        own[s] = tree([x[1] for x in by[s]])
    top = tree([own[s][-1][0] for s in sources])
    for k, s in enumerate(sources):
        for i, (doc_id, leaf, other) in enumerate(by[s]):
            steps = [*beside(own[s], i), *beside(top, k)]
            cur = other or leaf
            for left, right in steps:
                cur = sha(left, cur, right)
            proof = sha(*(x + y for x, y in steps))
            yield doc_id, leaf, own[s][-1][0], top[-1][0], proof, cur, cur == top[-1][0]


def awkward(n):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        text = rng.choice(["a", "É b", "", None, f"Word{i}", "Long " * rng.randint(1, 3000)])
        source = rng.choice([None, "hot", "hot", "hot", "é", "", *(f"s{k}" for k in range(20))])
        rows.append((None if i % 40 == 0 else i % (n * 2 // 3 + 1), text, rng.choice(["en", None]), source, rng.choice([None, i]), "x", "y", 3))
    return rows + rows[:n // 10]


def same(docs):
    key = lambda r: tuple(map(str, r))
    got = sorted(map(tuple, manifest.lowered_fifth(docs).collect()), key=key)
    assert got == sorted(plain([r.asDict() for r in docs.collect()]), key=key)
    return got


def test_manifest_with_nulls_ties_repeats_and_clashing_columns(spark):
    got = same(spark.createDataFrame(awkward(700), SCHEMA))
    assert {r[-1] for r in got} == {True, False}


def test_manifest_of_single_rows_single_sources_and_nothing(spark):
    docs = spark.createDataFrame(awkward(40), SCHEMA)
    assert same(docs.limit(1))[0][4] == sha()  # no siblings at all
    for n in (16, 17):
        same(docs.limit(n).withColumn("source", manifest.F.lit("one")))
    assert manifest.lowered_fifth(docs.limit(0)).collect() == []


def test_a_change_anywhere_changes_the_root(spark):
    docs = spark.createDataFrame(awkward(60), SCHEMA).filter("doc_id IS NOT NULL")
    root = manifest.manifest(docs).first().root
    for c, v in (("lang", "de"), ("source", "other"), ("n_chars", 9999), ("text", "changed")):
        value = manifest.F.when(manifest.F.col("doc_id") == 7, manifest.F.lit(v)).otherwise(manifest.F.col(c))
        assert manifest.manifest(docs.withColumn(c, value.cast(docs.schema[c].dataType))).first().root != root


def test_offsets_joined_by_key_when_they_are_many(spark, monkeypatch):
    monkeypatch.setattr(manifest, "BROADCAST_ROWS", 0)
    same(spark.createDataFrame(awkward(120), SCHEMA))
