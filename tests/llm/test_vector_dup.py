"""Embedding near duplicates against all pairs."""

import math

import numpy as np
import pytest

from lakefold.llm import vector_dup
from lakefold.llm.vector_dup import Settings

SCHEMA = "vec_id long, embedding array<float>, label int, key long, cell string, v string"


def plain(rows, least=0.95):
    fine = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links, root = [0] * len(rows), list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fine:
        for b in fine:
            if a < b and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= least:
                    links[a] += 1
                    links[b] += 1
                    p, q = sorted((top(a), top(b)))
                    root[q] = p
    names = {}
    for i, (vec_id, _) in enumerate(rows):
        names.setdefault(top(i), []).append(vec_id)
    names = {t: min((x for x in ids if x is not None), default=None) for t, ids in names.items()}
    return sorted((str(rows[i][0]), links[i], str(names[top(i)])) for i in range(len(rows)))


def vectors(n, groups, dim=24, seed=1):
    """Random directions; groups of copies with noise; pairs at chosen angles."""
    rng = np.random.default_rng(seed)
    out = list(rng.standard_normal((n, dim)))
    for size, noise in groups:
        base = rng.standard_normal(dim)
        out += [base * rng.uniform(0.1, 9) + rng.standard_normal(dim) * noise * rng.uniform(0, 2) for _ in range(size)]
    for cos in np.linspace(0.9, 0.99, 30):
        x = rng.standard_normal(dim)
        y = rng.standard_normal(dim)
        y -= x * (x @ y) / (x @ x)
        out += [x, x * cos + y / np.linalg.norm(y) * np.linalg.norm(x) * math.sqrt(1 - cos * cos)]
    order = rng.permutation(len(out))
    return [(int(k), [float(np.float32(x)) for x in out[i]]) for k, i in enumerate(order)]


def found(spark, rows, s=Settings()):
    table = spark.createDataFrame([(i, v, 0, 1, "x", "y") for i, v in rows], SCHEMA)
    got = vector_dup.duplicates(table, s).collect()
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    return sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got)


def odd_rows():
    rows = vectors(60, [(6, 0.1)])
    rows += [(900, None), (901, []), (902, [0.0] * 24), (903, [float("nan")] * 24), (904, [None] + [1.0] * 23),
             (905, [float("inf")] * 24), (None, rows[0][1]), (rows[1][0], rows[2][1]), (906, [2.0 * x for x in rows[3][1]]),
             (907, [1.0]), (908, [3.0]), (909, [-1.0]), (None, None), (910, [x * 1e-30 for x in rows[4][1]])]
    return rows + rows[:3]


def test_nulls_repeats_lengths_and_clashing_columns(spark):
    rows = odd_rows()
    assert found(spark, rows) == plain(rows)
    assert found(spark, rows[60:61]) == plain(rows[60:61])


def test_nothing(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert vector_dup.duplicates(table).collect() == []
    assert [tuple(r) for r in vector_dup.duplicates(spark.createDataFrame([(1, None, 0, 1, "", "")], SCHEMA)).collect()] == [(1, 0, 1, True)]


@pytest.mark.parametrize("s", [
    Settings(),
    Settings(small=16, block=32),                # many cells; large ones in blocks, dense groups taken out
    Settings(small=100_000, block=25),           # one cell, all in blocks
    Settings(small=8, block=16, margin=0.5),
])
def test_links_of_groups_copies_and_pairs_at_the_threshold(spark, s, monkeypatch):
    monkeypatch.setattr(vector_dup, "_FEW", 3)  # joins instead of broadcasts
    rows = vectors(150, [(120, 0.0), (90, 0.05), (60, 0.16), (5, 0.1)])
    want, got = plain(rows), found(spark, rows, s)
    assert sum(x[1] for x in got) >= 0.999 * sum(x[1] for x in want)
    assert [x[0] for x in got] == [x[0] for x in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want))  # none below the threshold
    assert sum(g != w for g, w in zip(got, want)) <= 2


def test_collisions_are_calibrated():
    s = Settings()
    rng = np.random.default_rng(0)
    x = rng.standard_normal((4000, 64))
    y = rng.standard_normal((4000, 64))
    y -= x * (x * y).sum(1, keepdims=True) / (x * x).sum(1, keepdims=True)
    y = vector_dup.units(x) * s.cosine + vector_dup.units(y) * math.sqrt(1 - s.cosine**2)
    lines = rng.standard_normal((64, s.lines))
    a, b = (np.rint(v @ lines * 28) for v in (vector_dup.units(x), y))
    hits = (np.abs(a - b) <= s.steps).sum(1)
    assert (hits >= vector_dup.least_collisions(s)).mean() >= s.recall
    far = (np.abs(a - np.roll(a, 1, 0)) <= s.steps).sum(1)
    assert (far >= vector_dup.least_collisions(s)).mean() < 0.001  # and random pairs seldom pass
