"""Operators that look at the whole corpus, against plain versions."""

import collections
import math
import random

import numpy as np
import pytest

from lakefold.llm import bm25, mixing, near_dup, quality, toxicity
from lakefold.llm.common import UPPER, LOWER

SF = "/root/testdata/sf0.001"


def docs_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, score string, copies string")


def extended(rows):
    return [(i, t, s, len(t or ""), "x", "y") for i, t, s in rows]


# --------------------------------------------------------- near duplicates

def plain_components(rows):
    sets = {}
    table = bytes.maketrans(UPPER.encode(), LOWER.encode())
    for i, text in rows:
        w = (text or "").encode().translate(table).split()
        sets[i] = frozenset(b" ".join(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((top(a), top(b)))
                root[q] = p
    return {i: (len(sets[i]), top(i)) for i in ids}


def edited(rng, words, share):
    return " ".join(rng.choice("abcdefgh") + str(rng.randint(0, 99)) if rng.random() < share else w for w in words)


def near_rows():
    rng = random.Random(9)
    rows, n = [], 1000
    for _ in range(8):
        base = [rng.choice("uvwxyz") + str(rng.randint(0, 400)) for _ in range(rng.randint(20, 120))]
        for _ in range(rng.randint(1, 30)):
            rows.append((n := n - 1, edited(rng, base, rng.choice([0, 0, 0.005, 0.01, 0.03, 0.06]))))
    shared = " ".join(f"passage{k}" for k in range(40))
    rows += [(n := n - 1, shared + " " + " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(60))) for _ in range(30)]
    rows += [(1, "one two"), (2, "ONE two"), (3, "one two three"), (4, ""), (5, " \n"), (6, None), (7, None),
             (8, "A\x85b c\td e"), (9, "a\x85B c d\x0be"), (10, "x " * 3000), (11, "x " * 4)]
    return rows


# The second makes trees split and blocks meet, the third lets nodes confirm links themselves.
@pytest.mark.parametrize("small, whole", [(1024, 48), (6, 48), (1024, 2)])
def test_near_duplicates_against_all_pairs(spark, small, whole):
    rows = near_rows()
    got = near_dup.duplicates(docs_frame(spark, extended([(i, t, "s") for i, t in rows])), near_dup.Settings(small=small, levels=2, whole=whole)).collect()
    want = plain_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)


def test_dedup_edge_rows(spark):
    text = " ".join(f"w{k}" for k in range(30))
    docs = docs_frame(spark, extended([(5, text, "a"), (5, text, "a"), (3, text + " more", "b"), (None, text, "c"), (None, None, "d"), (9, "", "e")]))
    got = sorted(((r.doc_id, r.source) for r in near_dup.deduplicate(docs).collect()), key=repr)
    assert got == sorted([(3, "b"), (9, "e"), (None, "c"), (None, "d")], key=repr)
    assert near_dup.deduplicate(docs).columns == docs.columns
    assert near_dup.duplicates(docs.limit(0)).count() == 0
    report = near_dup.duplicates(docs).collect()
    assert len(report) == 6 and {(r.doc_id, r.component_id, r.kept) for r in report if r.doc_id == 5} == {(5, 3, False)}


def words_of(rng, n, vocab=400):
    return [rng.choice("uvwxyz") + str(rng.randint(0, vocab)) for _ in range(n)]


def test_links_run_through_rows_without_id(spark):
    """1 and 2 are no copies of one another, but both of a row without id."""
    base = words_of(random.Random(1), 200)
    left, right = base[:], base[:]
    left[10:14], right[150:154] = words_of(random.Random(2), 4, 10**6), words_of(random.Random(3), 4, 10**6)
    for k in (40, 60, 80):
        left[k] = "left"
    for k in (100, 110, 120):
        right[k] = "right"
    rows = [(1, " ".join(left)), (2, " ".join(right)), (None, " ".join(base)), (3, "quite another text of few words")]
    sets = [near_dup.shingle_sets([t], 5).__next__() for _, t in rows[:3]]
    share = lambda a, b: len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert share(sets[0], sets[2]) >= 0.75 <= share(sets[1], sets[2]) and share(sets[0], sets[1]) < 0.75
    got = near_dup.duplicates(docs_frame(spark, extended([(i, t, "s") for i, t in rows]))).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(1, 1, True), (2, 1, False), (None, 1, False), (3, 3, True)}


def test_texts_of_one_id_link_each_by_itself(spark):
    a, b = words_of(random.Random(4), 30), words_of(random.Random(5), 30)
    rows = [(1, " ".join(a), "a"), (1, " ".join(b), "b"), (2, " ".join(b) + " more", "c"), (5, "", "d"), (5, "", "e"), (6, None, "f")]
    docs = docs_frame(spark, extended(rows))
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in near_dup.duplicates(docs).collect()}
    assert got == {(1, 26, 1), (2, 27, 1), (5, 0, 5), (6, 0, 6)}
    kept = sorted((r.doc_id, r.source) for r in near_dup.deduplicate(docs).collect())
    assert [i for i, _ in kept] == [1, 1, 5, 6] and kept[:2] == [(1, "a"), (1, "b")]  # two groups, both named 1


def test_dedup_moves_documents_beyond_the_broadcast_bound(spark, monkeypatch):
    rows = near_rows()[::3]
    rows = [(i, t, "s") for i, t in rows] + [(i, t, "again") for i, t in rows[:9]] + [(None, rows[0][1], "none")]
    docs = docs_frame(spark, extended(rows))
    want = sorted(map(str, near_dup.deduplicate(docs).drop("source").collect()))
    monkeypatch.setattr(near_dup, "_FEW", 0)
    assert sorted(map(str, near_dup.deduplicate(docs).drop("source").collect())) == want
    one = plain_components([(i, t) for i, t, _ in rows if i is not None])
    assert len(want) == 1 + sum(i == c for i, (_, c) in one.items())


def test_nodes_of_many_shingles_confirm_links_in_cells(spark):
    rng = random.Random(11)
    base = words_of(rng, 120)
    rows = [(k, edited(rng, base, rng.choice([0.01, 0.03, 0.05]))) for k in range(90)]
    s = near_dup.Settings(small=16, levels=1, whole=4, whole_items=1500)
    got = near_dup.duplicates(docs_frame(spark, extended([(i, t, "s") for i, t in rows])), s).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain_components(rows)


# ------------------------------------------------------------------ mixing

def plain_targets(sizes, weights):
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    out, open_ = {}, set(order)
    while open_:
        room = 1.5 * sum(sizes.values()) - sum(out.values())
        level = room / sum(w[s] for s in open_)
        full = {s for s in open_ if w[s] * level > 2 * sizes[s]}
        if not full:
            return out | {s: w[s] * level for s in open_}
        out |= {s: 2.0 * sizes[s] for s in full}
        open_ -= full
    return out


def test_mixing_reaches_targets(spark):
    rng = random.Random(6)
    rows, n = [], 0
    for source, many in (("a", 400), ("b", 30), ("é", 90), (None, 60), ("Z", 5)):
        rows += [(n := n + 1, "w " * rng.choice([0, 1, 5, 20, 90]), source) for _ in range(many)]
    rows += [(n + 1, None, "a"), (n + 2, "", "b"), (3, rows[2][1], rows[2][2])]
    docs = docs_frame(spark, extended(rows))
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = plain_targets(dict(sizes), [3.0, 1.0, 2.0])
    got = mixing.report(docs, [3.0, 1.0, 2.0]).collect()
    again = mixing.report(docs.repartition(7), [3.0, 1.0, 2.0]).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again)) and len(got) == len(rows)
    source = {i: s for i, _, s in rows}
    taken = collections.Counter()
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and math.isclose(r.target, want[source[r.doc_id]], rel_tol=1e-9)
        assert r.source_size == sizes[source[r.doc_id]] and (r.size == 0 or r.taken % r.size == 0)
        taken[source[r.doc_id]] += r.taken
    for s, t in want.items():
        assert t - 91 <= taken[s] <= t + 1e-6 + 90 * (s == rows[2][2])
    out = mixing.mix(docs, [3.0, 1.0, 2.0])
    assert out.columns == [c for c in docs.columns if c != "copy"] + ["copy"]
    words = collections.Counter()
    for r in out.collect():
        words[r.source] += len((r.text or "").split())
    assert {s: t for s, t in words.items() if t} == {s: t for s, t in taken.items() if t}
    assert mixing.report(docs.limit(0), [1.0]).count() == 0


def test_mixing_goes_past_documents_that_do_not_fit(spark):
    """Very long documents early in the order: what fits behind them is taken."""
    rng = random.Random(7)
    rows = [(k, "w " * rng.choice([3, 7, 50, 50, 50]), "a") for k in range(200)] + [(1000 + k, "w " * 9000, "a") for k in range(3)]
    rows += [(2000 + k, "w " * rng.randint(1, 400), "b") for k in range(40)] + [(3000, "w " * 77, None)]
    docs = docs_frame(spark, extended(rows))
    for weights in ([1.0], [1.0, 9.0, 1.0]):
        got = mixing.report(docs, weights).collect()
        for source in ("a", "b", None):
            mine = [r for r in got if (r.doc_id < 2000, 2000 <= r.doc_id < 3000, r.doc_id == 3000)["ab".find(source) if source else 2]]
            lacks = mine[0].target - sum(r.taken for r in mine)
            more = [r.size for r in mine if r.size and r.taken < r.size * math.ceil(mine[0].target / mine[0].source_size)]
            assert lacks >= 0 and (not more or lacks < min(more))  # no document is left that fits


def test_mixing_keeps_a_column_named_copy(spark):
    docs = spark.createDataFrame([(1, "a b", "s", "mine")], "doc_id long, text string, source string, copy string")
    out = mixing.mix(docs, [1.0])
    assert out.columns == ["doc_id", "text", "source", "copy", "copy_1"]
    assert [tuple(r) for r in out.collect()] == [(1, "a b", "s", "mine", 1)]


def test_mixing_joins_few_and_many_sources_alike(spark, monkeypatch):
    rows = [(k, "w " * (k % 13), f"s{k % 9}") for k in range(300)] + [(1, "w", "s1")] * 3
    docs = docs_frame(spark, extended(rows))
    want = sorted(map(tuple, mixing.report(docs, [3.0, 1.0]).collect()))
    monkeypatch.setattr(mixing, "FEW_SOURCES", 0)
    assert sorted(map(tuple, mixing.report(docs, [3.0, 1.0]).collect())) == want


def test_mixing_by_document_weight_prefers_heavy_ones(spark):
    rows = [(k, "w " * 10, "s", 0, "4" if k % 2 else "1", "") for k in range(400)]
    docs = docs_frame(spark, rows)
    sizes = mixing.sized(docs, weight_col="score")
    cut = mixing.cuts(sizes, [1.0], total=0.5)
    took = collections.Counter(r.doc_id % 2 for r in mixing.copies(sizes, cut).filter("copies > 0").collect())
    assert 198 <= sum(took.values()) <= 200 and took[1] > 2 * took[0]


# ------------------------------------------------------------- classifiers

def test_toxicity_shares_subwords_with_misspellings():
    rng = random.Random(8)
    vocab = ["river", "stone", "green", "walk", "maple", "window", "letter", "summer", "paper", "little"]
    texts, y = [], []
    for k in range(600):
        w = [rng.choice(vocab) for _ in range(30)]
        if k % 3 == 0:
            w[rng.randint(0, 29)] = rng.choice(["grobnik", "grobniks", "zathurl"])
        texts.append(" ".join(w))
        y.append(int(k % 3 == 0))
    model = toxicity.fit(texts, np.array(y), toxicity.Settings(epochs=10, decay=0.002))
    calm = " ".join(rng.choice(vocab) for _ in range(30))
    seen, unseen, plain = toxicity.score_texts([calm + " grobnik", calm + " grobnikk", calm], model)
    assert seen > 0.5 and unseen > 0.5 and plain < 0.3
    assert np.allclose(toxicity.score_texts(["", None], model), toxicity.score_texts([" "], model)[0])
    assert toxicity.score_texts([calm], toxicity.fit(texts, np.zeros(600, int), toxicity.Settings()))[0] < 0.01


def test_subword_buckets_against_plain_loops():
    from lakefold.llm.textnum import subwords

    words = ["a", "loser", "ñandú", "x" * 40]
    number, bucket = subwords(words, 3, 5, 1 << 20)
    for k, w in enumerate(words):
        marked = f"<{w}>"
        grams = sum(max(0, len(marked) - n + 1) for n in (3, 4, 5))
        assert (number == k).sum() == grams + 1
    one = {b for n, b in zip(*subwords(["abcdef"], 3, 3, 1 << 20))}
    two = {b for n, b in zip(*subwords(["zzabcdeq"], 3, 3, 1 << 20))}
    assert len(one & two) == 3  # abc, bcd, cde


@pytest.mark.parametrize("name", ["toxicity", "quality"])
def test_classifiers_on_tables_and_edges(spark, name):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    run = (lambda d, x: toxicity.with_toxicity(d, x, s=toxicity.Settings(clean=200, toxic=100, epochs=2))) if name == "toxicity" \
        else (lambda d, x: quality.with_quality(d, x, s=quality.Settings(low=100, good=200, epochs=20)))
    odd = spark.createDataFrame([(None, None, "e"), (-1, "", "e"), (-2, "w " * 50_000, "e"), (-2, "w " * 50_000, "e")], "doc_id long, text string, score string")
    both = docs.select("doc_id", "text", "source").withColumnRenamed("source", "score").unionByName(odd)
    odd_labels = labels.unionByName(labels.limit(3)).unionByName(spark.createDataFrame([(None, 1, 1), (0, None, None), (-77, 1, 1)], labels.schema))
    got = run(both, odd_labels).collect()
    assert len(got) == both.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert sorted(map(repr, got)) == sorted(map(repr, run(both, odd_labels).collect()))
    assert len({r.score for r in run(docs, labels.limit(0)).collect()}) == 1
    assert run(docs.limit(0), labels).count() == 0


def test_context_sums_against_plain_loops():
    s = quality.Settings(buckets=64, dim=6, window=2)
    index = quality.index_vectors(s)
    texts = ["a b c a !! d", "", "a", "b b b", None]
    want = np.zeros((64, 6), np.int64)
    for t in texts:
        tokens = quality._tokens([t or ""], 64)[0]
        for i, x in enumerate(tokens):
            for j in range(max(0, i - 2), min(len(tokens), i + 3)):
                if i != j:
                    want[x] += index[tokens[j]]
    assert (quality.context_sums(texts, s) == want).all()


# ------------------------------------------------------------------ search

def plain_search(rows, asked, s):
    from lakefold.llm.textnum import word_hashes

    bags = {i: collections.Counter((t or "").encode().translate(bm25._BYTES).split()) for i, t in rows if i is not None}
    n, mean = len(bags), sum(sum(c.values()) for c in bags.values()) / len(bags)
    df = collections.Counter(w for c in bags.values() for w in c)
    idf = {w: math.log(1 + (n - d + 0.5) / (d + 0.5)) for w, d in df.items()}
    key = dict(zip(df, word_hashes([w.decode("latin-1") for w in df]).view(np.int64).tolist()))
    out = {}
    for q in asked:
        terms = sorted(bags[q], key=lambda w: (-bags[q][w] * idf[w], key[w]))[: s.query_terms]
        score = {i: sum(idf[w] * c[w] * (s.k1 + 1) / (c[w] + s.k1 * (1 - s.b + s.b * sum(c.values()) / mean)) for w in terms if w in c)
                 for i, c in bags.items()}
        out[q] = sorted(((-round(x, 9), i) for i, x in score.items() if x > 0))[: s.k]
    return out


def test_search_against_all_scores(spark):
    rng = random.Random(10)
    vocab = [f"t{k}" for k in range(60)]
    rows = [(k, " ".join(rng.choices(vocab, [1 / (j + 1) for j in range(60)], k=rng.randint(0, 40)))) for k in range(400)]
    rows += [(400, None), (401, ""), (None, "t1 t2")]
    docs = docs_frame(spark, extended([(i, t, "s") for i, t in rows])).repartition(3)
    s = bm25.Settings(shard_docs=64, block=8, query_block=7, k=5, query_terms=6)
    got = collections.defaultdict(list)
    for r in bm25.similar(docs, docs["doc_id"] % 20 == 0, s).orderBy("query", "rank").collect():
        got[r["query"]].append((-round(r.score, 9), r.doc_id))
    want = {q: v for q, v in plain_search(rows, [i for i, _ in rows if i is not None and i % 20 == 0], s).items() if v}
    assert dict(got) == want
    assert bm25.similar(docs.limit(0), docs["doc_id"] % 20 == 0, s).count() == 0


def test_search_asks_every_word_of_long_documents(spark):
    rng = random.Random(12)
    rare = [f"rare{k}" for k in range(20)]
    tail = [f"tail{k}" for k in range(60)]
    rows = [(0, " ".join(rare * 3 + tail))]
    rows += [(k, " ".join(rare[:2])) for k in range(1, 9)] + [(k, " ".join(tail + ["other"])) for k in range(9, 13)]
    rows += [(k, " ".join(rng.choices(tail, k=30))) for k in range(13, 100)]
    docs = docs_frame(spark, extended([(i, t, "s") for i, t in rows])).repartition(3)
    s = bm25.Settings(shard_docs=32, block=4, pack=1, k=5)
    got = [(-round(r.score, 9), r.doc_id) for r in bm25.similar(docs, docs["doc_id"] == 0, s).orderBy("rank").collect()]
    assert got == plain_search(rows, [0], s)[0] and [i for _, i in got] == [0, 9, 10, 11, 12]
    asked = bm25.queries_of(docs.filter("doc_id = 0"), bm25.build(docs, s), len(rows), bm25.Settings())
    assert asked.count() == len(rare) + len(tail)


# ---------------------------------------------------------------- pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline
    from lakefold.llm import decontam, pii

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, SF)
        after = out.collect()
        if name != "mixing":
            assert out.columns == docs.columns and len(after) == len({r.doc_id for r in after}) <= len(before)
        if name == "near_dedup":
            want = plain_components([(i, r.text) for i, r in before.items()])
            assert {r.doc_id for r in after} == {i for i, (_, c) in want.items() if i == c}
        if name == "decontamination":
            hit = {r.doc_id for r in decontam.report(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).filter("contaminated").collect()}
            assert {r.doc_id for r in after} == set(before) - hit
        if name == "pii":
            assert all(r.n_chars == len(r.text) and not pii.base_spans(r.text) for r in after if r.text != before[r.doc_id].text)
            assert {r.doc_id for r in after} == set(before)
        if name in ("toxicity", "near_dedup", "decontamination"):
            assert all(tuple(r) == tuple(before[r.doc_id]) for r in after)
        docs = spark.createDataFrame(after, out.schema)
    assert docs.columns[-1] == "copy" and docs.filter("copy > 2").count() == 0


def test_long_queries_score_exactly_what_their_bounds_let_through():
    """Same rows and scores as block by block, ties and earlier shards' best included, whatever is a row of the matrix."""
    r = np.random.default_rng(7)
    n, words = 90, 400
    rows = [np.unique(r.zipf(1.3, 120) % words) for _ in range(n)]
    rows[50:60] = [rows[3]] * 10  # equal documents: ties go by id
    doc = np.repeat(np.arange(n), [len(x) for x in rows])
    term = np.concatenate(rows).astype(np.int64)
    order = np.lexsort((doc, term))
    terms, sizes = np.unique(term, return_counts=True)
    lengths = np.array([len(x) for x in rows], np.int32)
    counts = r.integers(1, 4, words)[term[order]].astype(np.int32)
    idf = np.log(1 + (n - sizes + 0.5) / (sizes + 0.5))
    queries = [(t, idf[np.searchsorted(terms, t)]) for t in map(np.sort, rows[:40])]
    queries += [(np.arange(1000, 1020), np.ones(20)), (terms[:3], idf[:3]), (terms[:0], idf[:0])]
    for dense, most, k in ((16, 4096, 10), (1, 4096, 3), (1000, 5, 10), (16, 4096, 200)):
        s = bm25.Settings(dense=dense, rows=most, k=k, block=8)
        shard = bm25.Shard(np.arange(n)[::-1].copy(), lengths, terms, sizes.astype(np.int32), doc[order].astype(np.int32), counts, lengths.mean(), s)
        assert len(shard.matrix) <= most
        for tops in ([[] for _ in queries], [[(-5.0, 1000 + i) for i in range(k)] for _ in queries]):
            want = [shard.best(t, w, top) for (t, w), top in zip(queries, tops)]
            assert shard.best_of(queries, tops) == want


def test_shards_hold_documents_of_like_words_and_find_the_same(spark):
    rng = random.Random(3)
    vocab = [[f"{p}{k}" for k in range(80)] for p in ("a", "b")]
    rows = [(k, " ".join(rng.choices(vocab[k % 2], [1 / (j + 1) for j in range(80)], k=rng.randint(20, 60)))) for k in range(400)]
    docs = docs_frame(spark, extended([(i, t, "s") for i, t in rows])).repartition(3)
    s = bm25.Settings(shard_docs=64, shard_postings=2000, block=8, k=5)
    index = bm25.stored(bm25.build(docs, s), "index")
    ids = [np.frombuffer(r.ids, np.int64) for r in index.filter("term IS NULL").collect()]
    assert sorted(np.concatenate(ids).tolist()) == list(range(400))
    assert len(ids) > 6 and all(len(set((x % 2).tolist())) == 1 and len(x) <= 64 for x in ids)
    asked = docs["doc_id"] % 20 == 0
    got = collections.defaultdict(list)
    for r in bm25.search(index, bm25.queries_of(docs.filter(asked), index, 400, s), s).orderBy("query", "rank").collect():
        got[r["query"]].append((-round(r.score, 9), r.doc_id))
    assert dict(got) == plain_search(rows, range(0, 400, 20), s)


def test_first_scores_are_reached_and_floors_lose_nothing():
    """What the first shards promise a query is no more than their k-th best, and with it as a floor the best are the same."""
    r = np.random.default_rng(11)
    n, words = 200, 300
    rows = [np.unique(r.zipf(1.2, r.integers(5, 150)) % words) for _ in range(n)]
    rows[60:75] = [rows[9]] * 15
    doc = np.repeat(np.arange(n), [len(x) for x in rows])
    term = np.concatenate(rows).astype(np.int64)
    order = np.lexsort((doc, term))
    terms, sizes = np.unique(term, return_counts=True)
    lengths = np.array([len(x) for x in rows], np.int32)
    idf = np.log(1 + (n - sizes + 0.5) / (sizes + 0.5))
    asked = [(t, idf[np.searchsorted(terms, t)]) for t in map(np.sort, rows[:60])]
    block = bm25.Asked.of(np.arange(60), [len(t) for t, _ in asked], [t for t, _ in asked], [w for _, w in asked])
    for few, dense, chunk in ((32, 16, 65_536), (1, 16, 50), (10_000, 4, 50), (32, 1000, 7)):
        s = bm25.Settings(few=few, dense=dense, chunk=chunk, block=8, product=7)
        shard = bm25.Shard(np.arange(n), lengths, terms, sizes.astype(np.int32), doc[order].astype(np.int32), np.ones(len(doc), np.int32), lengths.mean(), s)
        want = [shard.best(t, w) for t, w in asked]
        kth = np.array([-top[9][0] if len(top) > 9 else 0.0 for top in want])
        one, floor = [[] for _ in asked], np.zeros(60)
        shard.search(block, one, floor, final=False)
        assert (floor <= kth).all() and (floor >= kth * (1 - 1e-3)).all()
        assert all(len(a) == len(b) and all(-x <= -y for (x, _), (y, _) in zip(a, b)) for a, b in zip(one, want))
        for start in (floor, kth * (1 - 1e-12), kth):
            found, least = [[] for _ in asked], start.copy()
            shard.search(block, found, least)
            assert found == want
        other = [(t, w * r.uniform(0, 2, len(t))) for t, w in asked]  # every query weighs its terms in its own way
        assert shard.best_of(other, [[] for _ in asked]) == [shard.best(t, w) for t, w in other]
        again, least = [[] for _ in asked], floor.copy()
        shard.search(block, again, least, final=False)  # now few documents are open
        assert (least <= kth).all() and all(-x <= -y for a, b in zip(again, want) for (x, _), (y, _) in zip(a, b))
