"""Operators that look at one row at a time, against plain versions."""

import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from lakefold.llm import decontam, html_text, licenses, pii, token_count

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def texts(spark):
    return [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]


def frame(spark, rows, schema="doc_id long, text string, score string, n_words string"):
    """Documents with extra columns whose names clash with results."""
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], schema)


# ------------------------------------------------------------ token counts

def test_token_counts_equal_the_library(texts):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(4)
    alphabet = "aaabcdeéñ \n\t▁ 012日本😀ﬁß\x00<>=+ÄÖthe  "
    odd = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 200))) for _ in range(300)]
    odd += ["a" * n for n in range(60)] + [" " * n for n in range(40)] + ["ab" * 4000, "日本語" * 1500, "<s> </s> <unk>", "", None]
    both = texts + odd
    assert token_count.count_texts(both, MODEL).tolist() == [len(model.encode(t or "")) for t in both]


def test_token_counts_with_clashing_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b", 9), (1, "a b", 9), (None, None, 9), (2, "", 9)], "doc_id long, text string, n_tokens int")
    got = [tuple(r) for r in token_count.with_token_counts(docs, MODEL, 1).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()]
    assert got == [(1, 3, 2, True), (1, 3, 2, True), (None, 0, 0, False), (2, 0, 0, False)]
    assert token_count.with_token_counts(docs.limit(0), MODEL).collect() == []


# --------------------------------------------------------- decontamination

def plain_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_hits(text, items, n=10):
    w = plain_words(text)
    hit, found = set(), set()
    for item, body in items:
        v = plain_words(body)
        if item is None or not v:
            continue
        size = min(n, len(v))
        for k in range(len(v) - size + 1):
            for i in range(len(w) - size + 1):
                if w[i:i + size] == v[k:k + size]:
                    hit.update(range(i, i + size))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


def test_decontamination_against_brute_force(spark):
    rng = random.Random(1)
    vocab = ["un", "Deux", "drei", "é", "FOUR", "5"]
    some = lambda n: rng.choice([" ", ", ", "--", "\n"]).join(rng.choice(vocab) for _ in range(n))
    items = [(k, some(rng.randint(0, 6))) for k in range(12)] + [(12, None), (None, "un deux drei"), (3, "é é é")]
    docs = [(k, some(rng.randint(0, 60))) for k in range(60)] + [(60, None), (61, ""), (61, ""), (None, items[2][1])]
    d, b = frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    for limit in (20_000, 5):  # one automaton, and several
        got = decontam.with_hits(d, b, n=3, max_patterns=limit).select("doc_id", "text", "hits").collect()
        assert len(got) == len(docs)
        for r in got:
            words, hit, found = plain_hits(r.text, items, 3)
            assert (r.hits.n_words, r.hits.n_hit, list(r.hits["items"])) == (words, hit, found)
            spans = list(zip(r.hits.spans[::2], r.hits.spans[1::2]))
            assert sum(len(plain_words(r.text[a:e])) for a, e in spans) == hit
    clean = decontam.decontaminate(d, b, n=3)
    assert clean.columns == d.columns
    assert clean.count() == sum(plain_hits(t, items, 3)[1] == 0 for _, t in docs)
    assert decontam.report(d, b.limit(0)).filter("contaminated").count() == 0
    assert decontam.report(d.limit(0), b).count() == 0


# ----------------------------------------------------------- personal data

def plain_spans(text):
    out = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((*m.span(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()]
        check = sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(digits[::-1]))
        if 14 <= len(digits) <= 19 and check % 10 == 0:
            out.append((*m.span(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((*m.span(), "phone"))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_base_spans_against_the_patterns(texts):
    rng = random.Random(2)
    odd = ["".join(rng.choice("a.@-+ 1234567890()%é_b") for _ in range(rng.randint(0, 80))) for _ in range(4000)]
    odd += ["1.2.3.4.5.6.7.8 300.1.1.1 010.0.0.1", "a@b@c.de x@y.z.w@q.r", "4111 1111 1111 1111", "+1 (212) 555-0187x"]
    odd += ["".join(rng.choice("0123456789") for _ in range(16)) for _ in range(200)]
    for t in texts + odd:
        assert pii.base_spans(t) == plain_spans(t)
    assert pii.base_spans("0" * 50_000 + ".1.1.1") and not pii.base_spans("9" * 50_000 + ".1.1.1" + "a" * 200_000)


def test_field_decodes_like_plain_viterbi():
    field = pii.default_field()
    tagger = pii.Tagger(field)
    rng = random.Random(3)
    vocab = [w for line in pii.TABLE for w in pii.parse(line)[0]]
    lines = [" ".join(rng.choice(vocab) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    lines += [" ".join(pii.parse(x)[0]) for x in pii.TABLE]
    labels, offsets = tagger.labels(lines)
    for k, line in enumerate(lines):
        tokens = pii._TOKEN.findall(line)
        if not tokens:
            continue
        types = np.array([0, 0, *(tagger.known[t] for t in tokens), 0, 0])
        scores = tagger.scores.at(types, np.arange(len(tokens)))
        best = scores[0]
        back = []
        for row in scores[1:]:
            step = best[:, None] + field.steps
            back.append(step.argmax(0))
            best = step.max(0) + row
        path = [int(best.argmax())]
        for b in back[::-1]:
            path.append(int(b[path[-1]]))
        assert labels[offsets[k]:offsets[k + 1]].tolist() == path[::-1]


def test_field_learns_its_table_and_adds_spans():
    tagger = pii.Tagger(pii.default_field())
    wrong = sum(tagger.labels([" ".join(pii.parse(x)[0])])[0].tolist() != pii.parse(x)[1] for x in pii.TABLE)
    assert wrong <= 2
    text = "call (212) 555-0199 or mail jo dot li at post dot example dot com"
    added = [(k, text[a:b]) for a, b, k, base in tagger.spans([text])[0] if not base]
    assert ("phone", "(212) 555-0199") in added and added[-1] == ("email", "jo dot li at post dot example dot com")
    assert tagger.spans(["the cat looked at a dog on the mat at noon", None, ""]) == [[], [], []]


def test_only_parts_are_read_and_spans_are_those_of_whole_texts(texts, monkeypatch):
    rng = random.Random(4)
    words = [w for t in texts if t for w in t.split()]
    lines = [re.sub(r"\{\w+\|([^}]*)\}", r"\1", x) for x in pii.TABLE]
    odd = []
    for _ in range(600):
        bits = [rng.choice([rng.choice(lines), " ".join(rng.sample(words, rng.randint(1, 60))), "".join(rng.choices("a.@ 12()[]%_٣", k=9))])
                for _ in range(rng.randint(1, 9))]
        odd.append(rng.choice([" ", "\n", " . "]).join(bits))
    tagger, read = pii.Tagger(pii.default_field()), []
    monkeypatch.setattr(tagger, "part_labels", lambda parts, *a, f=tagger.part_labels: read.append(sum(map(len, parts))) or f(parts, *a))
    got, n = tagger.spans(texts), sum(read)
    assert n < 0.5 * sum(len(t) for t in texts if t)  # all of it was read before
    got += tagger.spans(odd)
    monkeypatch.setattr(pii, "_MARGINS", ())  # whole texts
    assert got == pii.Tagger(pii.default_field()).spans(texts + odd)
    assert sum(not base for spans in got for *_, base in spans) > 300


def test_redaction_keeps_rows_and_columns(spark):
    docs = spark.createDataFrame([(1, "mail a.b@c.de now", 17, "k"), (None, None, None, "k"), (2, "", 0, "k"), (2, "", 0, "k")],
                                 "doc_id long, text string, n_chars long, spans string")
    got = [tuple(r) for r in pii.redact(docs).collect()]
    assert got == [(1, "mail [EMAIL] now", 16, "k"), (None, None, None, "k"), (2, "", 0, "k"), (2, "", 0, "k")]
    assert pii.report(docs.limit(0)).count() == 0
    r = pii.report(docs).collect()
    assert (r[0].n_email, r[0].spans) == (1, "email:5:13") and r[1].spans == ""


# ------------------------------------------------------------------- pages

PROSE = "One sentence, with commas, and with enough words to look like prose in an article. " * 3


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("<a \"", ""), ("plain only", "plain only"), ("&lt;b&gt; 5 < 6 &#233;", "<b> 5 < 6 é"),
    (f"<nav>m</nav><div class='sidebar'><p>{PROSE}</p></div><article><h1>H &amp; h</h1><p>a<b>b</b>\n c<br>d<p>{PROSE}</article><footer>f</footer>",
     f"H & h ab c d {PROSE}".strip()),
    (f"<div id=main><p>x {PROSE}</p><p>y {PROSE}</p></div><div class=comments><p>{PROSE}</p><p>{PROSE}</p></div>", f"x {PROSE} y {PROSE}"),
    (f"<div id='cookie-notice'><p>{PROSE}</p></div><main><p>{PROSE}</p><aside>{PROSE}</aside><form><p>{PROSE}</p></form></main>", PROSE),
    (f"<script>var t='<p>{PROSE}</p>';</script><style>p{{}}</style><p>{PROSE}</p><!-- <p>no</p> -->", PROSE),
])
def test_main_text(page, want):
    assert html_text.main_text(page) == " ".join(want.split())


def test_main_text_keeps_all_parts_of_long_articles():
    part = f"<p>{PROSE}</p>"
    want = " ".join(f"The headline {' '.join([PROSE] * 22)} one two a b Said so. The end.".split())
    inner = (f"<h1>The headline</h1><div class=intro>{part * 2}</div><div class=body>{part * 20}</div><ul><li>one</li><li>two</li></ul>"
             "<table><tr><td>a</td><td>b</td></tr></table><blockquote>Said so.</blockquote><h2>The end.</h2>")
    menu = "<div>" + "<a href=/x>Some other page</a> " * 8 + "</div>"
    for name in ("article", "main", "section", "div"):
        assert html_text.main_text(f"<html><body>{menu}<{name}>{inner}</{name}>{menu}</body></html>") == want
        assert html_text.main_text(f"<html><body>{menu}<div><{name}>{inner}{menu}</{name}></div></body></html>") == want
    assert html_text.main_text(f"<html><body>{menu}{inner}{menu}</body></html>") == want


BODY = "".join(f"<p>{k} {PROSE}</p>" for k in range(6))
READ = " ".join(f"{k} {PROSE}".strip() for k in range(6))
TEASER = "<div><h3>Read next</h3><p>The new one, see here, is short.</p></div><div><b>Jane Doe</b> writes on things.</div>"


@pytest.mark.parametrize("page, want", [
    (f"<div class='research search-tips'>{BODY}</div>", READ), (f"<div id='copyright-law'>{BODY}</div>", READ),
    (f"<div class='page has-sidebar'>{BODY}</div><div class=sidebar><p>{PROSE}</p></div>", READ),
    (f"<div class='nav-open'><article>{BODY}</article></div><div class=legal><p>All rights, and more.</p></div>", READ),
    (f"<article>{BODY}<div class=review><p>{PROSE}</p></div><div class=legal><p>{PROSE}</p></div><section class=print><p>{PROSE}</p></section></article>",
     READ + f" {PROSE}" * 3),
    (f"<article><h1>H</h1>{BODY}</article>{TEASER}", "H " + READ), (f"<h1>H</h1><article>{BODY}</article>{TEASER}", "H " + READ),
    (f"<div class=wrap><div class=text><h1>H</h1>{BODY}</div>{TEASER}</div>", "H " + READ),
    (f"<article>{BODY}<h2>Sources</h2><ul><li><a href=a>A long title of some study</a></li><li><a href=b>Another long title of a study</a></li></ul>"
     "<ul><li><a href=c>Home</a></li><li><a href=d>More</a></li></ul></article>",
     READ + " Sources A long title of some study Another long title of a study"),
    (f"<div class=text>{BODY}</div><div class=search><p>Find, or look for, pages.</p></div>", READ),
])
def test_names_and_neighbours(page, want):
    assert html_text.main_text(page) == " ".join(want.split())


def test_page_report_with_repeats_clashing_columns_and_nothing(spark):
    rows = [(1, "u", f"<article><p>{PROSE}</p></article>", "mine", 5), (1, "u", None, "mine", 5), (None, None, "", None, None)]
    pages = spark.createDataFrame(rows + rows[:1], "page_id long, url string, html string, text string, n_chars int")
    got = [tuple(r) for r in html_text.report(pages).collect()]
    one = (1, "u", PROSE.strip(), len(PROSE.strip()))
    assert got == [one, (1, "u", "", 0), (None, None, "", 0), one]
    assert html_text.report(pages.limit(0)).collect() == []


def test_pages_of_the_tables_give_their_articles(spark):
    import html

    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r.page_id: r.text for r in html_text.report(spark.read.parquet(f"{SF}/pages.parquet")).collect()}
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        assert got[r.page_id] == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner))).split())


# ---------------------------------------------------------------- licences

def test_patience_alignment():
    assert licenses.align("a b c d e".split(), "a x c d y e".split()) == [(0, 0), (2, 2), (3, 3), (4, 5)]
    assert licenses.align([], ["a"]) == []
    rng = random.Random(5)
    for _ in range(200):
        a, b = ([rng.choice("abcdefgh") for _ in range(rng.randint(0, 12))] for _ in range(2))
        got = licenses.align(a, b)
        assert all(a[i] == b[k] for i, k in got) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))
    for _ in range(50):  # the longest rising run, against all subsets
        pairs = [(i, rng.randint(0, 9)) for i in range(9)]
        runs = ([pairs[k][1] for k in range(9) if m >> k & 1] for m in range(512))
        assert len(licenses._rising(pairs)) == max(len(v) for v in runs if all(x < y for x, y in zip(v, v[1:])))


def test_licences_found_with_places(spark):
    finder = licenses.Finder(licenses.NOTICES, licenses.Settings())
    for name, notice in licenses.NOTICES:
        text = f"Some words first. {notice} And some words after that."
        got = finder.find(text)
        assert [g["license"] for g in got] == [name] and got[0]["coverage"] == 1.0
        assert text[got[0]["start"]:got[0]["end"]].startswith(notice.split()[0])
    assert finder.find("this is no license at all") == [] and finder.find(None) == [] and finder.find("license " * 3000) == []
    docs = spark.createDataFrame([(1, "Licensed under CC BY 4.0.", 1), (None, None, 2), (2, "", 3)], "doc_id long, text string, coverage int")
    assert [(r.doc_id, r.licenses, r.n_notices) for r in licenses.report(docs).collect()] == [(1, "CC-BY-4.0", 1), (None, "", 0), (2, "", 0)]


def test_licences_side_by_side():
    finder = licenses.Finder(licenses.NOTICES, licenses.Settings())
    for name, notice in licenses.NOTICES:
        for text in (f"{notice} {notice}", f"foo: {notice} bar: {notice}", f"x {notice}\n" * 5):
            got = finder.find(text)
            assert [g["license"] for g in got] == [name] * text.count(notice)
            assert all(g["coverage"] == 1.0 and text[g["start"]:g["end"]] in notice for g in got)
    mixed = "Licensed under CC BY 4.0. Licensed under CC BY-SA 4.0. Released under the MIT License. Licensed under the MIT License."
    assert [g["license"] for g in finder.find(mixed)] == ["CC-BY-4.0", "CC-BY-SA-4.0", "MIT", "MIT"]


BSD = [body for name, body in licenses.NOTICES if "Redistributions in binary form" in body]


@pytest.mark.parametrize("text, names", [
    (BSD[0] + " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS", ["BSD-3-Clause"]), (BSD[1] + " BY THE AUTHOR ``AS IS''", ["BSD-2-Clause"]),
    (f"{BSD[1]} BY X. {BSD[0]}", ["BSD-2-Clause", "BSD-3-Clause"]),
    ("# SPDX-License-Identifier: BSD-2-Clause\nimport x", ["BSD-2-Clause"]), ("// SPDX-License-Identifier: MIT", ["MIT"]),
    ("SPDX-License-Identifier: MPL-1.1", []), ("Licensed under the GNU GPL v3.", ["GPL-3.0"]), ("Licensed under the GNU GPL v4.", []),
    ("Some prose that ends here. All rights reserved.", ["reserved"]), ("Copyright 2031 Some One. All rights reserved.", ["reserved"]),
    ("He reserved all rights of way.", []),
])
def test_kin_are_told_apart(text, names):
    assert [g["license"] for g in licenses.Finder(licenses.NOTICES, licenses.Settings()).find(text)] == names


def test_licence_report_with_repeats_and_nothing(spark):
    docs = spark.createDataFrame([(1, "All rights reserved.", "x"), (1, "All rights reserved.", "x")], "doc_id long, text string, licenses string")
    assert [tuple(r) for r in licenses.report(docs).collect()] == [(1, 1, "reserved", "reserved:0:19", 1.0)] * 2
    assert licenses.report(docs.limit(0)).collect() == []


@pytest.mark.parametrize("text", [
    "Licensed under the BSD License.", "Licensed under CC BY-ND 4.0.", "Licensed under CC BY-NC-SA 4.0.", "Licensed under CC BY 3.0.",
    "This work is licensed under the GNU Lesser General Public License, version 3.",
    "This work is licensed under the GNU Affero General Public License, version 3.",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "Licensed under the Apache License, Version 1.1.",
    """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by
    the Free Software Foundation; either version 2 of the License, or (at your option) any later version.""",
])
def test_other_licences_are_not_taken_for_these(text):
    finder = licenses.Finder(licenses.NOTICES, licenses.Settings())
    assert finder.find(text) == [] and finder.find(f"Some words. {text} More words.") == []


def test_toxicity_scores_do_not_follow_slices_or_cached_words(monkeypatch):
    import numpy as np

    from lakefold.llm import toxicity as tox

    texts = [" ".join(f"w{(7 * i + j) % 90}" for j in range(i)) for i in range(60)] + [None, ""]
    model = tox.Model(np.linspace(-1, 1, 1 << 10).astype(np.float32), 0.1, 3, 6)
    want = tox.score_texts(texts, model)
    monkeypatch.setattr(tox, "_SLICE", 40)
    monkeypatch.setattr(tox, "_CACHE_WORDS", 64)
    kept = {}
    assert np.allclose(tox.score_texts(texts, model, kept), want, rtol=0, atol=1e-12) and len(kept) <= 64
    assert tox.score_texts(texts, model, {}).tolist() == tox.score_texts(texts, model, {}).tolist()
