"""Licence scans by patience alignment.

A text is normalised to words and cut into stretches around the words that
mark a notice.  Each stretch is aligned with each notice that shares a
marking word with it, first with the mark held in its place and up to its
neighbours only, so that copies side by side stay apart: words unique to both sides anchor the alignment, the
longest increasing run of anchors is kept, and the gaps between them are
aligned in the same way.  Words equal at the edges of a gap extend it.
Coverage is the share of the notice's words that are aligned, in order and
at most a few foreign words apart.  The words that tell a licence from its
kin must be aligned without any foreign word among them.
"""

from __future__ import annotations

import re
import uuid
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakefold.llm.license_texts import NOTICES, TELLING

FOUND = T.ArrayType(T.StructType([
    T.StructField("license", T.StringType()), T.StructField("notice", T.IntegerType()), T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()), T.StructField("coverage", T.DoubleType()),
]))
_WORD = re.compile(r"[A-Za-z0-9]+(?:\.[0-9]+)*")
_ZERO = re.compile(r"^([0-9]+)(?:\.0)+$")


@dataclass(frozen=True)
class Settings:
    coverage: float = 0.8    # least share of a notice's words
    apart: int = 6           # most foreign words between two aligned ones
    marks: tuple = ("licen", "copyright", "permission", "redistribut", "waived", "rights", "unencumbered")  # starts of marking words


def words(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """Lower-case words and their places in the text; a version reads the same with and without .0."""
    found = [(_ZERO.sub(r"\1", "version" if (w := m.group().lower()) == "v" else w), m.span()) for m in _WORD.finditer(text)]
    return [w for w, _ in found], [s for _, s in found]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched places of two word lists, increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            out.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            out.append((j, m))
        if i >= j or k >= m:
            continue
        left, right = Counter(a[i:j]), Counter(b[k:m])
        at = {w: p for p, w in enumerate(b[k:m], k) if right[w] == 1 and left.get(w) == 1}
        anchors = [(p, at[w]) for p, w in enumerate(a[i:j], i) if w in at]
        chain = _rising(anchors)
        edges = [(i - 1, k - 1), *chain, (j, m)]
        out += chain
        if chain:
            todo += [(x + 1, y, u + 1, v) for (x, u), (y, v) in zip(edges, edges[1:]) if x + 1 < y and u + 1 < v]
    return sorted(out)


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs that rises in the second place (patience sorting)."""
    tails: list[int] = []
    piles: list[int] = []
    back = [-1] * len(pairs)
    for n, (_, v) in enumerate(pairs):
        p = bisect_left(tails, v)
        back[n] = piles[p - 1] if p else -1
        if p == len(tails):
            tails.append(v)
            piles.append(n)
        else:
            tails[p], piles[p] = v, n
    out, n = [], piles[-1] if piles else -1
    while n >= 0:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


class Finder:
    def __init__(self, notices: list[tuple[str, str]], s: Settings):
        self.s = s
        self.notices = [(name, words(text)[0]) for name, text in notices]
        self.marks = re.compile("|".join(s.marks), re.I)
        self.marked = [{w for w in ws if self._mark(w)} for _, ws in self.notices]

        self.telling = []
        for name, ws in self.notices:
            phrases = [words(p)[0] for p in TELLING.get(name, [])]
            self.telling.append([(k, k + len(p)) for p in phrases for k in range(len(ws)) if ws[k:k + len(p)] == p])

    def _mark(self, word: str) -> bool:
        return word.startswith(self.s.marks)

    def find(self, text: str | None) -> list[dict]:
        """Notices with enough coverage, by place; of overlapping ones the
        one with more aligned words, then more coverage, then the earlier notice."""
        if not text or not self.marks.search(text):
            return []
        toks, places = words(text)
        marks = [i for i, w in enumerate(toks) if self._mark(w)]
        hits = []
        for n, (name, notice) in enumerate(self.notices):
            own = [i for i in marks if toks[i] in self.marked[n]]
            reach = len(notice) + self.s.apart
            # Around each mark that the notice has, as far as the notice can reach: up to the next same marks, beyond them, then without holding the mark.
            seen = -1
            last: dict[str, int] = {}
            after = {}
            for i in reversed(own):
                after[i] = last.get(toks[i], len(toks))
                last[toks[i]] = i
            last = {}
            for i in own:
                before, last[toks[i]] = last.get(toks[i], -1), i
                if i <= seen:
                    continue
                a, b = max(0, i - reach, seen + 1), min(len(toks), i + reach + 1)
                spots = [p for p, w in enumerate(notice) if w == toks[i]]
                near = (max(a, before + 1), min(b, after[i])) if len(spots) == 1 else (a, b)
                run: list[tuple[int, int]] = []
                for x, y in dict.fromkeys([near, (a, b)]):
                    tries = (self._dense(self._held(toks, notice, i, p, x, y)) for p in spots)
                    run = max((r for r in tries if self._enough(r, n)), key=len, default=[])
                    if run:
                        break
                else:
                    run = [(x + a, k) for x, k in self._dense(align(toks[a:b], notice))]
                if self._enough(run, n):
                    x, y = run[0][0], run[-1][0]
                    hits.append((len(run), -n, name, x, y, len(run) / len(notice)))
                    seen = y
        hits.sort(key=lambda h: (-h[0], -h[5], -h[1], h[3]))
        taken: list[tuple] = []
        for h in hits:
            if all(h[4] < t[3] or t[4] < h[3] for t in taken):
                taken.append(h)
        return [{"license": h[2], "notice": -h[1], "start": places[h[3]][0], "end": places[h[4]][1], "coverage": h[5]}
                for h in sorted(taken, key=lambda h: h[3])]

    def _held(self, toks: list[str], notice: list[str], i: int, p: int, a: int, b: int) -> list[tuple[int, int]]:
        """The alignment of words a to b that has word i at place p of the notice."""
        left, right = align(toks[a:i], notice[:p]), align(toks[i + 1:b], notice[p + 1:])
        return [(x + a, k) for x, k in left] + [(i, p)] + [(x + i + 1, k + p + 1) for x, k in right]

    def _enough(self, run: list[tuple[int, int]], n: int) -> bool:
        """Whether a run covers notice n and has its telling words unbroken."""
        if not run or len(run) < self.s.coverage * len(self.notices[n][1]):
            return False
        at = {k: x for x, k in run}
        return all(k in at and at[k] - at.get(first, -1) == k - first for first, end in self.telling[n] for k in range(first, end))

    def _dense(self, pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The longest part of the alignment without a wide gap in the text."""
        best: list[tuple[int, int]] = []
        run: list[tuple[int, int]] = []
        for p in pairs:
            if run and p[0] - run[-1][0] > self.s.apart + 1:
                best, run = max(best, run, key=len), []
            run.append(p)
        return max(best, run, key=len)


_FINDERS: dict[str, Finder] = {}


def with_licenses(docs: DataFrame, notices=None, s: Settings = Settings(), text_col: str = "text", out: str = "licenses") -> DataFrame:
    """``docs`` with an array of (license, notice, start, end, coverage) in
    code points of the whole text; none for null and empty texts."""
    notices, key = list(notices or NOTICES), uuid.uuid4().hex

    @F.pandas_udf(FOUND)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = _FINDERS.setdefault(key, Finder(notices, s))
        for texts in batches:
            yield pd.Series([finder.find(t if isinstance(t, str) else None) for t in texts])

    return docs.withColumn(out, scan(F.col(text_col)))


def report(docs: DataFrame) -> DataFrame:
    """Per document: its licences, how many notices, their spans, the best
    coverage.  Null and empty texts have none; of notices that tie for a place
    the earlier one in the table counts; repeated rows are each returned; an
    empty table gives an empty result."""
    d = with_licenses(docs.select("doc_id", "text"))
    span = lambda x: F.concat_ws(":", x["license"], x["start"].cast("string"), x["end"].cast("string"))
    return d.select(
        "doc_id", F.size("licenses").cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("licenses", lambda x: x["license"]))), ",").alias("licenses"),
        F.array_join(F.transform("licenses", span), ",").alias("spans"),
        F.coalesce(F.array_max(F.transform("licenses", lambda x: x["coverage"])), F.lit(0.0)).alias("coverage"))
