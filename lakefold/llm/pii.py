"""Personal data: fixed patterns, and a linear-chain conditional random field.

The patterns give the base spans.  The field tags tokens by word-shape
features of the token and two neighbours on each side; it is trained on the
labelled table of ``pii_table`` and adds spans that the patterns miss
(addresses spelt out, local phone numbers, spaced-out numbers).

Decoding: a token that lies in no stretch whose labels could win anything
over "none" is certainly "none" on the best path.  Such tokens cut the chain
exactly; what lies between them is decoded by Viterbi in numpy batches.

A span counts only if its text is plausible, and such a text holds a digit or
the words of an address spelt out.  So only the parts of a text around these
are read, each as far as tokens that are "none" whatever stands outside the
part; a part without such tokens has its whole text read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakefold.llm.common import give_back
from lakefold.llm.pii_table import TABLE
from lakefold.llm.textnum import encode, slices

KINDS = ["email", "ip", "card", "phone"]
SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType()),
]))

# ---------------------------------------------------------------- patterns

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+){3,}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # The part before an @ starts where its run of characters starts, so each @ needs one look only.
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) << (k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _DOTTED.finditer(text):  # numbers of a longer chain are taken four at a time
        at, parts = m.start(), m.group().split(".")
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                yield at, end
            at = end + 1


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the patterns' matches, by start and kind."""
    found = [(a, b, 0) for a, b in _emails(text)]
    if _DIGITS.search(text) is None:  # the others' matches hold digits
        return [(a, b, KINDS[k]) for a, b, k in sorted(found)]
    found += [(a, b, 1) for a, b in _ips(text)]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            found.append((*m.span(), 2))
    if "+" in text:
        found += [(*m.span(), 3) for m in _PHONE.finditer(text) if 10 <= sum(map(str.isdigit, m.group())) <= 15]
    return [(a, b, KINDS[k]) for a, b, k in sorted(found, key=lambda s: (s[0], s[2], s[1]))]


# ------------------------------------------------------------------- field

_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\s\w]|\w")
_REACH = 2  # neighbours on each side


def shape(token: str) -> str:
    """Word shape: case pattern of letters, number of digits, or the mark itself."""
    if token.isascii() and token.isdigit():
        n = len(token)
        return f"d{n}" if n <= 7 else "d8-13" if n < 14 else "d14-19" if n < 20 else "d20"
    if token.isalpha():
        if len(token) == 1:
            return "X" if token.isupper() else "x"
        return "xx" if token.islower() else "XX" if token.isupper() else "Xx" if token.istitle() else "xX"
    return token if token in "@.-()+[]{}:;,/_|\"'=" else "mark"


@dataclass(frozen=True)
class Field:
    """Features by name, their weights at each neighbour place, label steps."""

    shapes: dict[str, int]
    words: dict[str, int]
    weights: np.ndarray      # place x feature x label
    steps: np.ndarray        # label x label
    bias: np.ndarray

    def features(self, token: str) -> tuple[int, int]:
        return self.shapes.get(shape(token), 1), self.words.get(token.lower(), len(self.shapes))


class Scores:
    """Label scores of the tokens of a batch.  A token's type stands for its
    shape and word features; type 0 is outside the text."""

    def __init__(self, field: Field):
        self.field, self.types = field, {(0, 0): 0}
        self.table = np.zeros((2 * _REACH + 1, 1, len(field.bias)), np.float64)
        self.fill()

    def type_of(self, token: str) -> int:
        return self.types.setdefault(self.field.features(token), len(self.types))

    def fill(self) -> None:
        """Rows for the types met since the last call."""
        f = self.field
        pairs = np.array(list(self.types), int)
        self.table = f.weights[:, pairs[:, 0]] + f.weights[:, pairs[:, 1]]
        self.table[:, 0] = 2 * f.weights[:, 0]  # as in training: both features of a place outside are number 0

    def open(self, padded: np.ndarray, own: np.ndarray, offsets: np.ndarray, cut: np.ndarray | None = None) -> np.ndarray:
        """Tokens whose best label could be another than "none".

        A stretch of other labels on the best path wins something over "none"
        all along it: the tokens' gains, each with the best step into it, and
        the step out of it, add up to 0 at least.  A token that lies in no
        stretch of which that holds is "none".

        ``cut``: whether the text goes on before (row 0) and behind (row 1)
        each sequence.  The outer tokens of such a side, whose neighbours are
        unknown, are not looked at (and not open); a stretch that comes from
        there or goes on there counts with the best step that any label allows."""
        s = self.field.steps
        into, out = (s - s[0, 0]).max(0), float((s[1:, 0] - s[0, 0]).max())
        e = self.at(padded, own)
        e -= e[:, :1]
        gain = (e + into)[:, 1:].max(1)
        if cut is None:
            cut = np.zeros((2, len(offsets) - 1), bool)
        start, end = offsets[:-1] + _REACH * cut[0], offsets[1:] - _REACH * cut[1]
        some = end > start
        first, last, cut = start[some], end[some] - 1, cut[:, some]
        own_first, own_last = first[~cut[0]], last[~cut[1]]
        gain[own_first] = (e[own_first] + np.maximum(into, 0))[:, 1:].max(1)  # no step into a text's first token
        gain[first[cut[0]]] = (e[first[cut[0]]] + (s - s[:, :1]).max(0))[:, 1:].max(1)
        gain[own_last] += max(0.0, -out)                                      # and none out of its last
        gain[last[cut[1]]] += max(0.0, float((s[1:] - s[0]).max()) - out)
        seen = np.zeros(len(own) + 1, np.int8)
        np.add.at(seen, first, 1)
        np.add.at(seen, last + 1, -1)
        seen = np.cumsum(seen[:-1]) > 0
        line = np.full(len(padded), -1e5)  # places between texts end every stretch
        line[own[seen] + _REACH] = gain[seen]
        total = np.cumsum(line)
        ahead = np.cumsum(line[::-1])
        upto = (total - np.append(0, np.minimum.accumulate(total)[:-1]))[own + _REACH]
        onward = (ahead - np.append(0, np.minimum.accumulate(ahead)[:-1]))[::-1][own + _REACH]
        return seen & (upto + onward - gain + out >= -1e-5)

    def at(self, padded: np.ndarray, where: np.ndarray) -> np.ndarray:
        return self.field.bias + sum(self.table[p][padded[where + p]] for p in range(2 * _REACH + 1))


def parse(line: str) -> tuple[list[str], list[int]]:
    """Tokens and labels (0: none) of a line of the labelled table."""
    tokens: list[str] = []
    labels: list[int] = []
    for part in re.split(r"(\{\w+\|[^}]*\})", line):
        kind, body = 0, part
        if m := re.fullmatch(r"\{(\w+)\|([^}]*)\}", part):
            kind, body = KINDS.index(m[1]) + 1, m[2]
        got = _TOKEN.findall(body)
        tokens += got
        labels += [kind] * len(got)
    return tokens, labels


def train(table: list[str], rounds: int = 250, rate: float = 0.1, decay: float = 0.01) -> Field:
    """Maximum likelihood with weight decay: forward-backward over all lines
    at once, padded, and Adam."""
    lines = [parse(x) for x in table]
    # 0: outside the text, 1: a shape unseen here
    shapes = {s: k + 2 for k, s in enumerate(sorted({shape(t) for toks, _ in lines for t in toks}))}
    shapes = {"<pad>": 0, "<new>": 1, **shapes}
    seen: dict[str, int] = {}
    for toks, _ in lines:
        for t in set(map(str.lower, toks)):
            seen[t] = seen.get(t, 0) + t.isalpha()
    words = {w: len(shapes) + 1 + k for k, w in enumerate(sorted(w for w, n in seen.items() if n >= 2))}
    n_feat, n_lab = len(shapes) + 1 + len(words), len(KINDS) + 1
    rows, size = len(lines), max(len(t) for t, _ in lines)
    feats = np.zeros((2 * _REACH + 1, rows, size, 2), int)
    gold, real = np.zeros((rows, size), int), np.zeros((rows, size), bool)
    for r, (toks, labels) in enumerate(lines):
        own = np.zeros((len(toks) + 2 * _REACH, 2), int)
        own[_REACH:_REACH + len(toks)] = [(shapes[shape(t)], words.get(t.lower(), len(shapes))) for t in toks]
        for place in range(2 * _REACH + 1):
            feats[place, r, :len(toks)] = own[place:place + len(toks)]
        gold[r, :len(toks)], real[r, :len(toks)] = labels, True
    p = [np.zeros((2 * _REACH + 1, n_feat, n_lab)), np.zeros((n_lab, n_lab)), np.zeros(n_lab)]
    m, v = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p]
    one = np.eye(n_lab)

    def lse(x, axis):
        top = x.max(axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)

    for k in range(1, rounds + 1):
        e = p[2] + sum(p[0][c][feats[c]].sum(2) for c in range(2 * _REACH + 1))
        fwd, bwd = np.zeros_like(e), np.zeros_like(e)
        fwd[:, 0] = e[:, 0]
        for t in range(1, size):
            fwd[:, t] = np.where(real[:, t, None], lse(fwd[:, t - 1, :, None] + p[1], 1) + e[:, t], fwd[:, t - 1])
        for t in range(size - 2, -1, -1):
            bwd[:, t] = np.where(real[:, t + 1, None], lse(p[1] + (e[:, t + 1] + bwd[:, t + 1])[:, None, :], 2), 0)
        norm = lse(fwd[:, -1], 1)
        node = np.exp(fwd + bwd - norm[:, None, None])
        err = (node - one[gold]) * real[..., None]
        g = [decay * p[0], decay * p[1], err.sum((0, 1))]
        for c in range(2 * _REACH + 1):
            for j in range(2):
                np.add.at(g[0][c], feats[c, ..., j][real], err[real])
        for t in range(1, size):
            on = real[:, t]
            pair = np.exp(fwd[on, t - 1, :, None] + p[1] + (e[on, t] + bwd[on, t])[:, None, :] - norm[on, None, None])
            g[1] += pair.sum(0)
            np.add.at(g[1], (gold[on, t - 1], gold[on, t]), -1.0)
        for j in range(3):
            m[j] = 0.9 * m[j] + 0.1 * g[j]
            v[j] = 0.999 * v[j] + 0.001 * g[j] ** 2
            p[j] -= rate * (m[j] / (1 - 0.9 ** k)) / (np.sqrt(v[j] / (1 - 0.999 ** k)) + 1e-8)
    p[0][:, 1] = 0  # nothing is known of a new shape
    return Field(shapes, words, p[0], p[1], p[2])


@lru_cache(maxsize=1)
def default_field() -> Field:
    return train(TABLE)


def _viterbi(scores: np.ndarray, steps: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Best labels of a padded batch (rows x time x labels)."""
    rows, size, n = scores.shape
    best, back = scores[:, 0], np.zeros((rows, size, n), np.int8)
    for t in range(1, size):
        step = best[:, :, None] + steps
        back[:, t] = step.argmax(1)
        best = np.where((t < lengths)[:, None], step.max(1) + scores[:, t], best)
    out = np.zeros((rows, size), np.int8)
    label = best.argmax(1)
    for t in range(size - 1, -1, -1):
        out[:, t] = np.where(t < lengths, label, 0)
        label = np.where((t > 0) & (t < lengths), back[np.arange(rows), t, label], label)
    return out


def decode(scores, open_: np.ndarray, field: Field, ends: np.ndarray) -> np.ndarray:
    """Best labels of sequences that lie one after the other.

    ``scores(at)`` gives the label scores of tokens, ``open_`` those that
    need not be "none", ``ends`` where each sequence ends.  Equal to Viterbi
    over each whole sequence."""
    labels = np.zeros(len(open_), np.int8)
    at = np.flatnonzero(open_)
    if not len(at):
        return labels
    s = field.steps
    ends = ends[ends > 0]
    seq = np.searchsorted(ends, at, side="right")
    new = np.append(True, (np.diff(at) > 1) | (np.diff(seq) > 0))
    first, length = at[new], np.diff(np.append(np.flatnonzero(new), len(at)))
    lasts = ends[seq[new]]
    starts = np.append(0, ends)[seq[new]]
    order = np.argsort(length, kind="stable")
    while len(order):
        group = order[: int(np.searchsorted(length[order], 2 * length[order[0]] + 8, side="right"))]
        group = group[: max(1, 400_000 // (int(length[group[-1]]) + 1))]
        order = order[len(group):]
        n = length[group]
        place = np.minimum(first[group][:, None] + np.arange(int(n[-1])), len(open_) - 1)
        block = scores(place.ravel()).reshape(*place.shape, -1)
        # The neighbours outside a block are "none", except at a text's ends.
        block[:, 0] += np.where((first[group] > starts[group])[:, None], s[0], 0)
        block[np.arange(len(group)), n - 1] += np.where((first[group] + n < lasts[group])[:, None], s[:, 0], 0)
        got = _viterbi(block, s, n)
        inside = np.arange(place.shape[1]) < n[:, None]
        labels[place[inside]] = got[inside]
    return labels


# An address spelt out has a word for the @ and, after it, one for a dot.
_AT, _DOT = r"(?:@|at|arroba|[\[(] ?(?:at|arroba) ?[\])])", r"(?:\.|dot|punkt|punto|point|[\[(] ?(?:dot|punkt|punto) ?[\])])"
_SPELT = re.compile(rf"(?i)[\w+-]+(?: ?{_DOT} ?[\w+-]+)* ?{_AT} ?[\w-]+(?: ?{_DOT} ?[\w-]+)+")

# What every plausible text holds: a number, or the words for the @ and, after it, for a dot.
_NUMBER = re.compile(r"[0-9][0-9]*")
_SPELT_PART = re.compile(r"[@aA](?:(?<=@)|[tT]|[rR][rR][oO][bB][aA]) ?[\])]? ?[\w-]+ ?(?:[\[(] ?)?(?i:\.|dot|punkt|punto|point)(?: ?[\])])? ?[\w-]")
_MARGINS = 48, 400  # characters on each side of it that are read, before the whole text is


def _parts(text: str, margin: int) -> list[list[int]]:
    """(start, end, first, last) of the parts of the text, from space to space,
    with all that a plausible span can hold between ``first`` and ``last``."""
    cores = [m.span() for m in _NUMBER.finditer(text)]
    cores += [m.span() for m in _SPELT_PART.finditer(text)]
    parts: list[list[int]] = []
    end = 0  # of the last part
    for a, b in sorted(cores):
        start = 0
        if a - margin > end:
            start = text.rfind(" ", end, a - margin) + 1
        if parts and start <= end:
            parts[-1][3] = max(parts[-1][3], b)
        else:
            parts.append([start, 0, a, b])
        if b + margin > end:
            end = text.find(" ", b + margin)
            end = len(text) if end < 0 else end
        parts[-1][1] = end
    return parts


def _plausible(kind: str, part: str) -> bool:
    digits = len(_DIGITS.findall(part))
    if kind == "phone":
        return 7 <= digits <= 15
    if kind == "card":
        return 12 <= digits <= 19
    if kind == "ip":
        numbers = re.findall(r"[0-9]+", part)
        return len(numbers) == 4 and all(len(x) <= 3 and int(x) <= 255 for x in numbers)
    return _SPELT.fullmatch(part) is not None


def _by_sequence(labels: np.ndarray, offsets: np.ndarray) -> dict[int, list[int]]:
    """The labelled tokens of each sequence that has any."""
    hit = np.flatnonzero(labels)
    of = np.searchsorted(offsets, hit, side="right") - 1
    by: dict[int, list[int]] = {}
    for k, h in zip(of.tolist(), (hit - offsets[of]).tolist()):
        by.setdefault(k, []).append(h)
    return by


class Tagger:
    """Spans of texts; remembers the types of tokens."""

    def __init__(self, field: Field, remember: int = 100_000):
        self.field, self.remember, self.scores = field, remember, Scores(field)
        self.known: dict[str, int] = {}

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Types of all tokens with places outside around each text, where the
        tokens stand in these (less the reach), and the texts' offsets."""
        codes, offsets, words = encode(texts, _TOKEN.findall)
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > self.remember:
            self.known.clear()
            new = words
        self.known.update((w, self.scores.type_of(w)) for w in new)
        self.scores.fill()
        # Places outside the text stand around each text, so that neighbours never cross.
        own = np.arange(len(codes)) + _REACH * np.repeat(np.arange(len(texts)), np.diff(offsets))
        padded = np.zeros(len(codes) + _REACH * (len(texts) + 1), int)
        if len(codes):
            padded[own + _REACH] = np.array([self.known[w] for w in words], int)[codes]
        return padded, own, offsets

    def labels(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Best labels of all tokens, and the texts' offsets among them."""
        padded, own, offsets = self._encoded(texts)
        return decode(lambda at: self.scores.at(padded, own[at]), self.scores.open(padded, own, offsets), self.field, offsets[1:]), offsets

    def part_labels(self, parts: list[str], cut: np.ndarray, before: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Labels of all tokens of parts of texts, the parts' offsets, and which
        parts are ``sure``: their labels are those of the whole text, but for
        what lies in the first ``before`` and the last ``behind`` tokens."""
        padded, own, offsets = self._encoded(parts)
        open_ = self.scores.open(padded, own, offsets, cut)
        # A token that is looked at and not open is "none", so it parts what is inside from what is unknown.
        shut = ~open_
        for side in range(_REACH):
            shut[np.minimum(offsets[:-1] + side, len(shut) - 1)[cut[0]]] = False
            shut[np.maximum(offsets[1:] - 1 - side, 0)[cut[1]]] = False
        total = np.append(0, np.cumsum(shut))
        n = np.diff(offsets)
        lead, rest = offsets[:-1] + np.clip(before, 0, n), offsets[1:] - np.clip(behind, 0, n)
        sure = (~cut[0] | (total[lead] > total[offsets[:-1]])) & (~cut[1] | (total[offsets[1:]] > total[rest]))
        return decode(lambda at: self.scores.at(padded, own[at]), open_, self.field, offsets[1:]), offsets, sure

    def spans(self, texts) -> list[list[tuple[int, int, str, bool]]]:
        """(start, end, kind, base) of each text, by start and kind."""
        texts = [t if isinstance(t, str) else "" for t in texts]
        out = [[(a, b, k, True) for a, b, k in base_spans(t)] for t in texts]
        found: dict[int, list] = {}
        todo = range(len(texts))
        for margin in (*_MARGINS, None):
            parts = [(d, *p) for d in todo for p in _parts(texts[d], len(texts[d]) if margin is None else margin)]
            unsure: set[int] = set()
            for at, some in slices([texts[d][a:b] for d, a, b, _, _ in parts], 200_000):
                of = parts[at:at + len(some)]
                cut = np.array([[a > 0 for _, a, _, _, _ in of], [b < len(texts[d]) for d, _, b, _, _ in of]])
                # Neither the token that a core may start in nor the one it may end in counts.
                before = np.array([len(_TOKEN.findall(texts[d], a, first)) - 1 if a else 0 for d, a, _, first, _ in of])
                behind = np.array([len(_TOKEN.findall(texts[d], last, b)) - 1 if b < len(texts[d]) else 0 for d, _, b, _, last in of])
                labels, offsets, sure = self.part_labels(some, cut, before, behind)
                unsure.update(of[k][0] for k in np.flatnonzero(~sure).tolist())
                for k, hits in _by_sequence(labels, offsets).items():
                    found.setdefault(of[k][0], []).append((of[k][1], some[k], hits, labels[offsets[k]:offsets[k + 1]]))
            for d in unsure:
                found.pop(d, None)
            todo = sorted(unsure)
        for d, runs in found.items():
            base = list(out[d])
            for a, part, hits, labels in runs:
                places = [(a + m.start(), a + m.end()) for m in _TOKEN.finditer(part)]
                out[d] += self._added(texts[d], hits, labels, places, base)
        return [sorted(s, key=lambda s: (s[0], KINDS.index(s[2]), s[1])) for s in out]

    @staticmethod
    def _added(text, hits, labels, places, base):
        runs: list[list[int]] = []
        for h in hits:
            if runs and runs[-1][1] == h - 1 and labels[runs[-1][1]] == labels[h]:
                runs[-1][1] = h
            else:
                runs.append([h, h])
        for a, b in runs:
            kind, start, end = KINDS[labels[a] - 1], places[a][0], places[b][1]
            whole = not (text[start - 1:start].isalnum() or text[end:end + 1].isalnum())
            if whole and _plausible(kind, text[start:end]) and not any(start < y and x < end for x, y, _, _ in base):
                yield start, end, kind, False


_TAGGERS: dict[str, Tagger] = {}


def _tagger(field, key: str) -> Tagger:
    if key not in _TAGGERS:
        _TAGGERS.clear()
        _TAGGERS[key] = Tagger(field.value)
    return _TAGGERS[key]


def with_spans(docs: DataFrame, text_col: str = "text", out: str = "spans", field: Field | None = None) -> DataFrame:
    """``docs`` with an array of (kind, start, end, base) in code points of
    the whole text, end exclusive; none for null and empty texts."""
    shared, key = docs.sparkSession.sparkContext.broadcast(field or default_field()), uuid.uuid4().hex

    @F.pandas_udf(SPANS)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            got = _tagger(shared, key).spans(texts.tolist())
            give_back()
            yield pd.Series([[{"kind": k, "start": a, "end": b, "base": base} for a, b, k, base in s] for s in got])

    return docs.withColumn(out, find(F.col(text_col)))


def report(docs: DataFrame) -> DataFrame:
    """Per document: base spans by kind, their digest, and all spans as text."""
    d = with_spans(docs.select("doc_id", "text"))
    told = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, (lambda k: lambda s: s == k)(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return d.select(
        "doc_id", *counts, F.sha2(F.array_join(F.transform(base, told), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", told), ",").alias("spans"))


def masked(text: str, spans) -> str:
    """The text with every span replaced by its kind in brackets; of spans
    that overlap, the first one's kind stands for all."""
    out, at = [], 0
    for a, b, kind, _ in spans:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", field: Field | None = None) -> DataFrame:
    """The documents with personal data masked; ``length_col``, where the
    table has it, follows the text.  Null texts stay null."""
    shared, key = docs.sparkSession.sparkContext.broadcast(field or default_field()), uuid.uuid4().hex

    @F.pandas_udf(T.StringType())
    def mask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            got = _tagger(shared, key).spans(texts.tolist())
            give_back()
            yield pd.Series([masked(t, s) if isinstance(t, str) else None for t, s in zip(texts, got)], dtype=object)

    out = docs.withColumn("_llm_masked", mask(F.col(text_col)))
    changed = ~F.col("_llm_masked").eqNullSafe(F.col(text_col))
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        out = out.withColumn(length_col, F.when(changed, F.char_length("_llm_masked").cast(kind)).otherwise(F.col(length_col)))
    return out.withColumn(text_col, F.col("_llm_masked")).select(*docs.columns)
