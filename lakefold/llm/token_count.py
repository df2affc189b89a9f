"""Token counts of a byte-fallback BPE vocabulary by rank-synchronous merging.

The vocabulary file gives pieces and scores; the merging is ours.  A text is
cut into pre-tokens where no piece of the vocabulary can cross (a run of
space marks and what follows it up to the next one), and distinct pre-tokens
are merged together as ragged numpy arrays: in every round each sequence
applies its own lowest-rank pair at all its places at once.

Applying all places of one rank at once equals applying them from the left
one by one as long as the new symbol takes part in no merge of a lower rank.
Pieces for which that does not hold are found when the tables are built, and
only their leftmost place is merged in a round.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"  # fixed value: the mark that stands for a space in the pieces
_NONE = np.int32(2**31 - 1)
_UNIT = re.compile(f"[ {SPACE}]+[^ {SPACE}]*")
_CACHED_CHARS = 48        # longer pre-tokens are merged but not remembered
_CACHE_ENTRIES = 600_000  # remembered pre-tokens of a worker
_SLICE_CHARS = 4_000_000  # characters merged together


class MergeTables:
    """Arrays that the merging needs: symbols, pairs by key, rank to symbol."""

    def __init__(self, pieces: list[str], scores: list[float], byte_fallback: bool = True):
        order = sorted((i for i, p in enumerate(pieces) if len(p) > 1), key=lambda i: (-scores[i], i))
        symbols = {p: k for k, p in enumerate(dict.fromkeys([*(c for p in pieces for c in p), *pieces]))}
        known = {p for p in pieces if len(p) == 1}
        self.width = len(symbols)
        keys, ranks = [], []
        self.made = np.zeros(len(order), np.int64)
        for rank, i in enumerate(order):
            p = pieces[i]
            self.made[rank] = symbols[p]
            for cut in range(1, len(p)):
                a, b = symbols.get(p[:cut]), symbols.get(p[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.width + b)
                    ranks.append(rank)
        at = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys = np.append(np.array(keys, np.int64)[at], np.int64(-1) if not keys else np.int64(2**62))
        self.ranks = np.append(np.array(ranks, np.int32)[at], _NONE).astype(np.int32)
        # Lowest rank of a merge that a symbol takes part in, to find those that must go one by one.
        first = np.full(self.width, _NONE, np.int64)
        for side in (np.array(keys, np.int64) // self.width, np.array(keys, np.int64) % self.width):
            np.minimum.at(first, side, np.array(ranks, np.int64))
        self.alone = first[self.made] < np.arange(len(order)) if len(order) else np.zeros(0, bool)
        # Symbol of each code point; -n: unknown and counted as n bytes (or as one piece).
        points = np.arange(0x110000)
        size = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF) if byte_fallback else np.ones(0x110000, int)
        self.of_char = (-size).astype(np.int32)
        self.cost = np.ones(self.width, np.int64)
        for c, k in symbols.items():
            if len(c) == 1:
                self.of_char[ord(c)] = k
                if c not in known:
                    self.cost[k] = size[ord(c)]

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = np.where((a >= 0) & (b >= 0), a.astype(np.int64) * self.width + b, -1)
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def count(self, units: list[str]) -> np.ndarray:
        """Tokens of each unit; the units are merged together."""
        out = np.zeros(len(units), np.int64)
        if not units:
            return out
        sym = self.of_char[np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)].astype(np.int64)
        seq = np.repeat(np.arange(len(units)), [len(u) for u in units])
        rank = np.full(len(sym), _NONE, np.int32)
        inside = seq[:-1] == seq[1:]
        rank[:-1][inside] = self.pair_ranks(sym[:-1][inside], sym[1:][inside])
        while len(sym):
            starts = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
            sizes = np.diff(np.append(starts, len(seq)))
            best = np.minimum.reduceat(rank, starts)
            if (best == _NONE).any():  # these sequences have no pair left
                done = np.repeat(best == _NONE, sizes)
                np.add.at(out, seq[done], np.where(sym[done] < 0, -sym[done], self.cost[np.maximum(sym[done], 0)]))
                sym, seq, rank = sym[~done], seq[~done], rank[~done]
                continue
            hit = rank == np.repeat(best, sizes)
            at = np.flatnonzero(hit)
            # Of overlapping places (a run of neighbours) every second one counts, from the left.
            run = np.append(True, np.diff(at) > 1)
            nth = np.arange(len(at)) - np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[nth % 2 == 0]
            lead = np.append(True, seq[at[1:]] != seq[at[:-1]])
            at = at[lead | ~self.alone[rank[at]]]
            sym[at] = self.made[rank[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            fresh = np.zeros(len(sym), bool)
            fresh[at] = True
            fresh[at[at > 0] - 1] = True
            # The symbol before a merge may be the dropped half of an earlier one; then that one's place is fresh already.
            sym, seq, rank, fresh = sym[keep], seq[keep], rank[keep], fresh[keep]
            again = np.flatnonzero(fresh)
            last = again == len(sym) - 1
            rank[again[last]] = _NONE
            again = again[~last]
            same = seq[again] == seq[again + 1]
            rank[again[~same]] = _NONE
            again = again[same]
            rank[again] = self.pair_ranks(sym[again], sym[again + 1])
        return out


_TABLES: dict[str, tuple[MergeTables, dict[str, int]]] = {}


def merge_tables(model_path: str) -> tuple[MergeTables, dict[str, int]]:
    """Tables of a model file and the worker's memory of counted pre-tokens."""
    if model_path not in _TABLES:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        ids = [i for i in range(model.get_piece_size())
               if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        pieces = [model.id_to_piece(i) for i in ids]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("pieces cross a space: this vocabulary cannot be cut at spaces")
        _TABLES[model_path] = MergeTables(pieces, [model.get_score(i) for i in ids]), {}
    return _TABLES[model_path]


def _unit_counts(keys: list[str], tables: MergeTables, cache: dict[str, int]) -> np.ndarray:
    """Tokens of distinct pre-tokens, each given without its first space mark."""
    new = [u for u in keys if u not in cache]
    if len(cache) + len(new) > _CACHE_ENTRIES:
        cache.clear()
        new = keys
    counts = dict(zip(new, tables.count([SPACE + u.replace(" ", SPACE) for u in new]).tolist()))
    out = np.array([counts[u] if u in counts else cache[u] for u in keys], np.int64)
    room = _CACHE_ENTRIES - len(cache)
    cache.update([x for x in counts.items() if len(x[0]) <= _CACHED_CHARS][:room])
    return out


def _count_slice(texts: list[str], tables: MergeTables, cache: dict[str, int]) -> np.ndarray:
    odd = ["  " in t or SPACE in t or t[:1] == " " or t[-1:] == " " for t in texts]
    plain = pa.array([None if o else t for t, o in zip(texts, odd)], pa.large_string())
    words = pc.split_pattern(plain, " ")
    offsets = words.offsets.to_numpy()
    enc = words.values.dictionary_encode()
    each = _unit_counts(enc.dictionary.to_pylist(), tables, cache)[enc.indices.to_numpy()]
    total = np.append(0, np.cumsum(each))
    out = total[offsets[1:]] - total[offsets[:-1]]
    units = {k: [u[1:] for u in _UNIT.findall(" " + t)] for k, (t, o) in enumerate(zip(texts, odd)) if o}
    if units:  # runs of spaces, or the mark itself in the text
        keys = list(set().union(*units.values()))
        of = dict(zip(keys, _unit_counts(keys, tables, cache).tolist()))
        for k, us in units.items():
            out[k] = sum(of[u] for u in us)
    return out


def count_texts(texts, model_path: str) -> np.ndarray:
    """Tokens of each text (None and "": 0)."""
    tables, cache = merge_tables(model_path)
    out = np.zeros(len(texts), np.int64)
    some = [k for k, t in enumerate(texts) if t]
    at = 0
    while at < len(some):
        end, chars = at, 0
        while end < len(some) and (end == at or chars + len(texts[some[end]]) <= _SLICE_CHARS):
            chars += len(texts[some[end]])
            end += 1
        out[some[at:end]] = _count_slice([texts[k] for k in some[at:end]], tables, cache)
        at = end
    return out


def token_count(text: Column, model_path: str) -> Column:
    """Tokens of a text column as a long column; a null text counts 0."""

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(count_texts([t if isinstance(t, str) else None for t in texts], model_path))

    return count(text)


def with_token_counts(docs: DataFrame, model_path: str, limit: int = 4096, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``.

    Columns of these names in the input are replaced.  Null and empty texts
    have 0 bytes and 0 tokens; an empty table stays empty; repeated rows are
    counted each."""
    return docs.withColumns({
        "n_bytes": F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long"),
        "n_tokens": token_count(F.col(text_col), model_path),
    }).withColumn("over_limit", F.col("n_tokens") > limit)
