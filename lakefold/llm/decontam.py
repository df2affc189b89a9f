"""Benchmark decontamination with one Aho-Corasick automaton.

Items and documents are normalised alike (A-Z lower-cased, runs of other
ASCII characters turned into one space), every window of ``n`` consecutive
item words is one pattern, and each document is scanned once.  Hits are kept
as word intervals and mapped back to code points of the original text.

The patterns are broadcast, so their number is checked first: more than
``max_patterns`` (item, window) pairs are dealt into several automata by the
hash of the window, each scanning the documents once, and a document's
intervals and items are merged from one to the next.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakefold.llm.common import LOWER, UPPER, stored

# A word is a run of characters outside this set, once A-Z are lower case.
_BREAKS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
_RAW_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_BYTES = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)

HITS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("words", T.ArrayType(T.IntegerType())),   # start, end (exclusive) word numbers, in pairs
    T.StructField("spans", T.ArrayType(T.IntegerType())),   # the same in code points of the text
])


def words(text: Column) -> Column:
    """Normalised words of a text; null: none."""
    lowered = F.translate(text, UPPER, LOWER)
    return F.coalesce(F.regexp_extract_all(lowered, F.lit(f"([^{_BREAKS}]+)"), F.lit(1)), F.array().cast("array<string>"))


def item_windows(items: DataFrame, n: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (item_id, window): ``n`` consecutive words joined by spaces;
    a shorter item is one window.  Items without an id or words have none."""
    w = items.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("item_id"), words(F.col(text_col)).alias("w"))
    w = w.filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - n + 1, F.lit(1)))
    return w.select("item_id", F.explode(F.transform(starts, lambda i: F.array_join(F.slice("w", i, n), " "))).alias("window")).distinct()


def _merged(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(intervals):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


class Scanner:
    """The automaton over windows; built once per Python worker."""

    def __init__(self, patterns: dict[str, list[str]]):
        import ahocorasick

        self.find = ahocorasick.Automaton()
        for window, ids in patterns.items():
            # Text is matched as its UTF-8 bytes, one character each.
            self.find.add_word(" " + window.encode().decode("latin-1") + " ", (window.count(" ") + 1, ids))
        if patterns:
            self.find.make_automaton()
        self.empty = not patterns

    def hits(self, text: str | None, before: list[tuple[int, int]], items: set[str]) -> tuple:
        tokens = (text or "").encode("utf-8", "surrogatepass").translate(_BYTES).split()
        found = list(before)
        if tokens and not self.empty:
            norm = (b" " + b" ".join(tokens) + b" ").decode("latin-1")
            at, word = 0, 0  # words before position ``at``
            for end, (size, ids) in self.find.iter(norm):
                word += norm.count(" ", at, end)  # the last space of the match ends word ``word - 1``
                at = end
                found.append((word - size, word))
                items.update(ids)
        found = _merged(found)
        spans: list[int] = []
        if found:
            places = [m.span() for m in _RAW_WORD.finditer(text)]
            spans = [x for a, b in found for x in (places[a][0], places[b - 1][1])]
        return len(tokens), sum(b - a for a, b in found), sorted(items), [x for p in found for x in p], spans


_SCANNERS: dict[str, Scanner] = {}


def _scan(text: Column, before: Column, patterns, key: str) -> Column:
    @F.pandas_udf(HITS)
    def scan(batches: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        if key not in _SCANNERS:
            _SCANNERS.clear()  # one automaton at a time in a worker
            _SCANNERS[key] = Scanner(patterns.value)
        for texts, prior in batches:
            rows = []
            for t, w, ids in zip(texts, prior["words"], prior["items"]):
                old = [] if w is None else [int(x) for x in w]
                rows.append(_SCANNERS[key].hits(t if isinstance(t, str) else None, list(zip(old[::2], old[1::2])),
                                                set() if ids is None else set(ids)))
            yield pd.DataFrame(rows, columns=HITS.names)

    return scan(text, before)


def with_hits(docs: DataFrame, items: DataFrame, n: int = 10, text_col: str = "text", out: str = "hits",
              max_patterns: int = 20_000) -> DataFrame:
    """``docs`` with a struct column ``out`` (see ``HITS``): words, words
    inside an occurrence of an item's window, the items, and where they are.

    Null and empty texts have no words; without items nothing is hit; rows
    keep their number and other columns, repeated rows included."""
    spark = docs.sparkSession
    windows = stored(item_windows(items, n), "windows")
    blocks = max(1, -(-windows.count() // max_patterns))
    part = F.pmod(F.xxhash64("window"), F.lit(blocks))
    empty = F.lit(None).cast(HITS)
    for b in range(blocks):
        rows = windows.filter(part == b).groupBy("window").agg(F.sort_array(F.collect_set("item_id")).alias("ids")).collect()
        patterns = spark.sparkContext.broadcast({r.window: r.ids for r in rows})  # at most about max_patterns pairs
        docs = docs.withColumn(out, _scan(F.col(text_col), empty if b == 0 else F.col(out), patterns, uuid.uuid4().hex))
        if b + 1 < blocks:
            docs = stored(docs, "hits")
    return docs


def report(docs: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    hits = with_hits(docs.select("doc_id", "text"), items, n)
    return hits.select(
        "doc_id", "hits.n_words", "hits.n_hit", F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hits.items", ","), 256).alias("items_sha256"),
        (F.col("hits.n_hit") > 0).alias("contaminated"), F.col("hits.spans").alias("spans"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    """The documents in which no window of any item occurs, as they were."""
    return with_hits(docs, items, n, out="_llm_hits").filter(F.col("_llm_hits.n_hit") == 0).select(*docs.columns)
