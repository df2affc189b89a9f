"""Phrase collocations, counted in HAT-tries.

Each task counts the phrases of its texts in a trie over word numbers: first
words lead to hash containers of all that starts with them.  Rare words share
a container (a hybrid one); one that grows above ``burst`` entries bursts, and
its most frequent word gets a container of its own (a pure one); a pure one
that grows above it bursts into containers by the second word.  When a task holds
more than ``entries`` phrases it spills whole subtrees, the largest first, as
runs sorted by the phrase, one run for each prefix partition.  A partition's
runs, of all tasks, are then merged in phrase order; what can get no more
counts leaves the merge at once.

A prefix partition is told by a hash of a phrase's first two words and of a
salt from the third, so that a very common word or pair of words is dealt
over many partitions; what meets there has been added up by task before.

Everything after the counts (cuts, scores, containment, ranks) is joins and
windows over phrases that reach the least count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakefold.llm.common import stored
from lakefold.llm.textnum import mix, word_hashes

# A-Z in lower case, a tab parts words like a space, and . , ; : ! ? and
# \x0A-\x0D end a piece (no word can hold a full stop, so it stands for all of them).
_TABLE = bytes(46 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


@dataclass(frozen=True)
class Settings:
    longest: int = 3          # words of a phrase at most
    least: int = 10           # occurrences of a candidate
    inside: int = 50          # percent of its occurrences inside one longer candidate that drop a phrase
    top: int = 2000           # phrases of each language that are returned
    burst: int = 4096         # entries of a container before it bursts
    entries: int = 800_000  # phrases that a task holds before it spills
    bytes: int = 2_000_000    # of text that is counted before it enters the trie
    shared: int = 128         # word numbers that share a container at first
    salts: int = 16           # third words of one pair go to so many partitions
    chunk: int = 32_768       # phrases of a piece of a run


class _Numbers(dict):
    """Word -> number; 0 is the end of a piece."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


class _Trie:
    """Counts of packed phrases: containers by number.  ``owner`` gives the
    container of a first word; a pure one that burst leads on to containers
    by the second word."""

    def __init__(self, s: Settings, bits: int):
        self.burst_at, self.shared, self.deep = s.burst, s.shared, s.longest > 1
        self.first, self.second = bits * (s.longest - 1), bits * (s.longest - 2)
        self.owner = np.zeros(0, np.int64)
        self.boxes: dict[int, dict] = {}
        self.held: dict[int, int] = {}  # entries below each container
        self.words: dict[int, int] = {}  # the word of a pure container
        self.nodes: set[int] = set()     # pure containers that have burst
        self.size = 0

    def _owners(self, heads: np.ndarray) -> np.ndarray:
        if len(heads) and heads[-1] >= len(self.owner):  # more words: they share containers
            more = np.arange(len(self.owner), max(2 * len(self.owner), int(heads[-1]) + 1))
            self.owner = np.concatenate([self.owner, more // self.shared])
        return self.owner[heads]

    @staticmethod
    def _put(box: dict, keys: list[int], counts: list[int]) -> None:
        if not box:
            box.update(zip(keys, counts))
            return
        get = box.get
        for k, c in zip(keys, counts):
            box[k] = get(k, 0) + c

    def _put_below(self, node: dict, keys: np.ndarray, counts: np.ndarray) -> int:
        more = 0
        heads = (keys >> self.second) // self.shared  # second words share containers too
        for seconds, k, c in _segments(heads, keys, counts):
            box = node.setdefault(seconds, {})
            more -= len(box)
            self._put(box, k.tolist(), c.tolist())
            more += len(box)
        return more

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Distinct packed phrases in rising order, and their counts."""
        full = set()
        for at, k, c in _segments(self._owners(keys >> self.first), keys, counts):
            box = self.boxes.setdefault(at, {})
            if at in self.nodes:
                more = self._put_below(box, k, c)
            else:
                more = -len(box)
                self._put(box, k.tolist(), c.tolist())
                more += len(box)
            self.held[at] = self.held.get(at, 0) + more
            self.size += more
            full.add(at)
        for at in full:  # when all are in: a burst changes owners
            if self.held[at] > self.burst_at and at not in self.nodes:
                self._burst(at)

    def _burst(self, at: int) -> None:
        k, c = _entries(self.boxes[at])
        order = np.argsort(k)
        k, c = k[order], c[order]
        if at in self.words:
            if self.deep:
                self.boxes[at] = node = {}
                self.nodes.add(at)
                self._put_below(node, k, c)
            return
        heads = k >> self.first
        words, sizes = np.unique(heads, return_counts=True)
        for word in words[sizes >= max(1, int(sizes.max()) // 2)].tolist():  # the most frequent ones leave
            own = heads == word
            new = -1 - word
            self.owner[word] = new
            self.words[new] = word
            self.boxes[new] = dict(zip(k[own].tolist(), c[own].tolist()))
            self.held[new] = int(own.sum())
            k, c, heads = k[~own], c[~own], heads[~own]
        self.boxes[at], self.held[at] = dict(zip(k.tolist(), c.tolist())), len(k)

    def spill(self, upto: int) -> tuple[np.ndarray, np.ndarray]:
        """Whole subtrees, the largest first, until ``upto`` entries stay."""
        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in sorted(self.held, key=self.held.get, reverse=True):
            if self.size <= upto:
                break
            box = self.boxes.pop(at)
            for part in box.values() if at in self.nodes else [box]:
                k, c = _entries(part)
                keys.append(k)
                counts.append(c)
            self.nodes.discard(at)
            self.size -= self.held.pop(at)
        return np.concatenate(keys), np.concatenate(counts)


def _entries(box: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.fromiter(box.keys(), np.int64, len(box)), np.fromiter(box.values(), np.int64, len(box))


def _segments(heads: np.ndarray, keys: np.ndarray, counts: np.ndarray):
    """(head, keys, counts) of neighbours of one head."""
    at = np.flatnonzero(np.diff(heads)) + 1
    bounds = [0, *at.tolist(), len(keys)]
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b > a:
            yield int(heads[a]), keys[a:b], counts[a:b]


class _Counter:
    """The phrases of one language in one task."""

    def __init__(self, lang: str, s: Settings, parts: int):
        self.lang, self.s, self.parts = lang, s, parts
        self.bits = 63 // s.longest
        self.words = 0
        self.numbers, self.trie = _Numbers({b".": 0}), _Trie(s, self.bits)
        self.hashes, self.control = np.zeros(0, np.uint64), False  # of the words that were spilled
        self.waiting: list[bytes] = []
        self.size = 0                   # bytes that wait
        self.before: list[bytes] = []   # the last words of the text that is being read

    def feed(self, text: str) -> Iterator[pa.RecordBatch]:
        data = text.encode("utf-8", "surrogatepass").translate(_TABLE).replace(b".", b" . ")
        at, step = 0, self.s.bytes
        while at < len(data):  # very long texts in pieces that end between words
            end = len(data) if at + step >= len(data) else data.find(b" ", at + step)
            end = len(data) if end < 0 else end
            self.waiting.append(data[at:end])
            self.size += end - at
            at = end
            if self.size >= step:
                yield from self._count(open_end=at < len(data))
        self.waiting.append(b".")

    def _count(self, open_end: bool) -> Iterator[pa.RecordBatch]:
        s, b = self.s, self.bits
        skip = len(self.before)  # read before: only phrases that end in later words are new
        text = pa.array([b" ".join(self.before + self.waiting)], pa.large_binary())
        self.waiting, self.size = [], 0
        words = pc.split_pattern(text, pattern=" ").flatten()
        words = words.filter(pc.greater(pc.binary_length(words), 0)).dictionary_encode()
        known, words = words.dictionary.to_pylist(), words.indices.to_numpy()
        self.before = [known[k] for k in words[len(words) - s.longest + 1:].tolist()] if open_end and s.longest > 1 else []
        if len(self.numbers) + len(known) >= 1 << b:  # numbers would not fit
            yield from self._spilled(0)
            self.trie, self.numbers = _Trie(s, b), _Numbers({b".": 0})
            self.hashes, self.control = np.zeros(0, np.uint64), False
        ids = np.fromiter(map(self.numbers.__getitem__, known), np.int64, len(known))[words]
        full = ids > 0
        self.words += int(full[skip:].sum())
        grams = []
        for n in range(1, s.longest + 1):
            last = np.arange(max(n - 1, skip), len(ids))
            ok = np.ones(len(last), bool)
            key = np.zeros(len(last), np.int64)
            for k in range(n):
                ok &= full[last - k]
                key |= ids[last - k] << (b * (s.longest - n + k))
            grams.append(key[ok])
        self.trie.add(*np.unique(np.concatenate(grams), return_counts=True))
        if self.trie.size > s.entries:
            yield from self._spilled(s.entries // 4)

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.waiting:
            yield from self._count(open_end=False)
        yield from self._spilled(0)
        none = [np.zeros(1, np.int32)] * self.s.longest
        yield self._run(0, pa.array([b"."], pa.large_binary()), none, np.array([self.words]))  # the words, as the phrase of none

    def _spilled(self, upto: int) -> Iterator[pa.RecordBatch]:
        keys, counts = self.trie.spill(upto)
        if not len(keys):
            return
        s, b, mask = self.s, self.bits, (1 << self.bits) - 1
        words = pa.array(list(self.numbers), pa.large_binary())
        # The order of phrases as bytes, from the order of the words.
        rank = np.empty(len(words), np.int64)
        rank[pc.sort_indices(words).to_numpy()] = np.arange(1, len(words) + 1)
        rank[0] = 0
        places = [((keys >> (b * (s.longest - 1 - k))) & mask).astype(np.int32) for k in range(s.longest)]
        ranked = np.zeros(len(keys), np.int64)
        for p in places:
            ranked = (ranked << b) | rank[p]
        fresh = words.slice(len(self.hashes)).to_pylist()
        self.control = self.control or any(min(w) < 33 for w in fresh)
        if self.control:  # control characters sort below the space between words
            phrases = [_phrase(words, ids) for ids in zip(*(p.tolist() for p in places))]
            ranked = np.empty(len(keys), np.int64)
            ranked[sorted(range(len(keys)), key=phrases.__getitem__)] = np.arange(len(keys))
        self.hashes = np.concatenate([self.hashes, word_hashes([w.decode("latin-1") for w in fresh])])
        dealt = self.hashes[places[0]]
        if s.longest > 1:
            dealt = mix(dealt + mix(self.hashes[places[1]] + np.uint64(1)))
        if s.longest > 2:
            dealt = mix(dealt + self.hashes[places[2]] % np.uint64(s.salts))
        part = (dealt % np.uint64(self.parts)).astype(np.uint16 if self.parts <= 1 << 16 else np.int64)
        order = np.argsort(ranked)
        order = order[np.argsort(part[order], kind="stable")]
        part, counts, places = part[order].astype(np.int64), counts[order], [p[order] for p in places]
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(part)]):
            for at in range(a, z, s.chunk):
                to = min(z, at + s.chunk)
                yield self._run(int(part[at]), words, [p[at:to] for p in places], counts[at:to])

    def _run(self, part: int, words: pa.Array, places: list[np.ndarray], counts: np.ndarray) -> pa.RecordBatch:
        """A piece of a run: its words once, phrases as places among them."""
        here = np.zeros(len(words), bool)
        for p in places:
            here[p] = True
        used = np.flatnonzero(here)
        to = np.empty(len(words), np.uint16 if len(used) <= 1 << 16 else np.uint32)
        to[used] = np.arange(len(used))
        ids = b"".join(to[p].tobytes() for p in places)
        own = words.take(pa.array(used))
        data = own.buffers()[2]
        lengths = np.diff(np.frombuffer(own.buffers()[1], np.int64)[: len(used) + 1])
        counts = np.asarray(counts, np.int32 if counts.max() < 1 << 31 else np.int64)
        low = _phrase(words, [int(p[0]) for p in places])
        return pa.RecordBatch.from_arrays([
            pa.array([part], pa.int32()), pa.array([self.lang], pa.string()), pa.array([low], pa.binary()),
            pa.array([len(counts)], pa.int32()), *(_squeezed(x) for x in (data.to_pybytes() if data else b"", lengths.astype(np.int32).tobytes(), ids, counts.tobytes()))],
            ["part", "lang", "low", "n", "data", "lengths", "ids", "counts"])


def _squeezed(x: bytes) -> pa.Array:
    """Length and compressed bytes."""
    return pa.array([len(x).to_bytes(8, "little") + pa.compress(x, "zstd", asbytes=True)], pa.binary())


def _opened(x: bytes) -> bytes:
    return pa.decompress(x[8:], int.from_bytes(x[:8], "little"), "zstd", asbytes=True)


def _phrase(words: pa.Array, ids) -> bytes:
    return b" ".join(words[k].as_py() for k in ids if k)


_SMALL = 1 << 30  # bytes of phrases that 32-bit offsets hold with room to spare


def _added(t: pa.Table) -> pa.Table:
    """The counts of each phrase added up.  Arrow groups texts of 32-bit
    offsets at a small part of the cost of others, which are left for what
    is too large for them."""
    wide, small = t.schema.field("phrase").type, t["phrase"].nbytes < _SMALL
    if small:
        t = t.set_column(0, "phrase", t["phrase"].cast(pa.binary()))
    t = t.group_by("phrase", use_threads=False).aggregate([("f", "sum")])
    return pa.table({"phrase": t["phrase"].cast(wide) if small else t["phrase"], "f": t["f_sum"]})


_RUN = "part int, lang string, low binary, n int, data binary, lengths binary, ids binary, counts binary"
_COUNTS = "lang string, phrase string, words int, f long"


def runs(docs: DataFrame, s: Settings, parts: int) -> DataFrame:
    """Sorted runs of phrase counts, of each task's texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[str, _Counter] = {}
        for b in batches:
            for text, lang in zip(b.column("text"), b.column("lang").to_pylist()):
                if lang not in counters:
                    counters[lang] = _Counter(lang, s, parts)
                yield from counters[lang].feed(text.as_py())
            # Languages share the room: the fullest one is counted, or spills.
            while sum(c.size for c in counters.values()) > 2 * s.bytes:
                yield from max(counters.values(), key=lambda c: c.size)._count(open_end=False)
            while sum(c.trie.size for c in counters.values()) > s.entries:
                yield from max(counters.values(), key=lambda c: c.trie.size)._spilled(0)
        for c in counters.values():
            yield from c.end()

    lang, text = F.coalesce(F.col("lang").cast("string"), F.lit("und")), F.coalesce(F.col("text"), F.lit(""))
    return docs.select(text.alias("text"), lang.alias("lang")).mapInArrow(count, _RUN)


def _read(row: dict, longest: int) -> pa.Table:
    data, lengths, ids, counts = (_opened(row[c]) for c in ("data", "lengths", "ids", "counts"))
    ends = np.cumsum(np.append(0, np.frombuffer(lengths, np.int32)), dtype=np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data)])
    ids = np.frombuffer(ids, np.uint16 if len(ends) - 1 <= 1 << 16 else np.uint32).reshape(longest, -1)
    counts = np.frombuffer(counts, np.int32 if len(counts) == 4 * row["n"] else np.int64).astype(np.int64)
    space, phrases = pa.scalar(b" ", pa.large_binary()), None
    none = data[: ends[1]] == b"."  # the end of a piece stands for no word
    for place in ids:
        word = words.take(pa.array(place.astype(np.int32)))
        if phrases is None:
            phrases = pc.if_else(pa.array(place > 0), word, pa.scalar(b"", pa.large_binary())) if none else word
        else:
            longer = pc.binary_join_element_wise(phrases, word, space)
            phrases = pc.if_else(pa.array(place > 0), longer, phrases) if none else longer
    return pa.table({"phrase": phrases, "f": counts})


def merged(found: DataFrame, s: Settings, tasks: int) -> DataFrame:
    """(lang, phrase, words, f) of phrases that occur ``least`` times or more
    (and the words of each language, as the phrase of none)."""
    least, chunk, longest = s.least, s.chunk, s.longest

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size = None, [], 0

        def out(t: pa.Table) -> pa.RecordBatch:
            t = t.filter(pc.or_(pc.greater_equal(t["f"], least), pc.equal(pc.binary_length(t["phrase"]), 0)))
            phrase = t["phrase"].combine_chunks()
            spaces = pc.count_substring(phrase, " ")
            words = pc.if_else(pc.equal(pc.binary_length(phrase), 0), 0, pc.add(spaces, 1))
            return pa.RecordBatch.from_arrays([pa.array([key[1]] * len(t), pa.string()), phrase.cast(pa.large_string()).cast(pa.string()),
                                               words.cast(pa.int32()), t["f"].combine_chunks()], ["lang", "phrase", "words", "f"])

        def added() -> pa.Table:
            return _added(pa.concat_tables(held))

        limit = 16 * chunk
        for b in batches:
            for row in b.to_pylist():
                if (row["part"], row["lang"]) != key:
                    if held:
                        yield out(added())
                    key, held, size, limit = (row["part"], row["lang"]), [], 0, 16 * chunk
                elif size > limit:
                    t = added()
                    # Runs come in the order of their first phrases: below this one nothing more can come.
                    done = pc.less(t["phrase"], pa.scalar(row["low"], pa.large_binary()))
                    yield out(t.filter(done))
                    held = [t.filter(pc.invert(done))]
                    size = held[0].num_rows
                    limit = max(16 * chunk, 2 * size)
                held.append(_read(row, longest))
                size += held[-1].num_rows
        if held:
            yield out(added())

    dealt = found.repartition(tasks, "part", "lang").sortWithinPartitions("part", "lang", "low")
    return dealt.mapInArrow(merge, _COUNTS)


def phrase_counts(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(lang, phrase, words, f) of every phrase of ``least`` occurrences or
    more; the phrase of no words has the count of all words of the language."""
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return merged(runs(docs, s, 2 * tasks), s, tasks)


def collocations(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A null or empty text has no words; a null language is ``und``; repeated
    rows count each; ties rank by count, then by the phrase's UTF-8 bytes; an
    empty table gives an empty result."""
    counts = stored(phrase_counts(docs, s), "phrases")
    some = counts.filter("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"))
    word = F.split("phrase", " ", -1)
    # Every cut of every candidate, with the counts of both sides (these reach the least count too).
    cut = some.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cut = cut.withColumns({"head": F.array_join(F.slice(word, F.lit(1), F.col("k")), " "),
                           "rest": F.array_join(F.slice(word, F.col("k") + 1, F.col("words") - F.col("k")), " ")})
    part = counts.filter("words >= 1")
    cut = cut.join(part.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cut = cut.join(part.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    # Decimals of 38 digits: exact up to 10**13 occurrences of one phrase.
    score = F.expr("(CAST(1000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0))) "
                   "div (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0)))")
    cut = cut.withColumn("score", score)
    scored = cut.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("least"), F.first("a").alias("a"))
    # Candidates that mostly occur inside one longer candidate.
    longer = some.filter("words >= 3").select("lang", "words", F.col("a").alias("b"), word.alias("w"))
    longer = longer.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    longer = longer.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    longer = longer.select("lang", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("phrase"), "b")
    longer = longer.groupBy("lang", "phrase").agg(F.max("b").alias("b"))
    kept = scored.join(longer, ["lang", "phrase"], "left").filter(F.expr(f"b IS NULL OR 100 * b < {int(s.inside)} * a"))
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    kept = kept.select("lang", "phrase", "a", "least.l", "least.r", "least.score")
    kept = kept.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= s.top)
    total = counts.filter("words = 0").select("lang", F.col("f").alias("n"))
    return kept.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
