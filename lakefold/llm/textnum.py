"""Texts as numpy arrays: token codes, polynomial hashes, labelled samples."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PRIME = np.uint64(0x9E3779B97F4A7C15)  # fixed value: an odd 64-bit multiplier


def slices(texts, chars: int = 3_000_000):
    """(start, texts) of about ``chars`` characters each; None becomes ""."""
    texts = [t if isinstance(t, str) else "" for t in texts]
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= chars):
            size += len(texts[end])
            end += 1
        yield at, texts[at:end]
        at = end


def encode(texts: list[str], findall) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Token codes of all texts in one array, the texts' offsets in it, and
    the distinct tokens that the codes stand for."""
    flat: list[str] = []
    offsets = np.zeros(len(texts) + 1, np.int64)
    for k, t in enumerate(texts):
        flat += findall(t)
        offsets[k + 1] = len(flat)
    enc = pa.array(flat, pa.large_string()).dictionary_encode()
    return enc.indices.to_numpy(), offsets, enc.dictionary.to_pylist()


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values between neighbouring offsets (along axis 0)."""
    out = np.zeros((len(offsets) - 1, *values.shape[1:]), values.dtype)
    full = offsets[1:] > offsets[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, offsets[:-1][full], axis=0)
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all its bits depend on all of the input."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _flat(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return codes, np.append(0, np.cumsum(sizes))


def word_hashes(words: list[str]) -> np.ndarray:
    """A 64-bit hash of each (non-empty) word."""
    if not words:
        return np.zeros(0, np.uint64)
    codes, off = _flat(words)
    place = np.arange(len(codes)) - np.repeat(off[:-1], np.diff(off))
    power = np.cumprod(np.full(int(place.max()) + 1, _PRIME))
    return mix(np.add.reduceat(mix(codes * _PRIME) * power[place], off[:-1]))


def subwords(words: list[str], low: int, high: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of the character n-grams of ``<word>`` and of
    the word as a whole."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    marked = [f"<{w}>" for w in words]
    codes, off = _flat(marked)
    of = np.repeat(np.arange(len(words)), np.diff(off))
    left = np.repeat(off[1:], np.diff(off)) - np.arange(len(codes))  # characters up to the word's end
    numbers, hashes = [np.arange(len(words))], [word_hashes(marked)]
    rolling = np.zeros(len(codes), np.uint64)
    for n in range(1, min(high, len(codes)) + 1):
        rolling = rolling * _PRIME
        rolling[: len(codes) - n + 1] += codes[n - 1:]
        if n >= low:
            ok = left >= n
            numbers.append(of[ok])
            hashes.append(mix(rolling[ok] + np.uint64(n)))
    return np.concatenate(numbers), (np.concatenate(hashes) % np.uint64(buckets)).astype(np.int64)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, zeros: int, ones: int,
                    longest: int = 100_000) -> DataFrame:
    """(doc_id, text, y) of at most ``zeros`` and ``ones`` labelled documents
    of the two classes, chosen by a hash of the id among the rows that may be
    learnt from: one row an id, the least of its texts.

    A document with several labels counts as 1 if any of them is 1; rows
    without id, label or text, and texts of more than ``longest`` bytes, are
    not learnt from."""
    one = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & learn)
    one = one.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    order = [F.xxhash64(F.col("doc_id").cast("string")), "doc_id"]
    picked = None
    for y, bound in ((0, zeros), (1, ones)):
        some = one.filter(F.col("y") == y).orderBy(*order).limit(bound)
        picked = some if picked is None else picked.unionByName(some)
    # The chosen ids are at most zeros + ones rows.
    texts = docs.select("doc_id", "text").filter(F.octet_length("text") <= longest).join(F.broadcast(picked), "doc_id")
    return texts.groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("doc_id", "text", "y")


def class_rates(labels: DataFrame, label: str, learn: Column) -> tuple[int, int]:
    """Labelled documents of class 0 and 1 among all that may be learnt from."""
    one = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & learn)
    one = one.groupBy("doc_id").agg(F.max(label).alias("y"))
    r = one.agg(F.count_if(F.col("y") == 0).alias("n"), F.count_if(F.col("y") == 1).alias("p")).first()
    return r.n, r.p
