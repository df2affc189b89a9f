"""Near duplicates of embeddings by collision-counting projections.

Unit vectors are projected on many random lines.  Two vectors collide on a
line if one lies in the window around the other; a pair at the cosine
threshold differs by a known normal distribution on every line, so the least
number of collisions that a linked pair has, but for a chosen share, is
calibrated from it (``least_collisions``).  Pairs that reach this count are
verified on the vectors themselves, in double precision.

Counting all pairs would be quadratic, so pairs are counted in cells.  The
projections of a *tree* are sorted at cuts near their medians; a vector whose
window reaches over a cut belongs to both sides of it.  Cells are the sides of
all cuts of a tree; a tree loses a pair only where it lies wholly across a
cut, and trees are added until the computed loss is below ``1 - recall``.
A pair that shares several cells is looked at in the first of them only.

Cells first get 8-bit projections, and only vectors with a counted pair are
sent there again whole.  Very large cells are dealt in blocks, every block
meeting every other.  Dense groups of near copies are taken out first: what
lies within half the threshold's angle of one leader is linked with all the
others there (the angles add up), which is a count and a star of edges
instead of all pairs.  Nothing is capped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakefold.llm.common import stored
from lakefold.llm.near_dup import _bounds, _groups, components

_TREE = 44           # bits of a cell's number below the number of its tree
_STEP = 28           # 8-bit steps of a projection's unit
_FEW = 20_000        # rows of a table that is broadcast at most


@dataclass(frozen=True)
class Settings:
    cosine: float = 0.95
    recall: float = 0.999    # of pairs right at the threshold; closer ones are lost less
    lines: int = 40          # projections whose collisions are counted
    window: float = 1.6      # half a window, in standard deviations of such a pair's difference
    margin: float = 0.63     # reach over a cut, in the same unit
    small: int = 256         # vectors wanted in a cell
    block: int = 1024        # larger cells are dealt in blocks of this size
    sample: int = 8192       # vectors, chosen by a hash of the id, that place the cuts
    choices: int = 6         # lines tried for each cut
    seed: int = 11

    @property
    def spread(self) -> float:
        """Standard deviation, on a line, of the difference of a pair at the threshold."""
        return math.sqrt(2 * (1 - self.cosine))

    @property
    def steps(self) -> int:
        """Half a window in 8-bit steps, rounding included."""
        return math.ceil(self.window * self.spread * _STEP) + 1

    @property
    def core(self) -> float:
        """Cosine to a leader above which any two are linked (a margin for rounding included)."""
        return math.sqrt((1 + self.cosine) / 2) + 1e-9


def least_collisions(s: Settings) -> int:
    """The count that a pair at the threshold misses with (1 - recall) / 4 at most."""
    p = math.erf(s.window / math.sqrt(2))
    below = 0.0
    for k in range(s.lines + 1):
        below += math.comb(s.lines, k) * p**k * (1 - p) ** (s.lines - k)
        if below > (1 - s.recall) / 4:
            return k
    return s.lines


def units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow of squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


@dataclass(frozen=True)
class Trees:
    lines: np.ndarray        # dimension x (counted lines, then the lines of the cuts)
    cuts: np.ndarray         # place of each cut on its line
    tree: np.ndarray         # tree of each cut


def planned(sample: np.ndarray, rows: int, s: Settings) -> Trees:
    """Lines and cuts, fitted on unit vectors of the sample."""
    rng = np.random.default_rng(s.seed)
    dim = sample.shape[1]
    counted = rng.standard_normal((dim, s.lines))
    levels = min(_TREE - 1, max(0, math.ceil(math.log2(max(rows, 1) / s.small))))
    reach = s.margin * s.spread
    t = 2 * s.margin
    across = s.spread * 2 * (math.exp(-t * t / 2) / math.sqrt(2 * math.pi) - t * 0.5 * math.erfc(t / math.sqrt(2)))
    lines, cuts, tree, missed, n = [], [], [], 1.0, 0
    while levels and missed > (1 - s.recall) / 2:
        kept = 1.0
        for _ in range(levels):
            tried = rng.standard_normal((dim, s.choices))
            x = np.sort(sample @ tried, axis=0)
            best = None
            for c in range(s.choices):  # where the fewest vectors lie near the cut
                for at in np.quantile(x[:, c], np.linspace(0.35, 0.65, 13)):
                    near = (np.searchsorted(x[:, c], at + reach) - np.searchsorted(x[:, c], at - reach)) / len(x)
                    if best is None or near < best[0]:
                        best = near, at, tried[:, c]
            if best[0] > 0.35:  # such a cut would double more than it parts
                continue
            lines.append(best[2])
            cuts.append(best[1])
            tree.append(n)
            kept *= 1 - min(1.0, max(best[0] / (2 * reach), 0.4) * across)
        n += 1
        missed *= 1 - kept
        if kept == 1.0:
            break  # no cut: one cell holds all
    all_lines = np.concatenate([counted, np.array(lines).T], 1) if lines else counted
    return Trees(all_lines, np.array(cuts), np.array(tree, np.int64))


def _placed(x: np.ndarray, t: Trees, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of unit vectors: 8-bit projections; codes (side and reach of each tree's
    cuts); row and cell of all their places."""
    y = x @ t.lines[: x.shape[1]]
    sketch = np.clip(np.rint(y[:, : s.lines] * _STEP), -127, 127).astype(np.int8)
    off = y[:, s.lines:] - t.cuts
    trees = int(t.tree.max()) + 1 if len(t.tree) else 1
    codes = np.zeros((len(x), 2 * trees), np.int64)
    rows, cells = [], []
    for n in range(trees):
        mine = np.flatnonzero(t.tree == n)
        at, cell = np.arange(len(x)), np.full(len(x), n << _TREE, np.int64)
        for bit, k in enumerate(mine):
            right, both = off[:, k] > 0, np.abs(off[:, k]) <= s.margin * s.spread
            codes[:, 2 * n] |= right.astype(np.int64) << bit
            codes[:, 2 * n + 1] |= both.astype(np.int64) << bit
            two = both[at]
            cell = np.concatenate([cell | (right[at].astype(np.int64) << bit), cell[two] | ((~right[at[two]]).astype(np.int64) << bit)])
            at = np.concatenate([at, at[two]])
        rows.append(at)
        cells.append(cell)
    return sketch, codes, np.concatenate(rows), np.concatenate(cells)


def usable(v: Column) -> Column:
    """Vectors with a direction: no null, NaN or infinite component, not all zero."""
    fine = F.forall(v, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce((F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _vectors(blobs, dims) -> np.ndarray:
    """The vectors of a frame as one array, shorter ones filled up with zeros."""
    out = np.zeros((len(blobs), int(max(dims))))
    for k, b in enumerate(blobs):
        v = np.frombuffer(b, np.float64)
        out[k, : len(v)] = v
    return out


def _features(rows: DataFrame, t: Trees, s: Settings) -> DataFrame:
    schema = "vec_id long, dim int, v binary, sketch binary, codes binary, cells array<long>"

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            vectors = [np.asarray(v, np.float64) for v in b["v"]]
            dims = np.array([len(v) for v in vectors])
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = np.stack([vectors[k] for k in at])
                sketch, codes, row, cell = _placed(units(x), t, s)
                order = np.argsort(row, kind="stable")
                ends = np.cumsum(np.bincount(row, minlength=len(at)))[:-1]
                yield pd.DataFrame({"vec_id": b["vec_id"].iloc[at].astype("Int64").to_numpy(object, na_value=None), "dim": np.int32(d),
                                    "v": [v.tobytes() for v in x], "sketch": [v.tobytes() for v in sketch],
                                    "codes": [v.tobytes() for v in codes], "cells": np.split(cell[order], ends)})

    return rows.mapInPandas(of, schema)


# ------------------------------------------------------------ dense groups

def _few(df: DataFrame) -> DataFrame:
    """A stored table, broadcast if its rows are few."""
    return F.broadcast(df) if df.count() <= _FEW else df


def _cores(features: DataFrame, big: DataFrame, s: Settings) -> DataFrame:
    """(key, core): vectors within half the angle of a leader, told by the
    leader's key.  A sample of each large cell names the leaders; then every
    member of the cell goes to the first one that is near enough."""
    inside = features.select("key", "v", "dim", F.explode("cells").alias("cell")).filter(F.col("cell") < 1 << _TREE)
    inside = inside.join(_few(big), "cell").withColumn("blocks", F.ceil(F.col("size") / s.block).cast("int"))
    inside = inside.withColumn("block", F.pmod(F.xxhash64("key", F.lit(5)), F.col("blocks")).cast("int"))

    def lead(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _groups(batches, ["cell"]):
            at = _bounds(frame, ["cell"])
            for a, b in zip(at[:-1], at[1:]):
                part = frame.iloc[a:b]
                u = units(_vectors(part["v"], part["dim"]))
                sure = (u @ u.T >= s.core) & (part["dim"].to_numpy()[:, None] == part["dim"].to_numpy())
                picked = []
                while len(picked) < 16:
                    near = sure.sum(1)
                    best = int(near.argmax())
                    if near[best] < max(16, len(part) // 50):
                        break
                    picked.append(best)
                    sure[:, sure[best].copy()] = False
                yield part.iloc[picked].assign(nth=np.arange(len(picked), dtype=np.int32))[["cell", "blocks", "nth", "key", "v", "dim"]]

    first = inside.filter("block = 0").select("cell", "blocks", "key", "v", "dim")
    leaders = first.repartition("cell").sortWithinPartitions("cell", "key").mapInPandas(lead, "cell long, blocks int, nth int, key long, v binary, dim int")
    leaders = stored(leaders, "leaders")
    everywhere = leaders.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = everywhere.select("cell", "block", "nth", "key", "v", "dim").unionByName(
        inside.join(_few(stored(leaders.select("cell").distinct(), "cells")), "cell").select("cell", "block", F.lit(99).alias("nth"), "key", "v", "dim"))

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _groups(batches, ["cell", "block"]):
            at = _bounds(frame, ["cell", "block"])
            for a, b in zip(at[:-1], at[1:]):
                part = frame.iloc[a:b]
                u, dim, key = units(_vectors(part["v"], part["dim"])), part["dim"].to_numpy(), part["key"].to_numpy()
                k = int((part["nth"] < 99).sum())
                ok = (u[k:] @ u[:k].T >= s.core) & (dim[k:, None] == dim[None, :k])
                hit = ok.any(1)
                yield pd.DataFrame({"key": key[k:][hit], "core": key[:k][ok.argmax(1)[hit]]}, dtype="int64")

    dealt = rows.repartition("cell", "block").sortWithinPartitions("cell", "block", "nth", "key")
    return dealt.mapInPandas(near, "key long, core long").groupBy("key").agg(F.min("core").alias("core"))


# --------------------------------------------------------- counting, links

def _dealt(rows: DataFrame, big: DataFrame, s: Settings) -> DataFrame:
    """With the pairs of blocks (i, j) of its cell that a row goes to, and its own ``block``."""
    big = _few(big)
    usual = rows.join(big, "cell", "left_anti").withColumns({"i": F.lit(0), "j": F.lit(0), "block": F.lit(0)})
    large = rows.join(big.drop("size"), "cell")
    parts = large.groupBy("cell", "core").agg(F.ceil(F.count(F.lit(1)) / s.block).cast("int").alias("own"))
    w = Window.partitionBy("cell")  # one row for each dense group that reaches into the cell
    before = F.sum("own").over(w.orderBy("core").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumns({"from": F.coalesce(before, F.lit(0)).cast("int"), "all": F.sum("own").over(w).cast("int")})
    large = large.join(_few(stored(parts, "blocks")), ["cell", "core"])
    large = large.withColumn("block", (F.col("from") + F.pmod(F.xxhash64("key", F.lit(6)), F.col("own"))).cast("int"))
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("all") - 1)))
    # Two blocks of one dense group have nothing to find.
    large = large.filter("core < 0 OR other < `from` OR other >= `from` + own")
    large = large.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    return usual.unionByName(large.select(*usual.columns))


_ROW = "cell long, i int, j int, block int, key long, core long, dim int, sketch binary, codes binary"


def _counted(part: pd.DataFrame, s: Settings, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (x < y) of one cell, or of two blocks of it, that collide often
    enough and have no earlier cell in common."""
    x = np.frombuffer(b"".join(part["sketch"]), np.int8).reshape(len(part), -1).astype(np.int16)
    n = len(x)
    count = np.zeros((n, n), np.int8)
    rank = np.empty(n, np.int16)
    for p in range(x.shape[1]):  # each line sorted; around each vector a window of ranks
        order = np.argsort(x[:, p], kind="stable")
        line = x[order, p]
        rank[order] = np.arange(n)
        low = np.searchsorted(line, x[:, p] - s.steps, "left").astype(np.int16)
        high = np.searchsorted(line, x[:, p] + s.steps, "right").astype(np.int16)
        count += (rank[None, :] >= low[:, None]) & (rank[None, :] < high[:, None])
    a, b = np.nonzero(np.triu(count >= least, 1))
    core, dim, block = (part[c].to_numpy() for c in ("core", "dim", "block"))
    ok = (dim[a] == dim[b]) & ((core[a] < 0) | (core[a] != core[b]))
    if part["i"].iloc[0] != part["j"].iloc[0]:
        ok &= block[a] != block[b]
    a, b = a[ok], b[ok]
    codes = np.frombuffer(b"".join(part["codes"]), np.int64).reshape(n, -1)
    side, both = codes[:, ::2], codes[:, 1::2]
    cell = int(part["cell"].iloc[0])
    tree, code = cell >> _TREE, cell & ((1 << _TREE) - 1)
    first = np.ones(len(a), bool)
    for t in range(tree):
        first &= ((side[a, t] ^ side[b, t]) & ~(both[a, t] | both[b, t])) != 0  # not in one cell of this tree
    lowest = (side[a, tree] & ~both[a, tree]) | (side[b, tree] & ~both[b, tree])
    first &= lowest == code
    return a[first], b[first]


def _rooted(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place that each of ``n`` is joined with."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _candidates(dealt: DataFrame, s: Settings) -> DataFrame:
    """The rows that have a counted pair in their cell."""
    least = least_collisions(s)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _groups(batches, ["cell", "i", "j"]):
            at = _bounds(frame, ["cell", "i", "j"])
            keep = [np.zeros(0, np.int64)]
            for a, b in zip(at[:-1], at[1:]):
                if b - a > 1:
                    x, y = _counted(frame.iloc[a:b], s, least)
                    keep.append(a + np.unique(np.concatenate([x, y])))
            yield frame.iloc[np.concatenate(keep)]

    rows = dealt.select("cell", "i", "j", "block", "key", "core", "dim", "sketch", "codes")
    return rows.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j", "key").mapInPandas(count, _ROW)


def _verified(found: DataFrame, s: Settings) -> DataFrame:
    """(key, n, root): links of a vector in a cell, and the smallest key there that it is joined with."""
    least = least_collisions(s)

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _groups(batches, ["cell", "i", "j"]):
            at = _bounds(frame, ["cell", "i", "j"])
            out = [np.zeros((0, 3), np.int64)]
            for a, b in zip(at[:-1], at[1:]):
                part = frame.iloc[a:b]
                x, y = _counted(part, s, least)
                u = units(_vectors(part["v"], part["dim"]))
                ok = (u @ u.T)[x, y] >= s.cosine
                x, y = x[ok], y[ok]
                key, root = part["key"].to_numpy(), _rooted(len(part), x, y)
                links = np.bincount(np.concatenate([x, y]), minlength=len(part))
                some = links > 0
                out.append(np.stack([key[some], links[some], key[root[some]]], 1))
            yield pd.DataFrame(np.concatenate(out), columns=["key", "n", "root"])

    return found.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j", "key").mapInPandas(verify, "key long, n long, root long")


def _links(rows: DataFrame, s: Settings) -> DataFrame:
    """(key, vec_id, n_links, label) of each usable vector."""
    size = rows.agg(F.count(F.lit(1)).alias("rows"), F.max(F.size("v")).alias("dim")).first()
    # At most ``sample`` rows come to the driver.
    some = rows.select("v", F.xxhash64(F.col("vec_id"), F.lit(s.seed)).alias("h")).orderBy("h").limit(s.sample).collect()
    sample = np.zeros((len(some), size.dim))
    for k, r in enumerate(some):
        sample[k, : len(r.v)] = r.v
    trees = planned(units(sample), size.rows, s)
    features = stored(_features(rows, trees, s).withColumn("key", F.monotonically_increasing_id()), "vectors")
    cells = features.select("key", F.explode("cells").alias("cell"))
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("size"))
    big = stored(sizes.filter(F.col("size") > s.block), "big")
    if big.filter(F.col("cell") < 1 << _TREE).isEmpty():
        cores = None
        placed = features.withColumn("core", F.lit(-1).cast("long"))
    else:
        cores = stored(_cores(features, big, s), "cores")
        placed = features.join(cores, "key", "left").withColumn("core", F.coalesce("core", F.lit(-1).cast("long")))
    placed = placed.select("key", "core", "dim", "sketch", "codes", F.explode("cells").alias("cell"))
    if big.isEmpty():
        dealt = placed.withColumns({"i": F.lit(0), "j": F.lit(0), "block": F.lit(0)})
    else:
        dealt = _dealt(placed, big, s)
    found = _candidates(dealt, s).join(features.select("key", "v"), "key")
    got = stored(_verified(found, s), "links")
    links = got.groupBy("key").agg(F.sum("n").alias("n"))
    edges = got.select(F.col("root").alias("a"), F.col("key").alias("b"))
    if cores is not None:
        groups = cores.groupBy("core").agg(F.count(F.lit(1)).alias("k"), F.min("key").alias("a"))
        in_core = stored(cores.join(groups, "core").select("key", (F.col("k") - 1).alias("n"), "a"), "cores")
        links = links.unionByName(in_core.select("key", "n")).groupBy("key").agg(F.sum("n").alias("n"))
        edges = edges.unionByName(in_core.select("a", F.col("key").alias("b")))
    labels = components(edges.distinct()).withColumnRenamed("fp", "key")
    out = features.select("key", "vec_id").join(links, "key", "left").join(labels, "key", "left")
    return out.select("key", "vec_id", F.coalesce("n", F.lit(0)).alias("n_links"), F.coalesce("label", "key").alias("label"))


def duplicates(table: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold a null or non-finite component
    are linked with nothing, vectors of different lengths are not linked.  A
    row without id counts as a link and joins a component, but does not name
    it and is not kept; repeated rows are vectors each (and linked with one
    another); an empty table gives an empty result."""
    kind = table.schema["embedding"].dataType
    vectors = F.col("embedding") if kind.simpleString() == "array<double>" else F.col("embedding").cast("array<double>")
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), vectors.alias("v"))
    fine = rows.filter(usable(F.col("v")))
    rest = rows.filter(~usable(F.col("v"))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if not fine.isEmpty():
        links = stored(_links(fine, s), "linked")
        names = links.groupBy("label").agg(F.min("vec_id").alias("component_id"))
        rest = links.join(names, "label").select("vec_id", "n_links", "component_id").unionByName(rest)
    return rest.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
