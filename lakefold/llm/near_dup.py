"""Near duplicates on word shingles by chosen-path set similarity join.

Documents with the same shingle set are one class and go through the join
once.  Every class has minwise values of its set.  Independent trees place
each class in the node of one chosen minwise value; nodes above a size are
split by further chosen values, level by level; nodes that are small enough
are compared exhaustively, on 128 one-byte minwise values a class, and what
may reach the threshold is confirmed on the full sets.

Links are only needed to form components, so the confirmation comes in two
rounds.  First each node proposes a spanning forest of its closest pairs,
which is linear in its size, however many of its members are alike.  After
these are confirmed and joined up, the nodes turn to every pair left between
different components.  A pair inside one component cannot change anything.
Small nodes propose these pairs; larger ones, where they may be many, get
the full sets of their members once and give back confirmed links only.

Recall: two sets of similarity j share a root node of one of ``trees`` trees
with probability 1 - (1 - j) ** trees (1 - 6e-8 at j = 0.75 and 12 trees);
each further level keeps a pair with 1 - (1 - j) ** 2 at least.  A pair is
proposed if its values agree in ``floor_agree`` of 128 places, four standard
deviations below what j = 0.75 gives, and the sets' sizes allow it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakefold.llm.common import stored
from lakefold.llm.textnum import mix, slices, word_hashes

_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_PLACES = 128
_FEW = 200_000  # rows of a table of keys that is broadcast at most


@dataclass(frozen=True)
class Settings:
    width: int = 5            # words of a shingle
    percent: int = 75         # link if 100 * intersection >= percent * union
    trees: int = 12
    small: int = 4096         # nodes up to this size are compared exhaustively
    whole: int = 48           # larger nodes get their members' full sets, and confirm links themselves
    whole_items: int = 4_000_000  # unless these sets have more shingles than this together
    levels: int = 4           # splits of larger nodes; what is larger still is compared block by block
    floor_agree: int = 77     # of 128 minwise values, to be confirmed on the full sets
    seed: int = 7


# ------------------------------------------------------------ sets of texts

def shingle_sets(texts, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    Words are runs outside white space (\\x20, \\x09-\\x0D) with A-Z in lower
    case; a text of fewer words than a shingle is one shingle; a text without
    words, or null, has none."""
    for _, part in slices(texts):
        flat: list[bytes] = []
        offsets = [0]
        for t in part:
            flat += t.encode("utf-8", "surrogatepass").translate(_LOWER).split()
            offsets.append(len(flat))
        enc = pa.array(flat, pa.large_binary()).dictionary_encode()
        own = word_hashes([w.decode("latin-1") for w in enc.dictionary.to_pylist()])
        h = own[enc.indices.to_numpy()] if len(flat) else np.zeros(0, np.uint64)
        rolled = np.zeros(max(len(h) - width + 1, 0), np.uint64)
        for k in range(width):
            rolled += mix(h[k:len(h) - width + 1 + k] + np.uint64(2 * k + 1))
        rolled = mix(rolled)
        for a, b in zip(offsets[:-1], offsets[1:]):
            if b - a >= width:
                yield np.unique(rolled[a:b - width + 1])
            elif b > a:
                parts = sum((mix(h[a + k:a + k + 1] + np.uint64(2 * k + 1)) for k in range(b - a)), np.zeros(1, np.uint64))
                yield mix(parts + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)


def _minwise(s: Settings) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(s.seed)
    n = _PLACES + s.trees
    return rng.integers(0, 2**63, n, dtype=np.uint64), rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def features(docs: DataFrame, s: Settings) -> DataFrame:
    """(doc_id, h, n, fp, fp2, roots, sketch) of each row: a hash of the text,
    set size, the set's two digests, its root values in the trees, and 128
    one-byte values."""
    schema = "doc_id long, h long, n long, fp long, fp2 long, roots array<long>, sketch binary"

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        xor, mul = _minwise(s)
        for b in batches:
            rows = []
            for u in shingle_sets(b["text"].tolist(), s.width):
                if not len(u):
                    rows.append((0, None, None, None, None))
                    continue
                least = np.full(len(xor), np.iinfo(np.uint64).max)
                for at in range(0, len(u), 4096):  # long texts in pieces: bounded memory
                    least = np.minimum(least, ((u[at:at + 4096, None] ^ xor) * mul).min(0))
                least = mix(least)
                fp = mix(u + np.uint64(1)).sum(dtype=np.uint64), mix(u ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
                rows.append((len(u), *np.array(fp, np.uint64).view(np.int64).tolist(), least[_PLACES:].view(np.int64).tolist(),
                             (least[:_PLACES] >> np.uint64(56)).astype(np.uint8).tobytes()))
            out = pd.DataFrame(rows, columns=["n", "fp", "fp2", "roots", "sketch"])
            out = out.astype({"fp": "Int64", "fp2": "Int64"})
            out.insert(0, "doc_id", b["doc_id"].astype("Int64"))
            out.insert(1, "h", b["h"].to_numpy())
            yield out

    return _keyed(docs).select("doc_id", "h", "text").mapInPandas(of, schema)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"doc_id": F.col("doc_id").cast("long"), "h": F.xxhash64("text")})


# ------------------------------------------------------------------- trees

def _members(classes: DataFrame, s: Settings) -> DataFrame:
    """(node, fp, sketch, n, block): classes in nodes of two and more.

    Roots first; nodes above ``small`` are split by two chosen places of the
    sketch each level.  Nodes that stay larger are dealt into blocks."""
    roots = classes.select("fp", F.posexplode("roots").alias("tree", "value"))
    level = roots.select(F.xxhash64("tree", "value").alias("node"), "fp")
    sketches = classes.select("fp", "sketch", "n")
    kept, large = [], None
    for depth in range(s.levels + 1):
        sizes = level.groupBy("node").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        sized = level.join(sizes, "node")
        if depth == 0:
            sized = sized.join(sketches, "fp")
        sized = stored(sized, "nodes")
        kept.append(sized.filter(F.col("size") <= s.small))
        large = sized.filter(F.col("size") > s.small)
        if depth == s.levels or large.isEmpty():
            break
        # Two places of the sketch, chosen by the node; children are keyed by the values there.
        first = F.pmod(F.xxhash64("node", F.lit(depth)), F.lit(_PLACES)).cast("int")
        step = F.pmod(F.xxhash64("node", F.lit(depth + 100)), F.lit(_PLACES - 1)).cast("int") + 1
        places = F.array(first, F.pmod(first + step, F.lit(_PLACES)))
        child = large.select("node", "fp", "sketch", "n", F.explode(places).alias("place"))
        value = F.substring(F.col("sketch"), F.col("place") + 1, F.lit(1))
        level = child.select(F.xxhash64("node", "place", value).alias("node"), "fp", "sketch", "n")
    out = kept[0]
    for more in kept[1:]:
        out = out.unionByName(more)
    out = out.withColumn("blocks", F.lit(1))
    if not large.isEmpty():
        out = out.unionByName(large.withColumn("blocks", F.ceil(F.col("size") / s.small).cast("int")))
    return out.withColumn("block", F.pmod(F.xxhash64("fp", F.lit(3)), F.col("blocks")).cast("int"))


def _groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Frames that hold whole groups of neighbouring rows with equal keys."""
    held: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        k = b[keys].to_numpy()
        cut = np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1
        if held and (k[0] != held[-1][keys].to_numpy()[-1]).any():
            cut = np.append(0, cut)
        if not len(cut):
            held.append(b)
            continue
        held.append(b.iloc[:cut[-1]])
        yield pd.concat(held, ignore_index=True)
        held = [b.iloc[cut[-1]:]]
    if held:
        yield pd.concat(held, ignore_index=True)


def _bounds(frame: pd.DataFrame, keys: list[str]) -> np.ndarray:
    k = frame[keys].to_numpy()
    return np.concatenate([[0], np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1, [len(k)]])


def _forest(sim: np.ndarray, least: int) -> list[tuple[int, int]]:
    """A spanning forest of the closest pairs that agree in ``least`` places (Prim)."""
    n = len(sim)
    out: list[tuple[int, int]] = []
    best, via, open_ = np.full(n, -1), np.zeros(n, int), np.ones(n, bool)
    for _ in range(n):
        at = int(np.where(open_, best, -2).argmax())
        if best[at] >= least:
            out.append((int(via[at]), at))
        open_[at] = False
        closer = open_ & (sim[at] > np.where(best >= least, best, -1))
        best[closer], via[closer] = sim[at][closer], at
    return out


def _agree(x: np.ndarray, n: np.ndarray, s: Settings) -> np.ndarray:
    """Equal places of every row with every other; 0 where sizes rule a link out."""
    out = np.zeros((len(x), len(x)), np.int16)
    for p in range(_PLACES):
        out += x[:, p, None] == x[None, :, p]
    out[100 * np.minimum(n[:, None], n[None, :]) < s.percent * np.maximum(n[:, None], n[None, :])] = 0
    return out


_PAIRS = "cell long, a long, b long"


def _proposed_forest(members: DataFrame, s: Settings) -> DataFrame:
    """Round one: pairs of each block's forest, and of blocks of one node with its pivot."""

    def propose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _groups(batches, ["node", "block"]):
            fp, node, n = (frame[c].to_numpy() for c in ("fp", "node", "n"))
            sk = np.frombuffer(b"".join(frame["sketch"]), np.uint8).reshape(-1, _PLACES)
            at = _bounds(frame, ["node", "block"])
            size = np.diff(at)
            two = at[:-1][size == 2]  # most nodes: all of them at once
            fits = 100 * np.minimum(n[two], n[two + 1]) >= s.percent * np.maximum(n[two], n[two + 1])
            ok = two[((sk[two] == sk[two + 1]).sum(1) >= s.floor_agree) & fits]
            rows = [np.stack([node[ok], fp[ok], fp[ok + 1]], 1)]
            for i in np.flatnonzero(size > 2):
                a, b = at[i], at[i + 1]
                pairs = _forest(_agree(sk[a:b], n[a:b], s), s.floor_agree)
                if pairs:
                    p = np.array(pairs) + a
                    rows.append(np.stack([node[p[:, 0]], fp[p[:, 0]], fp[p[:, 1]]], 1))
            got = np.concatenate(rows)
            yield pd.DataFrame({"cell": got[:, 0], "a": got[:, 1:].min(1), "b": got[:, 1:].max(1)})

    flat = members.select("node", "block", "fp", "sketch", "n").repartition("node", "block").sortWithinPartitions("node", "block", "fp")
    pairs = flat.mapInPandas(propose, _PAIRS)
    big = members.filter("blocks > 1")
    pivots = big.groupBy("node").agg(F.min("fp").alias("pivot"))
    star = big.join(pivots, "node").filter("fp <> pivot").select(
        F.xxhash64("node", "block").alias("cell"), F.col("pivot").alias("a"), F.col("fp").alias("b"))
    return pairs.unionByName(star).groupBy("a", "b").agg(F.min("cell").alias("cell"))


def _mixed(members: DataFrame, labels: DataFrame, s: Settings) -> DataFrame:
    """Members of nodes that hold different components, and in how many
    blocks the node confirms its links itself (0: it proposes pairs).

    A block holds ``small`` members and half of ``whole_items`` shingles on average."""
    rows = members.drop("block", "blocks").join(labels, "fp")
    nodes = rows.groupBy("node").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("k"),
                                     F.sum("n").alias("items_")).filter("x <> y")
    blocks = F.ceil(F.greatest(F.col("k") / s.small, 2 * F.col("items_") / s.whole_items)).cast("int")
    blocks = F.when((F.col("k") > s.whole) & (F.col("items_") <= s.whole_items) & (F.col("k") <= s.small), 1).otherwise(blocks)
    rows = rows.join(nodes.select("node", F.when(F.col("k") > s.whole, blocks).otherwise(0).alias("blocks")), "node")
    block = F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("fp", F.lit(3)), F.col("blocks"))).otherwise(0)
    return rows.withColumn("block", block.cast("int"))


def _linked_rest(rows: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """Round two in larger nodes: links between different components, as
    edges to the smallest of those joined in the node.  The blocks of a very
    large one meet each other in cells of bounded sets.  Members that the
    sketches pair with nothing outside their component are left out first."""

    def open_pairs(frame: pd.DataFrame, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of rows a to b, one cell, that may link different components; how many places agree."""
        label, n, block = (frame[c].to_numpy()[a:b] for c in ("label", "n", "block"))
        sk = np.frombuffer(b"".join(frame["sketch"].iloc[a:b]), np.uint8).reshape(-1, _PLACES)
        agree = _agree(sk, n, s)
        near = (agree >= s.floor_agree) & (label[:, None] != label[None, :])
        if frame["i"].iloc[a] != frame["j"].iloc[a]:
            near &= block[:, None] != block[None, :]
        x, y = np.nonzero(np.triu(near, 1))
        return x, y, agree[x, y]

    def some(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _groups(batches, ["node", "i", "j"]):
            at = _bounds(frame, ["node", "i", "j"])
            keep = [np.zeros(0, np.int64)]
            for a, b in zip(at[:-1], at[1:]):
                x, y, _ = open_pairs(frame, a, b)
                keep.append(a + np.unique(np.concatenate([x, y])))
            yield frame.iloc[np.concatenate(keep)]

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _groups(batches, ["node", "i", "j"]):
            fp, label = frame["fp"].to_numpy(), frame["label"].to_numpy()
            items = [np.frombuffer(x, np.uint64) for x in frame["items"]]
            at = _bounds(frame, ["node", "i", "j"])
            out = []
            for a, b in zip(at[:-1], at[1:]):
                root = {x: x for x in label[a:b].tolist()}

                def top(x, root=root):
                    while root[x] != x:
                        root[x] = root[root[x]]
                        x = root[x]
                    return x

                x, y, agree = open_pairs(frame, a, b)
                order = np.argsort(-agree, kind="stable")  # the closest first: most others then need no look
                for i, j in zip((a + x[order]).tolist(), (a + y[order]).tolist()):
                    u, v = top(int(label[i])), top(int(label[j]))
                    if u != v and _close(items[i], items[j], s):
                        root[max(u, v)] = min(u, v)
                        out.append((min(fp[i], fp[j]), max(fp[i], fp[j])))
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    # A block meets itself and the later blocks of its node.
    cells = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select("node", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                         "block", "fp", "label", "n", "sketch")
    dealt = lambda df: df.repartition("node", "i", "j").sortWithinPartitions("node", "i", "j", "fp")
    # Only members with such a pair are sent their sets.
    cells = dealt(cells).mapInPandas(some, "node long, i int, j int, block int, fp long, label long, n long, sketch binary")
    return dealt(cells.join(sets, "fp")).mapInPandas(link, "a long, b long").distinct()


def _proposed_rest(rows: DataFrame, s: Settings) -> DataFrame:
    """Round two in nodes of ``whole`` members at most: the pairs between
    different components that may still link."""

    def propose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _groups(batches, ["node"]):
            fp, label, node, n = (frame[c].to_numpy() for c in ("fp", "label", "node", "n"))
            sk = np.frombuffer(b"".join(frame["sketch"]), np.uint8).reshape(-1, _PLACES)
            at = _bounds(frame, ["node"])
            rows = [np.zeros((0, 3), np.int64)]
            for a, b in zip(at[:-1], at[1:]):
                near = (_agree(sk[a:b], n[a:b], s) >= s.floor_agree) & (label[a:b, None] != label[None, a:b])
                x, y = np.nonzero(np.triu(near, 1))
                if len(x):
                    rows.append(np.stack([node[a + x], fp[a + x], fp[a + y]], 1))
            got = np.concatenate(rows)
            yield pd.DataFrame({"cell": got[:, 0], "a": got[:, 1:].min(1), "b": got[:, 1:].max(1)})

    flat = rows.select("node", "fp", "label", "sketch", "n").repartition("node").sortWithinPartitions("node", "fp")
    return flat.mapInPandas(propose, _PAIRS).groupBy("a", "b").agg(F.min("cell").alias("cell"))


# ------------------------------------------------------------ confirmation

def _close(p: np.ndarray, q: np.ndarray, s: Settings) -> bool:
    """Whether two sorted sets reach the threshold."""
    if len(p) > len(q):
        p, q = q, p
    if 100 * len(p) < s.percent * len(q):
        return False
    place = np.minimum(np.searchsorted(q, p), len(q) - 1)
    both = int((q[place] == p).sum())
    return 100 * both >= s.percent * (len(p) + len(q) - both)


def _confirmed(pairs: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """Links (a, b) among the proposed pairs, by their full sets.

    The pairs of a cell meet the sets of its documents, each shipped to the
    cell once.  Links come back as edges to the smallest of those joined in
    the cell."""
    need = pairs.select("cell", F.explode(F.array("a", "b")).alias("fp")).distinct()
    rows = need.join(sets, "fp").select("cell", F.lit(0).alias("kind"), F.col("fp").alias("a"), F.lit(0).cast("long").alias("b"), "items")
    rows = rows.unionByName(pairs.select("cell", F.lit(1).alias("kind"), "a", "b", F.lit(None).cast("binary").alias("items")))

    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, items, root = None, {}, {}

        def top(x):
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        def joined():
            return [(x, y) for x in root if (y := top(x)) != x]

        for b in batches:
            out = []
            for c, kind, x, y, blob in zip(*(b[k].tolist() for k in ("cell", "kind", "a", "b", "items"))):
                if c != cell:
                    out += joined()
                    cell, items, root = c, {}, {}
                if kind == 0:
                    items[x] = np.frombuffer(blob, np.uint64)
                    continue
                if x not in items or y not in items or top(x) == top(y):
                    continue
                if _close(items[x], items[y], s):
                    u, v = sorted((top(x), top(y)))
                    root[v] = u
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")
        yield pd.DataFrame(joined(), columns=["a", "b"], dtype="int64")

    flat = rows.repartition("cell").sortWithinPartitions("cell", "kind", "a", "b")
    return flat.mapInPandas(confirm, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(fp, label) of every vertex of the edges: the smallest one reachable.

    Every round hooks each label to the smallest neighbouring one, follows
    two steps of these pointers, and contracts the edges, until none is left."""
    edges = stored(edges.select("a", "b").filter("a <> b"), "edges")
    labels = edges.select(F.explode(F.array("a", "b")).alias("fp")).distinct().withColumn("label", F.col("fp"))
    labels, left = stored(labels, "labels"), edges
    while not left.isEmpty():
        both = left.select("a", "b").unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        hook = stored(hook, "hooks")
        for _ in range(2):
            nxt = hook.select(F.col("a").alias("m"), F.col("m").alias("mm"))
            hook = hook.join(nxt, "m").select("a", F.col("mm").alias("m"))
        hook = stored(hook, "hooks")
        labels = stored(labels.join(hook.withColumnRenamed("a", "label"), "label", "left").select(
            "fp", F.coalesce("m", "label").alias("label")), "labels")
        x = left.join(hook.select("a", F.col("m").alias("x")), "a")
        y = x.join(hook.select(F.col("a").alias("b"), F.col("m").alias("y")), "b")
        left = stored(y.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    return labels


def _few(keys: DataFrame) -> DataFrame:
    """A stored table of two or three numbers a row, broadcast if its rows are
    few, so that the documents need not be moved to meet it."""
    return F.broadcast(keys) if keys.count() <= _FEW else keys


def _labelled(docs: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """(doc_id, h, n, fp) of each row, and (fp, label, component_id) of each
    shingle set: the sets of one label are linked."""
    rows = stored(features(docs, s), "features")
    # One class a shingle set, told by its digest; some row of it stands for its text.
    some = rows.filter("n > 0")
    stands = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "h")).alias("row")
    classes = some.groupBy("fp").agg(stands, F.first("n").alias("n"), F.first("roots").alias("roots"), F.first("sketch").alias("sketch"))
    classes = stored(classes.select("fp", F.col("row.doc_id").alias("doc_id"), F.col("row.h").alias("h"), "n", "roots", "sketch"), "classes")
    members = stored(_members(classes, s), "members")
    pairs = stored(_proposed_forest(members, s), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct()
    wanted = stored(wanted.join(classes.select("fp", "doc_id", "h"), "fp"), "wanted")
    sets = stored(_sets(docs, wanted, s), "sets")
    links = _confirmed(pairs, sets, s)
    labels = components(links)
    # Everything with a candidate pair has a label, its own if nothing was confirmed.
    every = wanted.select("fp").join(labels, "fp", "left").select("fp", F.coalesce("label", "fp").alias("label"))
    every = stored(every, "labels")
    mixed = stored(_mixed(members, every, s), "mixed")
    rest = _confirmed(_proposed_rest(mixed.filter("blocks = 0"), s), sets, s)
    rest = stored(rest.unionByName(_linked_rest(mixed.filter("blocks > 0"), sets, s)), "links")
    if not rest.isEmpty():
        la, lb = every.select(F.col("fp").alias("a"), F.col("label").alias("x")), every.select(F.col("fp").alias("b"), F.col("label").alias("y"))
        again = components(rest.join(la, "a").join(lb, "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        every = every.join(again.select(F.col("fp").alias("label"), F.col("label").alias("last")), "label", "left").select(
            "fp", F.coalesce("last", "label").alias("label"))
    named = classes.select("fp", "doc_id").join(every, "fp", "left").select("fp", "doc_id", F.coalesce("label", "fp").alias("label"))
    smallest = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))  # null where no row has an id
    return rows.select("doc_id", "h", "n", "fp"), named.join(smallest, "label").select("fp", "label", "component_id")


def duplicates(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row.

    ``component_id`` is the smallest id reachable by links.  A text without
    words is linked with nothing.  A row without id links like any other, but
    does not name its component and is not kept; a component without any id
    has none.  Rows that repeat an id are linked by their own texts; repeated
    rows are each returned; an empty table gives an empty result."""
    rows, named = _labelled(docs, s)
    out = rows.join(named.drop("label"), "fp", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def _sets(docs: DataFrame, wanted: DataFrame, s: Settings) -> DataFrame:
    """(fp, items): the full set of each wanted class, from the text of the row that stands for it."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"fp": b["fp"].to_numpy(), "items": [u.tobytes() for u in shingle_sets(b["text"].tolist(), s.width)]})

    wanted = wanted.withColumnsRenamed({"doc_id": "_id", "h": "_h"})
    keyed = _keyed(docs).select("doc_id", "h", "text")
    texts = keyed.join(_few(wanted), (keyed["h"] == wanted["_h"]) & keyed["doc_id"].eqNullSafe(wanted["_id"]))
    sets = texts.select("fp", "text").mapInPandas(of, "fp long, items binary")
    return sets.dropDuplicates(["fp"])


def deduplicate(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One document of each group, the one with the smallest id, as it was.

    Of texts under that id the one with the smaller hash stays, of repeated
    rows one.  Rows without id stay; texts without words are no copies of one
    another, so of these only repeated ids go.  An empty table gives an empty
    result."""
    rows, named = _labelled(docs, s)
    rows = rows.filter("doc_id IS NOT NULL").join(named.select("fp", "label"), "fp", "left")
    group = F.struct(F.col("label").isNull().alias("alone"), F.coalesce("label", "doc_id").alias("of"))
    rows = stored(rows.select(group.alias("g"), "doc_id", "h"), "groups")
    best = rows.groupBy("g").agg(F.min(F.struct("doc_id", "h")).alias("row"))
    # What goes is told by id and text; most documents are in neither of these tables.
    gone = rows.join(best, "g").filter((F.col("doc_id") != F.col("row.doc_id")) | (F.col("h") != F.col("row.h")))
    gone = stored(gone.select(F.col("doc_id").alias("_llm_id"), F.col("h").alias("_llm_h")).distinct(), "gone")
    again = rows.groupBy(F.col("doc_id").alias("_llm_id"), F.col("h").alias("_llm_h")).agg(F.count(F.lit(1)).alias("k"))
    again = stored(again.filter("k > 1").drop("k"), "again")
    keyed = docs.withColumns({"_llm_d": F.col("doc_id").cast("long"), "_llm_t": F.xxhash64("text")})
    same = lambda t: (keyed["_llm_d"] == t["_llm_id"]) & (keyed["_llm_t"] == t["_llm_h"])
    keyed = keyed.join(_few(gone), same(gone), "left_anti")
    if not again.isEmpty():
        once = keyed.join(_few(again), same(again), "left_semi").dropDuplicates(["_llm_d", "_llm_t"])
        keyed = keyed.join(_few(again), same(again), "left_anti").unionByName(once)
    return keyed.select(*docs.columns)
