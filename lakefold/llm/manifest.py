"""A Merkle manifest of a dataset, by lag and lead windows.

Every row is a leaf: the digest of its fields.  Leaves of a source stand in
the order of their ids; 16 neighbours make a run, and a run's digests hash to
its parent, level by level, until one node is left, the source's subroot.
The subroots, in the order of their sources, make the root the same way.

A level is one window over (source, run): ``lag`` and ``lead`` by the fixed
offsets 1 to 15, masked by the slot in the run and by the run's length, give
each node its siblings; the first child's row hashes the parent.  Places are
numbered by sorted ranges and the counts before them, so no source, however
large, is sorted in one task; a window never holds more than 16 rows.

The siblings of all levels above a run (its *path*) are built from the top
down, one row a run, and meet the leaves where their own window has already
put them.  All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakefold.llm.common import LOWER, UPPER, crc_of_id, stored

RUN = 16  # fixed value: children of a node
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")  # fixed value: what a leaf hashes, in this order
BROADCAST_ROWS = 50_000  # offsets above this many rows are joined by key instead


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the strings put together."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The digest of a row, with some of its fields changed."""
    return digest(*(field(changed.get(c, F.col(c))) for c in FIELDS))


def leaves(docs: DataFrame, tampered: Column | None = None, change: dict[str, Column] | None = None) -> DataFrame:
    """(g, doc_id, h, other): ``g`` stands for the source (sorts null first,
    then by UTF-8 bytes), ``h`` is the leaf, ``other`` the leaf of the changed
    row where ``tampered`` holds."""
    other = F.when(tampered, leaf(**(change or {}))) if tampered is not None else F.lit(None).cast("string")
    return docs.select(F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("g"),
                       F.col("doc_id").cast("long").alias("doc_id"), leaf().alias("h"), other.alias("other"))


def _numbered(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """With place ``pos`` (from 0) and size ``n`` of the group ``g``, and the
    largest group's size.  Rows that tie are alike, so any order of them will do."""
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())
    by = [F.col("g"), *(F.col(c).asc_nulls_first() for c in order), F.col("_tie")]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("_tie")
    ranged = stored(ranged.withColumn("_at", F.monotonically_increasing_id()), "places")
    # Task number above, row number below: one row for each group in each task, so tasks + groups at most.
    part = F.shiftrightunsigned("_at", 33).alias("_part")
    spans = ranged.groupBy(part, "g").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    mine = Window.partitionBy("g")
    before = F.sum("_rows").over(mine.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumns({"n": F.sum("_rows").over(mine), "_before": F.coalesce(before, F.lit(0))}).drop("_rows")
    spans = stored(spans, "spans")
    known = spans.agg(F.count(F.lit(1)).alias("rows"), F.max("n").alias("most")).first()
    if known.rows <= BROADCAST_ROWS:
        spans = F.broadcast(spans)
    out = ranged.withColumn("_part", part).join(spans, ["_part", "g"])
    out = out.withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before"))
    return out.drop("_part", "_at", "_first", "_before"), known.most or 0


def _beside(nodes: DataFrame) -> DataFrame:
    """With ``run``, ``slot`` and the digests ``left`` and ``right`` of the
    node in its run (empty where the group has one node only)."""
    run = F.expr(f"pos div {RUN}")
    nodes = nodes.withColumns({"run": run, "slot": F.col("pos") % RUN, "length": F.least(F.lit(RUN), F.col("n") - run * RUN)})
    w = Window.partitionBy("g", "run").orderBy("pos")
    left = [F.when(F.col("slot") >= k, F.lag("h", k).over(w)) for k in range(RUN - 1, 0, -1)]
    right = [F.when(F.col("slot") + k < F.col("length"), F.lead("h", k).over(w)) for k in range(1, RUN)]
    return nodes.withColumns({"left": F.concat_ws("", *left), "right": F.concat_ws("", *right)}).drop("length")


def _levels(nodes: DataFrame, most: int) -> list[DataFrame]:
    """The levels above ``nodes`` (g, pos, n, h), each stored with its siblings."""
    levels, below = [], _beside(nodes)
    while most > 1:
        first = below.filter((F.col("n") > 1) & (F.col("pos") % RUN == 0))
        above = first.select("g", F.expr(f"pos div {RUN}").alias("pos"), F.expr(f"(n + {RUN - 1}) div {RUN}").alias("n"),
                             digest(F.col("h"), F.col("right")).alias("h"))
        below = stored(_beside(above).select("g", "pos", "n", "h", "left", "right"), "level")
        levels.append(below)
        most = -(-most // RUN)
    return levels


def _step() -> Column:
    return F.array(F.struct("left", "right"))


def _paths(levels: list[DataFrame], roof: DataFrame) -> DataFrame | None:
    """(g, run, path, subroot) of each node of the lowest level: the siblings
    of it and of all its ancestors.  ``roof`` has that of the groups' last nodes."""
    above = None
    for nodes in reversed(levels):
        nodes = nodes.withColumn("up", F.expr(f"pos div {RUN}"))
        here = nodes.filter("n = 1").join(roof, "g").select("g", F.col("pos").alias("run"), "path", "subroot")
        if above is not None:
            many = nodes.filter("n > 1").join(above.withColumnRenamed("run", "up"), ["g", "up"])
            here = here.unionByName(many.select("g", F.col("pos").alias("run"), F.concat(_step(), "path").alias("path"), "subroot"))
        above = stored(here, "paths")
    return above


def manifest(docs: DataFrame, tampered: Column | None = None, change: dict[str, Column] | None = None) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``folded_root`` is recomputed from the row's leaf (the changed row's, where
    ``tampered`` holds) and the siblings; ``verified`` says whether it is the
    root.  Nulls in any field are part of the leaf; a null source is a source,
    a null id comes first; an empty text differs from a null one; repeated
    rows are leaves each; rows of one id stand by their leaf; an empty table
    gives an empty result."""
    spark = docs.sparkSession
    rows, most = _numbered(leaves(docs, tampered, change), ["doc_id", "h", "other"])
    levels = _levels(rows.select("g", "pos", "n", "h"), most)
    tops = rows.filter("n = 1").select("g", "h")
    for nodes in levels:
        tops = tops.unionByName(nodes.filter("n = 1").select("g", "h"))
    # The sources' own tree: one group of all subroots.
    subroots = stored(tops.select(F.lit("").alias("g"), F.col("g").alias("of"), "h"), "subroots")
    subs, sources = _numbered(subroots, ["of"])
    subs = stored(_beside(subs), "subroots")
    upper = _levels(subs.select("g", "pos", "n", "h"), sources)
    top = (upper[-1] if upper else subs).agg(F.max("h").alias("root")).first().root
    none = "array<struct<left:string,right:string>>"
    start = spark.range(1).select(F.lit("").alias("g"), F.array().cast(none).alias("path"), F.lit(top).alias("subroot"))
    path = _paths(upper, start)
    if path is None:  # one source
        roof = subs.select(F.col("of").alias("g"), F.array().cast(none).alias("path"), F.col("h").alias("subroot"))
    else:
        roof = subs.join(path.select("run", "path"), "run").select(
            F.col("of").alias("g"), F.concat(_step(), "path").alias("path"), F.col("h").alias("subroot"))
    roof = stored(roof, "roof")
    # What stands above the leaves' runs; a lone leaf is its source's subroot.
    lone = rows.filter("n = 1").select("g").join(roof, "g").select("g", F.lit(0).cast("long").alias("run"), "path", "subroot")
    path = _paths(levels, roof)
    path = lone if path is None else path.unionByName(lone)
    out = _beside(rows).join(path, ["g", "run"])
    first = F.coalesce("other", "h")
    first = F.when(F.col("n") > 1, digest(F.col("left"), first, F.col("right"))).otherwise(first)
    folded = F.aggregate("path", first, lambda acc, x: digest(x["left"], acc, x["right"]))
    siblings = F.array_join(F.transform("path", lambda x: F.concat(x["left"], x["right"])), "")
    out = out.select("doc_id", F.col("h").alias("leaf"), "subroot", F.lit(top).cast("string").alias("root"),
                     digest(F.col("left"), F.col("right"), siblings).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def lowered_fifth(docs: DataFrame) -> DataFrame:
    """The manifest, folded for rows whose text lost its capitals A-Z where 5
    divides crc32 of the decimal id (rows without id are left as they are)."""
    hit = F.col("doc_id").isNotNull() & (crc_of_id("doc_id") % 5 == 0)
    return manifest(docs, F.coalesce(hit, F.lit(False)), {"text": F.translate(F.col("text"), UPPER, LOWER)})
