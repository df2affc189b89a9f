"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target in words: a share of ``total`` times all words by
its weight, at most ``cap`` times its own words; what is cut off is shared
again by weight.  A document is then expected ``e`` times, ``e`` being its
source's target over its size (times the document's own weight, if given).
Whole copies, floor(e), are certain.  For the rest, documents are ranked by
random odds over inclusion odds, (u / (1 - u)) / (p / (1 - p)) with
p = e - floor(e), and taken in that order if they fit the words that the
source still lacks; what does not fit is passed over, until nothing is left
that fits.

Nothing sorts a source in one task: the rank is cut into fine cells whose
word counts are added first, and only the cell that holds a cut is read
row by row.  ``u`` is a hash of id and text, so reruns agree, and repeated
rows are drawn alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakefold.llm.common import WORD, stored

CELLS = 1 << 16
FEW_SOURCES = 50_000  # rows of a table of sources that is broadcast at most


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(id_col: str = "doc_id", text_col: str = "text", seed: str = "") -> Column:
    """A number in (0, 1) from a digest of id and text."""
    whole = F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text_col), F.lit("")))
    return (F.conv(F.substring(F.md5(whole.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, weights: list[float], total: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, target) of each source, by water-filling.

    Sources in code-point order, null last, take the weights in turn.  The
    input is added up to one row a source first; a null source is one."""
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("weight")).alias("weighed"))
    # One row a source from here on.
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    by = by.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (nth % len(weights) + 1).cast("int")))
    by = by.withColumn("most", cap * F.col("source_size"))
    order = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    everything = Window.partitionBy(F.lit(0))
    level = (total * F.sum("source_size").over(everything) - before) / after  # if all from this row on stay below their most
    by = by.withColumn("level", F.when(level <= F.col("most") / F.col("w"), level))
    # The first row for which that holds gives the level; later rows give the same or less room to the same rows.
    by = by.withColumn("level", F.first("level", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return by.select("source", "source_size", "weighed", F.least("most", F.coalesce(F.col("level") * F.col("w"), F.col("most"))).alias("target"))


def _expected(cap: float) -> Column:
    """Times that a document is expected in the mix."""
    return F.when(F.col("weighed") > 0, F.least(F.col("target") * F.col("weight") / F.col("weighed"), F.lit(cap))).otherwise(0.0)


def _ranked(rows: DataFrame, cap: float) -> DataFrame:
    """With ``whole`` copies, and rank ``z`` in (0, 1) of what is left to draw (null: nothing)."""
    rows = rows.withColumn("e", _expected(cap)).withColumn("whole", F.floor("e")).withColumn("p", F.col("e") - F.col("whole"))
    u, p = F.col("u"), F.col("p")
    # odds / (1 + odds) ranks like the odds
    z = u * (1 - p) / (u * (1 - p) + (1 - u) * p)
    return rows.withColumn("z", F.when((p > 0) & (F.col("size") > 0), z)).withColumn("cell", F.floor(F.col("z") * CELLS))


def sized(docs: DataFrame, weight_col: str | None = None, seed: str = "") -> DataFrame:
    """What the draw needs of each document."""
    weight = F.greatest(F.coalesce(F.col(weight_col).cast("double"), F.lit(0.0)), F.lit(0.0)) if weight_col else F.lit(1.0)
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), draw(seed=seed).alias("u"), weight.alias("weight"))


def _few(df: DataFrame) -> DataFrame:
    """A stored table of one row a source, broadcast if these are few: a hot
    source's documents then stay where they are."""
    return F.broadcast(df) if df.count() <= FEW_SOURCES else df


def _of_source(rows: DataFrame, by: DataFrame) -> DataFrame:
    """``rows`` with the columns of their source's row in ``by``."""
    by = by.withColumnRenamed("source", "_s")
    return rows.join(by, rows["source"].eqNullSafe(F.col("_s"))).drop("_s")


def cuts(sizes: DataFrame, weights: list[float], total: float = 1.5, cap: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """One row a source: target, and the spans of ranks that are taken, each
    with the words up to which a document was taken there; and the ranks that
    several rows share.

    In every round each source takes, from its last place in the order on,
    the documents that fit what it still lacks, up to the first that no longer
    does; the rounds end when no source has a document left that fits.  What
    is taken is the same as by going through the order document by document,
    past those that do not fit.  Rows of one rank are taken together."""
    t = _few(stored(targets(sizes, weights, total, cap), "targets"))
    rows = _ranked(_of_source(sizes, t), cap)
    units = rows.filter("z IS NOT NULL").groupBy("source", "z", "cell").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows"))
    units = stored(units, "units")
    certain = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("whole")).alias("certain"))
    lack = _of_source(t, certain).withColumn("gap", F.col("target") - F.col("certain"))
    state = stored(lack.select("source", "source_size", "weighed", "target", "gap", F.lit(0.0).alias("pos"),
                               F.array().cast("array<struct<lo:double,hi:double,most:double>>").alias("spans")), "cut")
    while True:
        at = _few(state.select("source", "gap", "pos"))
        left = _of_source(units, at).filter("z > pos AND words <= gap")
        cells = left.groupBy("source", "cell").agg(F.sum("words").alias("words"), F.max("z").alias("z"), F.max("gap").alias("gap"))
        run = F.sum("words").over(Window.partitionBy("source").orderBy("cell"))  # at most CELLS rows a source
        cells = stored(cells.withColumn("upto", run), "cells")
        fits = F.col("upto") <= F.col("gap")
        fit = cells.groupBy("source").agg(
            F.min(F.when(~fits, F.col("cell"))).alias("cut_cell"), F.coalesce(F.max(F.when(fits, F.col("upto"))), F.lit(0)).alias("below"),
            F.max(F.when(fits, F.col("z"))).alias("z_below"))
        fit = stored(fit, "cut")
        if fit.isEmpty():
            break
        # Inside the cell that holds the cut.
        inside = _of_source(left, _few(fit)).filter(F.col("cell") == F.col("cut_cell"))
        upto = F.col("below") + F.sum("words").over(Window.partitionBy("source").orderBy("z"))
        inside = inside.withColumn("upto", upto).filter("upto <= gap").groupBy("source").agg(F.max("z").alias("z_cut"), F.max("upto").alias("upto"))
        fit = fit.join(inside.withColumnRenamed("source", "_s"), fit["source"].eqNullSafe(F.col("_s")), "left").drop("_s")
        got = fit.select(F.col("source").alias("_s"), F.coalesce("z_cut", "z_below").alias("hi"), F.coalesce("upto", "below").alias("got"))
        more = state.join(got, state["source"].eqNullSafe(F.col("_s")), "left")
        span = F.array(F.struct(F.col("pos").alias("lo"), "hi", F.col("gap").alias("most")))
        state = stored(more.select(
            "source", "source_size", "weighed", "target", (F.col("gap") - F.coalesce("got", F.lit(0))).alias("gap"),
            F.coalesce("hi", "pos").alias("pos"), F.when(F.col("hi").isNotNull(), F.concat("spans", span)).otherwise(F.col("spans")).alias("spans")), "cut")
    return state.drop("gap", "pos"), units.filter("rows > 1").select("source", "z", F.col("words").alias("together"))


def copies(sizes: DataFrame, cut: tuple[DataFrame, DataFrame], cap: float = 2.0) -> DataFrame:
    """``sizes`` (with any further columns) and how many ``copies`` the mix takes of each row."""
    by, together = cut
    rows = _ranked(_of_source(sizes, _few(by)), cap)
    words = F.col("size")
    if not together.isEmpty():
        again = _few(stored(together.withColumnsRenamed({"source": "_s", "z": "_z"}), "together"))
        rows = rows.join(again, rows["source"].eqNullSafe(F.col("_s")) & (rows["z"] == F.col("_z")), "left").drop("_s", "_z")
        words = F.coalesce("together", "size")
    rows = rows.withColumn("_words", words)
    taken = F.exists("spans", lambda x: (F.col("z") > x["lo"]) & (F.col("z") <= x["hi"]) & (F.col("_words") <= x["most"]))
    return rows.withColumn("copies", (F.col("whole") + F.coalesce(taken, F.lit(False)).cast("long")).cast("long"))


def report(docs: DataFrame, weights: list[float], total: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken.

    Null and empty texts have size 0 and so 0 words taken; a null source is a
    source of its own; an empty table gives an empty result."""
    sizes = stored(sized(docs), "sizes")
    out = copies(sizes, cuts(sizes, weights, total, cap), cap)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, weights: list[float], total: float = 1.5, cap: float = 2.0) -> DataFrame:
    """The mixed corpus: every taken document once for each copy, with its
    number in ``copy`` (of an input that has such a column, in ``copy_1``, or
    the next name that is free).  Other columns stay as they are.

    Null and empty texts have no words and are not taken; a null source is a
    source; an empty table gives an empty result."""
    taken, name = {c.lower() for c in docs.columns}, "copy"
    while name in taken:
        name = f"copy_{int(name[5:] or 0) + 1}"
    mine = docs.withColumn("_llm_row", F.struct(*docs.columns))
    sizes = mine.select("_llm_row", "source", word_count(F.col("text")).alias("size"), draw().alias("u"), F.lit(1.0).alias("weight"))
    got = copies(sizes, cuts(stored(sized(docs), "sizes"), weights, total, cap), cap).filter("copies > 0")
    out = got.select("_llm_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias(name))
    return out.select(*(F.col("_llm_row").getField(c).alias(c) for c in docs.columns), name)
