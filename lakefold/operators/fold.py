"""Multi-page fold: the result of N sequential merges, computed in one job
(W1-W5), and skew-safe as-of lookup.

Rows carry a page (or batch) number.  Skew: every step first reduces a key
to at most one row per page with a partial aggregate, and change events (W2,
W3) are found inside (key, range of pages), with the last version carried
from range to range, so neither a key's rows nor its pages meet in one task.  Interval
windows (W5, as-of) are split into time buckets: a window runs inside a
(key, bucket) and the carry-over between buckets comes from a per-bucket
aggregate, so no single key lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakefold.functions.hashing import ident
from lakefold.operators.merge import dedup_latest
from lakefold.schemas import CONTENT_HASH


def last_per_page(df: DataFrame, keys: Sequence[str], page_col: str, pos_col: str | None = None) -> DataFrame:
    """One row per (key, page): the last one inside the page (W4 per page)."""
    order = [pos_col] if pos_col else []
    return dedup_latest(df, list(keys) + [page_col], order)


def latest_per_key(df: DataFrame, keys: Sequence[str], page_col: str, pos_col: str | None = None) -> DataFrame:
    """Final version of each key = its row in the last page it occurs in."""
    return dedup_latest(df, keys, [page_col] + ([pos_col] if pos_col else []))


def floor_div(col: str, n: int) -> Column:
    """Integer division that rounds down for negative numbers too."""
    return F.expr(f"(CAST({ident(col)} AS BIGINT) - pmod(CAST({ident(col)} AS BIGINT), {int(n)}L)) div {int(n)}L")


def _ranged(rows: DataFrame, page_col: str, size: int) -> tuple[DataFrame, int]:
    """With the number ``_r`` of the range of ``size`` neighbouring pages that
    a row's page lies in, and the greatest number (0: one range).  Pages that
    are no whole numbers are numbered in their order first."""
    if not isinstance(rows.schema[page_col].dataType, T.IntegralType):
        from lakefold.operators.select import global_row_number

        pages = global_row_number(rows.select(page_col).distinct(), [page_col]).withColumnsRenamed({page_col: "_page", "_row": "_no"})
        rows = rows.join(pages, rows[page_col].eqNullSafe(F.col("_page"))).drop("_page")
    else:
        rows = rows.withColumn("_no", F.col(page_col).cast("long"))
    ends = rows.agg(F.min("_no").alias("low"), F.max("_no").alias("high")).first()
    low, high = ends.low or 0, ends.high or 0
    number = F.expr(f"(_no - ({low}L)) div {int(size)}L")  # pages without number come first, as in any order
    return rows.withColumn("_r", F.coalesce(number, F.lit(0).cast("long"))).drop("_no"), (high - low) // size


def _carried(last: DataFrame, keys: Sequence[str], greatest: int, fan: int = 256) -> DataFrame:
    """(keys, _r, _prev): what the nearest earlier range of the key left.

    ``last`` has one row a key and range (``_r`` from 0 to ``greatest``) with
    what the range leaves (``_last``, never null).  Ranges are combined
    ``fan`` at a time, level by level, so no window holds more than these."""
    k = list(map(ident, keys))
    rows = last.withColumn("_up", F.expr(f"_r div {int(fan)}L"))
    inside = F.lag("_last").over(Window.partitionBy(*k, "_up").orderBy("_r"))
    rows = rows.withColumn("_prev", inside)
    if greatest < fan:
        return rows.select(*k, "_r", "_prev")
    above = last.groupBy(*k, F.expr(f"_r div {int(fan)}L").alias("_up")).agg(F.max_by("_last", "_r").alias("_last"))
    above = _carried(above.withColumnRenamed("_up", "_r"), keys, greatest // fan, fan)
    above = above.select(*k, F.col("_r").alias("_up"), F.col("_prev").alias("_above"))
    rows = join_null_safe(rows, above, [*keys, "_up"])
    return rows.select(*k, "_r", F.coalesce("_prev", "_above").alias("_prev"))


def change_events(df: DataFrame, keys: Sequence[str], page_col: str, hash_col: str = CONTENT_HASH,
                  pos_col: str | None = None, pages: int = 1024) -> DataFrame:
    """The rows a page-by-page merge would write: a key's row in a page is
    written if its hash differs from the previous page's version (A->B->A is
    two changes).  Adds ``_change`` = insert / update.

    Versions are compared inside a (key, range of ``pages`` pages); every
    range of a key is summed up by the hash it leaves, and these are carried
    from range to range, so a key in very many pages is dealt over many tasks."""
    per_page = last_per_page(df, keys, page_col, pos_col)
    per_page, greatest = _ranged(per_page, page_col, pages)
    k = list(map(ident, keys))
    w = Window.partitionBy(*k, "_r").orderBy(F.col(page_col))
    version = F.struct(F.col(hash_col).alias("h"))  # never null itself: a null hash is a version
    prev = F.lag(version).over(w)
    if greatest:
        last = per_page.groupBy(*k, "_r").agg(F.max_by(version, F.struct(F.col(page_col))).alias("_last"))
        # What a range starts from is a row before its first page: no join of the rows themselves.
        start = _carried(last, keys, greatest).filter("_prev IS NOT NULL").withColumn("_own", F.lit(False))
        rows = per_page.withColumn("_own", F.lit(True)).unionByName(start, allowMissingColumns=True)
        w = Window.partitionBy(*k, "_r").orderBy("_own", F.col(page_col))
        prev = F.coalesce(F.lag("_prev").over(w), F.lag(F.when(F.col("_own"), version)).over(w))
        tagged = rows.withColumn("_was", prev).filter("_own").drop("_own", "_prev")
    else:
        tagged = per_page.withColumn("_was", prev)
    changed = tagged.filter(F.col("_was").isNull() | ~F.col(hash_col).eqNullSafe(F.col("_was.h")))
    return changed.withColumn("_change", F.when(F.col("_was").isNull(), F.lit("insert")).otherwise(F.lit("update"))).drop("_was", "_r")


def fold_state(df: DataFrame, keys: Sequence[str], page_col: str, ts_col: str, hash_col: str = CONTENT_HASH,
               pos_col: str | None = None) -> DataFrame:
    """W1 + W3: final row per key with ``last_changed`` = the time of the last
    change event (what an update-on-change merge leaves as ingestion time)."""
    events = change_events(df, keys, page_col, hash_col, pos_col)
    last = events.groupBy(*map(ident, keys)).agg(F.max(F.col(ts_col)).alias("last_changed"))
    return latest_per_key(df, keys, page_col, pos_col).join(last, list(keys), "left")


_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def time_bucket(ts_col: str, bucket: str) -> Column:
    """Number of the time bucket ("1 day", "12 hours", ...) that a time lies
    in; null for a null time (``F.window`` would drop the row)."""
    n, unit = bucket.split()
    seconds, size = f"unix_seconds(CAST({ident(ts_col)} AS TIMESTAMP))", int(n) * _SECONDS[unit.rstrip("s")]
    return F.expr(f"({seconds} - pmod({seconds}, {size}L)) div {size}L")


def join_null_safe(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "left") -> DataFrame:
    """Join on ``cols`` in which null equals null; ``left``'s columns are kept."""
    r = right.withColumnsRenamed({c: f"_r_{c}" for c in cols})
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[ident(c)].eqNullSafe(r[ident(f"_r_{c}")])
    return left.join(r, cond, how).drop(*(f"_r_{c}" for c in cols))


def valid_intervals(df: DataFrame, entity: Sequence[str], ts_col: str, bucket: str = "30 days",
                    tie: Sequence[str] = ()) -> DataFrame:
    """Change history as validity intervals: ``valid_from`` = this
    version's time, ``valid_to`` = the next version's time of the same entity.
    A row without a time keeps both empty.

    Two levels: ``lead`` inside (entity, time bucket); the last row of a
    bucket takes the first time of the entity's next non-empty bucket, found
    with a window over per-bucket minima (one row per bucket)."""
    rows = df.withColumn("_bucket", time_bucket(ts_col, bucket))
    w_in = Window.partitionBy(*map(ident, entity), "_bucket").orderBy(F.col(ts_col), *[F.col(ident(t)) for t in tie])
    rows = rows.withColumn("_next_in", F.lead(F.col(ts_col)).over(w_in))
    timed = rows.filter(F.col("_bucket").isNotNull())
    firsts = timed.groupBy(*map(ident, entity), "_bucket").agg(F.min(F.col(ts_col)).alias("_first"))
    w_b = Window.partitionBy(*map(ident, entity)).orderBy("_bucket")
    nxt = firsts.select(*map(ident, entity), "_bucket", F.lead("_first").over(w_b).alias("_next_bucket_first"))
    out = join_null_safe(rows, nxt, list(entity) + ["_bucket"])
    return out.select(
        "*", F.col(ts_col).alias("valid_from"), F.coalesce("_next_in", "_next_bucket_first").alias("valid_to")
    ).drop("_bucket", "_next_in", "_next_bucket_first")


def asof_last(left: DataFrame, right: DataFrame, by: Sequence[str], ts_col: str, value_col: str,
              bucket: str = "1 day", strict: bool = True) -> DataFrame:
    """As-of lookup: for each left row, ``value_col`` of the latest right row
    of the same ``by`` key at or before (``strict``: before) its time; of
    right rows at one time the one with the greatest value.

    A null value of the latest right row is the answer, not a gap to look
    behind.  Left rows without time or key find nothing and are kept.

    Union both sides, carry the last right row forward inside each (key,
    bucket), and fill rows that have no earlier right row in their bucket
    from the previous buckets' last one (a window over one row per bucket)."""
    found = F.struct(F.col(value_col).alias("v"))  # never null itself, so that null values count
    kind = right.select(found.alias("x")).schema["x"].dataType
    L = left.select("*", F.lit(0).alias("_side"), F.lit(None).cast(kind).alias("_rv"))
    timed = right.filter(F.col(ts_col).isNotNull())
    R = timed.select(*map(ident, by), F.col(ts_col), F.lit(1).alias("_side"), found.alias("_rv"))
    # Right rows sort before left rows at equal time only when not strict.
    tie = F.when(F.col("_side") == 1, F.lit(0 if not strict else 1)).otherwise(F.lit(1 if not strict else 0))
    u = L.unionByName(R, allowMissingColumns=True).withColumn("_bucket", time_bucket(ts_col, bucket))
    w = Window.partitionBy(*map(ident, by), "_bucket").orderBy(F.col(ts_col), tie, "_rv").rowsBetween(Window.unboundedPreceding, 0)
    u = u.withColumn("_carry", F.last("_rv", ignorenulls=True).over(w))
    per_bucket = (
        R.withColumn("_bucket", time_bucket(ts_col, bucket))
        .groupBy(*map(ident, by), "_bucket")
        .agg(F.max_by("_rv", F.struct(F.col(ts_col), F.col("_rv"))).alias("_blast"))
    )
    # Carry between buckets: one marker row per left bucket and one row per
    # right bucket, ordered by bucket (markers first); the last right value
    # seen before a marker is the carry.  Rows per key = number of buckets.
    lefts = u.filter(F.col("_side") == 0)
    markers = lefts.select(*map(ident, by), "_bucket").distinct().select("*", F.lit(0).alias("_k"), F.lit(None).cast(kind).alias("_blast"))
    chain = markers.unionByName(per_bucket.withColumn("_k", F.lit(1)))
    wb = Window.partitionBy(*map(ident, by)).orderBy("_bucket", "_k").rowsBetween(Window.unboundedPreceding, 0)
    latest = (
        chain.withColumn("_from_prev", F.last("_blast", ignorenulls=True).over(wb))
        .filter(F.col("_k") == 0)
        .select(*map(ident, by), "_bucket", "_from_prev")
    )
    out = lefts.join(latest, list(by) + ["_bucket"], "left")
    keyed = F.col(ts_col).isNotNull()
    for c in by:
        keyed = keyed & F.col(ident(c)).isNotNull()
    value = F.when(keyed, F.coalesce("_carry", "_from_prev")["v"])
    return out.withColumn(f"asof_{value_col}", value).drop("_side", "_rv", "_bucket", "_carry", "_from_prev")
