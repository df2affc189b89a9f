"""Skew-safe analytic windows and sessions (SQL surface C11, C21).

A plain ``Window.partitionBy(key)`` sends every row of a key to one task.
These operators bucket the order column and run the window inside
(key, bucket); what crosses a bucket edge is carried explicitly:

* running totals: within-bucket running sum + the sum of all earlier
  buckets (a window over one row per bucket);
* moving frames / lag / lead over an integer order (e.g. a turn number): the
  rows a frame needs from the neighbouring bucket are copied into it as
  context rows and dropped after the window; ``series`` finds all of these
  with one partitioning of the rows and one row a bucket beside it;
* sessions: gaps inside a bucket, and one row a bucket for the session that
  an earlier bucket leaves open;
* ranks: rows are sorted by ranges of (key, order), and every range adds what
  the ranges before it hold of the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakefold.functions.hashing import ident
from lakefold.operators.fold import floor_div, join_null_safe, time_bucket
from lakefold.session import scratch_table


def running_sum(df: DataFrame, key: Sequence[str], order: str, value: str, bucket_size: int, out: str = "running_sum") -> DataFrame:
    """Exact ``sum(value) over (partition by key order by order rows
    unbounded preceding)`` for an integer ``order`` (ties broken by order)."""
    keys = list(map(ident, key))
    rows = df.withColumn("_b", floor_div(order, bucket_size))
    w_in = Window.partitionBy(*keys, "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_in", F.sum(value).over(w_in))
    tot = rows.groupBy(*keys, "_b").agg(F.sum(value).alias("_t"))
    w_b = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(*keys, "_b", F.sum("_t").over(w_b).alias("_before"))
    # As in SQL, the sum is null only as long as every value so far is.
    total = F.when(F.coalesce("_in", "_before").isNotNull(), F.coalesce("_in", F.lit(0)) + F.coalesce("_before", F.lit(0)))
    return join_null_safe(rows, tot, list(key) + ["_b"]).withColumn(out, total).drop("_b", "_in", "_before")


def _neighbours(df: DataFrame, key: Sequence[str], order: str, value: str, home) -> DataFrame:
    """With ``lag_value`` and ``lead_value``: inside the bucket, and at its
    edges from the nearest bucket that has rows (a window over one row per
    bucket).  The values travel in structs, so that null values count."""
    keys = list(map(ident, key))
    rows = df.withColumn("_b", home).withColumn("_x", F.struct(F.col(value).alias("v")))
    w = Window.partitionBy(*keys, "_b").orderBy(F.col(order))
    rows = rows.withColumns({"_p": F.lag("_x").over(w), "_n": F.lead("_x").over(w)})
    edge = rows.groupBy(*keys, "_b").agg(F.min_by("_x", order).alias("_f"), F.max_by("_x", order).alias("_l"))
    wb = Window.partitionBy(*keys).orderBy("_b")
    edge = edge.select(*keys, "_b", F.lag("_l").over(wb).alias("_pb"), F.lead("_f").over(wb).alias("_nb"))
    out = join_null_safe(rows, edge, list(key) + ["_b"])
    return out.select(*map(ident, df.columns), F.coalesce("_p", "_pb")["v"].alias("lag_value"), F.coalesce("_n", "_nb")["v"].alias("lead_value"))


def dense_frame(df: DataFrame, key: Sequence[str], order: str, value: str, preceding: int, following: int,
                bucket_size: int) -> DataFrame:
    """Moving average over ``order`` in [order - preceding, order + following]
    plus lag / lead (the previous and next row's value, also across gaps), for
    an integer order that is unique in a key.

    Rows within ``preceding`` of the next bucket (or ``following`` of the
    previous one) are copied there as context, so each (key, bucket) window
    sees every row its frames need."""
    if preceding >= bucket_size or following >= bucket_size:
        raise ValueError("bucket_size must exceed the frame width")
    keys = list(map(ident, key))
    home = floor_div(order, bucket_size)
    pos = F.col(order) - home * bucket_size
    df = _neighbours(df, key, order, value, home)
    copies = F.array(
        F.struct(home.alias("_b"), F.lit(False).alias("_ctx")),
        F.when(pos >= bucket_size - max(preceding, 1), F.struct((home + 1).alias("_b"), F.lit(True).alias("_ctx"))),
        F.when(pos < max(following, 1), F.struct((home - 1).alias("_b"), F.lit(True).alias("_ctx"))),
    )
    rows = df.select("*", F.explode(F.array_compact(copies)).alias("_c")).select("*", "_c._b", "_c._ctx").drop("_c")
    w = Window.partitionBy(*keys, "_b").orderBy(F.col(order))
    frame = w.rangeBetween(-preceding, following)
    out = rows.select(
        "*",
        F.avg(value).over(frame).alias("moving_avg"),
    ).filter(~F.col("_ctx"))
    return out.drop("_b", "_ctx")


def series(df: DataFrame, key: Sequence[str], order: str, value: str, preceding: int, following: int, bucket_size: int) -> DataFrame:
    """Running sum, moving average, lag, lead, first and last value of a key's
    rows by an integer ``order`` that is unique in it, as ``running_sum``,
    ``dense_frame`` and ``first_last`` give them.

    The rows are partitioned once, by (key, bucket), each bucket with the rows
    its frames need from its neighbours; one row a bucket (sum, first and last
    value) brings what comes from further away."""
    if preceding >= bucket_size or following >= bucket_size:
        raise ValueError("bucket_size must exceed the frame width")
    keys = ["_key"]  # in a struct null keys are equal, so one partitioning serves windows and the join
    home = floor_div(order, bucket_size)
    rows = df.withColumns({"_key": F.struct(*map(ident, key)), "_b": home, "_x": F.struct(F.col(value).alias("v"))})
    # One row a bucket; a key has as many as its orders span.
    edge = rows.groupBy(*keys, "_b").agg(F.sum(value).alias("_t"), F.min_by("_x", order).alias("_f"), F.max_by("_x", order).alias("_l"))
    wb = Window.partitionBy(*keys).orderBy("_b")
    all_ = wb.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edge = edge.select(*keys, "_b", F.sum("_t").over(wb.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
                       F.lag("_l").over(wb).alias("_pb"), F.lead("_f").over(wb).alias("_nb"),
                       F.first("_f").over(all_).alias("_first"), F.last("_l").over(all_).alias("_last"))
    pos = F.col(order) - F.col("_b") * bucket_size
    copies = F.array(
        F.struct(F.col("_b"), F.lit(True).alias("_own")),
        F.when(pos >= bucket_size - max(preceding, 1), F.struct((F.col("_b") + 1).alias("_b"), F.lit(False).alias("_own"))),
        F.when(pos < max(following, 1), F.struct((F.col("_b") - 1).alias("_b"), F.lit(False).alias("_own"))),
    )
    rows = rows.withColumn("_c", F.explode(F.array_compact(copies))).withColumns({"_b": F.col("_c._b"), "_own": F.col("_c._own")}).drop("_c")
    w = Window.partitionBy(*keys, "_b").orderBy(F.col(order))
    rows = rows.withColumns({
        "_in": F.sum(F.when(F.col("_own"), F.col(value))).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "moving_avg": F.avg(value).over(w.rangeBetween(-preceding, following)),
        "_p": F.lag("_x").over(w), "_n": F.lead("_x").over(w),
    }).filter("_own")
    out = rows.join(edge, ["_key", "_b"], "left")
    # As in SQL, the sum is null only as long as every value so far is.
    total = F.when(F.coalesce("_in", "_before").isNotNull(), F.coalesce("_in", F.lit(0)) + F.coalesce("_before", F.lit(0)))
    return out.select(*map(ident, df.columns), total.alias("running_sum"), "moving_avg",
                      F.coalesce("_p", "_pb")["v"].alias("lag_value"), F.coalesce("_n", "_nb")["v"].alias("lead_value"),
                      F.col("_first.v").alias("first_value"), F.col("_last.v").alias("last_value"))


def range_count(left: DataFrame, right: DataFrame, by: Sequence[str], ts: str, seconds: int,
                bucket: str = "1 day", out: str = "in_range", id_col: str | None = None) -> DataFrame:
    """For each left row: how many right rows of the same ``by`` key have a
    time in ``(t, t + seconds]``, without forming any (left, right) pair.

    count(t0 < x <= t1) = N(t1) - N(t0), with N(t) = right rows at or before
    t.  Left rows stand among the right ones at both times; N is a running
    count inside (key, bucket) plus the counts of the key's earlier buckets
    (one row a bucket), so a hot key is spread over many tasks.  Left rows
    without key or time find nothing; they are told apart by ``id_col``, or
    else by a number of their own."""
    keys = ["_key"]  # in a struct null keys are equal, so one partitioning serves windows and the join
    key = F.struct(*map(ident, by)).alias("_key")
    mine = left if id_col is not None else left.withColumn("_id", F.monotonically_increasing_id())
    number = F.col(ident(id_col or "_id"))
    kind = left.schema[ts].dataType
    t1 = (F.col(ts).cast("timestamp") + F.make_interval(secs=F.lit(seconds))).cast(kind)
    payload = F.struct(*map(ident, left.columns))
    probes = mine.select(key, number.alias("_id"), payload.alias("_row"), F.explode(F.array(
        F.struct(F.col(ts).alias("_at"), F.lit(-1).alias("_sign")), F.struct(t1.alias("_at"), F.lit(1).alias("_sign")))).alias("_q"))
    probes = probes.select(*keys, "_id", F.when(F.col("_q._sign") == 1, F.col("_row")).alias("_row"), F.col("_q._at").alias("_at"),
                           F.col("_q._sign").alias("_sign"), F.lit(0).cast("long").alias("_n"))
    # Right rows of one time are one row; they come before the probes of that time.
    counted = right.filter(F.col(ts).isNotNull()).groupBy(key, F.col(ts).alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
    counted = counted.withColumn("_b", time_bucket("_at", bucket))
    rows = probes.withColumn("_b", time_bucket("_at", bucket)).unionByName(counted.withColumn("_sign", F.lit(0)), allowMissingColumns=True)
    w = Window.partitionBy(*keys, "_b").orderBy("_at", F.abs("_sign")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_in", F.sum("_n").over(w)).filter("_sign <> 0")
    # Earlier buckets: one row a bucket that has right rows, one a bucket that is asked for.
    totals = counted.groupBy(*keys, "_b").agg(F.sum("_n").alias("_t"))
    asked = probes.select(*keys, time_bucket("_at", bucket).alias("_b"), F.lit(0).cast("long").alias("_t"))
    totals = totals.unionByName(asked).groupBy(*keys, "_b").agg(F.sum("_t").alias("_t"))
    wb = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*keys, "_b", F.coalesce(F.sum("_t").over(wb), F.lit(0)).alias("_before"))
    rows = rows.join(totals, ["_key", "_b"], "left")
    n = F.col("_sign") * (F.col("_in") + F.coalesce("_before", F.lit(0)))
    got = rows.groupBy("_id").agg(F.max("_row").alias("_row"), F.sum(n).alias("_n"))
    keyed = F.col(f"_row.{ident(ts)}").isNotNull()
    for c in by:
        keyed = keyed & F.col(f"_row.{ident(c)}").isNotNull()
    return got.select(*(F.col(f"_row.{ident(c)}").alias(c) for c in left.columns), F.when(keyed, F.col("_n")).otherwise(0).cast("long").alias(out))


def first_last(df: DataFrame, key: Sequence[str], order: str, value: str) -> DataFrame:
    """``first_value`` / ``last_value`` over the whole key: partial aggregates
    (min_by / max_by), joined back."""
    keys = list(map(ident, key))
    fl = df.groupBy(*keys).agg(F.min_by(value, order).alias("first_value"), F.max_by(value, order).alias("last_value"))
    return df.join(fl, list(key), "left")


def sessions(df: DataFrame, key: Sequence[str], ts: str, gap_seconds: int, bucket: str = "1 day") -> DataFrame:
    """Session per key with a gap: a new session starts when the previous
    event of the key is more than ``gap_seconds`` earlier.  Adds
    ``session_start`` (null for an event without time).

    Gaps are found inside (key, bucket); one row a bucket then tells which
    session the bucket's first events go on with."""
    keys = ["_key"]  # in a struct null keys are equal, so one partitioning serves windows and the join
    rows = df.withColumns({"_key": F.struct(*map(ident, key)), "_b": time_bucket(ts, bucket), "_t": F.col(ts)})
    w = Window.partitionBy(*keys, "_b").orderBy(F.col(ts))
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    broken = lambda before: micros(F.col("_t")) - micros(before) > gap_seconds * 1_000_000
    rows = rows.withColumn("_head", F.when(broken(F.lag("_t").over(w)), F.col("_t")))
    rows = rows.withColumn("_start", F.max("_head").over(w.rangeBetween(Window.unboundedPreceding, 0)))
    # The rows are partitioned by (key, bucket) already: this adds up in place.
    edge = rows.filter("_t IS NOT NULL").groupBy(*keys, "_b").agg(F.min("_t").alias("_t"), F.max("_t").alias("_to"), F.max("_head").alias("_open"))
    wb = Window.partitionBy(*keys).orderBy("_b")
    before = F.lag("_to").over(wb)
    edge = edge.withColumn("_new", F.when(before.isNull() | broken(before), F.col("_t")))
    left = F.last(F.coalesce("_open", "_new"), ignorenulls=True).over(wb.rowsBetween(Window.unboundedPreceding, -1))
    edge = edge.select(*keys, "_b", F.coalesce("_new", left).alias("_first"))
    out = rows.join(edge, ["_key", "_b"], "left")
    return out.withColumn("session_start", F.when(F.col("_t").isNotNull(), F.coalesce("_start", "_first"))).drop("_key", "_b", "_t", "_head", "_start", "_first")


def ranked(df: DataFrame, key: Sequence[str], order: Sequence[str], tie: Sequence[str] = (), tiles: int | None = None) -> DataFrame:
    """``row_number``, ``rank``, ``dense_rank`` and ``percent_rank`` (and
    ``tile``, of ``tiles``) of each row among those of its key, by ``order``
    ascending, nulls first; ``tie`` orders rows that are equal in ``order``.

    For few, large keys: rows are sorted by ranges of (key, order, tie), so
    one key is dealt over many tasks, and so are very many equal values.  Each
    range numbers its own rows and adds what earlier ranges hold of the key
    (one row for each range and key in it).  The ranges are written to the
    shared scratch folder first, so that both readings see the same ones."""
    keys, by = list(map(ident, key)), [*map(ident, key), *map(ident, order), *map(ident, tie)]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = df.repartitionByRange(parts, *(F.col(c).asc_nulls_first() for c in by), F.rand(17))
    rows = scratch_table(ranges.withColumn("_part", F.spark_partition_id()), "ranges")
    value = F.struct(*map(ident, order))
    w = Window.partitionBy("_part", *keys).orderBy(*(F.col(c).asc_nulls_first() for c in by[len(key):]))
    peers = Window.partitionBy("_part", *keys).orderBy(*(F.col(ident(c)).asc_nulls_first() for c in order))
    rows = rows.withColumns({"_value": value, "_no": F.row_number().over(w), "_rank": F.rank().over(peers), "_dense": F.dense_rank().over(peers)})
    spans = rows.groupBy("_part", *keys).agg(
        F.count(F.lit(1)).alias("_rows"), F.max("_dense").alias("_values"), F.min("_value").alias("_from"), F.max("_value").alias("_to"),
        F.max(F.struct("_value", (-F.col("_rank")).alias("r"))).alias("_open"))
    # One row for each range and key in it.
    wk = Window.partitionBy(*keys).orderBy("_part")
    earlier = wk.rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumns({
        "_size": F.sum("_rows").over(Window.partitionBy(*keys)), "_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
        "_goes_on": F.coalesce(F.lag("_to").over(wk) == F.col("_from"), F.lit(False))})
    spans = spans.withColumns({
        "_distinct": F.coalesce(F.sum(F.col("_values") - F.col("_goes_on").cast("int")).over(earlier), F.lit(0)) - F.col("_goes_on").cast("int"),
        "_opened": F.col("_before") - F.col("_open.r")})  # rank of the range's last value, had it begun here
    # A value that runs over several ranges has the rank it got in the first of them.
    firsts = spans.groupBy(*keys, F.col("_to").alias("_from")).agg(F.min("_opened").alias("_first"))
    spans = join_null_safe(spans, firsts, [*key, "_from"])
    spans = spans.select("_part", *keys, "_size", "_before", "_distinct", "_from", F.when(F.col("_goes_on"), F.col("_first")).alias("_first"))
    spans = scratch_table(spans, "spans")
    if spans.count() <= 50_000:  # ranges plus keys
        spans = F.broadcast(spans)
    out = join_null_safe(rows, spans, ["_part", *key])
    number = F.col("_before") + F.col("_no")
    rank = F.when(F.col("_first").isNotNull() & (F.col("_value") == F.col("_from")), F.col("_first")).otherwise(F.col("_before") + F.col("_rank"))
    columns = {"row_number": number, "rank": rank, "dense_rank": F.col("_distinct") + F.col("_dense"),
               "percent_rank": F.when(F.col("_size") > 1, (rank - 1) / (F.col("_size") - 1)).otherwise(0.0)}
    if tiles:
        size, more = F.expr(f"_size div {int(tiles)}"), F.col("_size") % tiles  # the first tiles hold one row more
        big = more * (size + 1)
        columns["tile"] = F.when(number <= big, F.ceil(number / (size + 1))).otherwise(more + F.ceil((number - big) / F.greatest(size, F.lit(1))))
    return out.select(*map(ident, df.columns), *(c.cast("double" if n == "percent_rank" else "long").alias(n) for n, c in columns.items()))
