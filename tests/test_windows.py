"""Operators for few, large keys, against plain loops and plain windows."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakefold.functions.hashing import with_content_hash
from lakefold.operators import fold, windows


def loop_changes(rows):
    """(key, page, change) that a page-by-page merge writes."""
    last, out = {}, set()
    for page in sorted({r[1] for r in rows}, key=lambda p: (p is not None, p)):
        now = {}
        for k, p, pos, v in sorted((r for r in rows if r[1] == page), key=lambda r: r[2]):
            now[k] = v
        for k, v in now.items():
            if k not in last or last[k] != v:
                out.add((k, page, "update" if k in last else "insert"))
            last[k] = v
    return out


def versions(pages, seed=5):
    rng = random.Random(seed)
    rows = [("hot", p, 0, rng.randint(0, 1)) for p in range(-pages // 4, pages) if rng.random() < 0.97]
    rows += [(f"k{rng.randint(0, 30)}", rng.randint(0, pages), i, rng.randint(0, 2)) for i in range(600)]
    return rows + [("late", None, 0, 1), ("late", pages - 1, 0, 1), (None, 3, 0, 1), (None, pages - 2, 0, 2)]


@pytest.mark.parametrize("pages, size, fan", [(400, 16, 256), (400, 4, 4), (60, 1024, 256)])
def test_changes_of_keys_in_many_pages(spark, pages, size, fan, monkeypatch):
    real = fold._carried
    monkeypatch.setattr(fold, "_carried", lambda last, keys, greatest, f=fan: real(last, keys, greatest, f))
    rows = versions(pages)
    df = with_content_hash(spark.createDataFrame(rows, "k string, page long, pos int, v int"), exclude=["page", "pos"])
    got = fold.change_events(df, ["k"], "page", pos_col="pos", pages=size)
    assert got.columns == [*df.columns, "_change"]
    assert {(r.k, r.page, r._change) for r in got.collect()} == loop_changes(rows)


def test_changes_by_run_and_cursor(spark):
    rows = versions(90)
    df = with_content_hash(spark.createDataFrame(rows, "k string, page long, pos int, v int"), exclude=["page", "pos"])
    df = df.withColumn("page", F.struct(F.floor(F.col("page") / 10).alias("run"), (F.col("page") * 1000).alias("cursor")))
    got = {(r.k, r.page.cursor and r.page.cursor // 1000, r._change) for r in fold.change_events(df, ["k"], "page", pos_col="pos", pages=8).collect()}
    want = {(k, p, c) for k, p, c in loop_changes(rows)}
    assert {(k, p or 0, c) for k, p, c in got} == {(k, p or 0, c) for k, p, c in want}


def test_one_key_of_all_pages_goes_to_several_tasks(spark):
    df = spark.range(10_000).select(F.lit("hot").alias("k"), F.col("id").alias("page"), (F.col("id") % 7 < 3).cast("string").alias("content_hash"))
    got = fold.change_events(df, ["k"], "page", pages=256)
    tagged = got.withColumn("task", F.spark_partition_id()).cache()
    values = [i % 7 < 3 for i in range(10_000)]
    assert tagged.count() == 1 + sum(a != b for a, b in zip(values, values[1:]))
    assert tagged.select("task").distinct().count() > 1


def plain_ranks(rows, tiles):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    for key, mine in by.items():
        low = lambda x: (x is not None, x if x is not None else 0)
        mine.sort(key=lambda r: (low(r[1]), r[2]))
        n, size, more = len(mine), *divmod(len(mine), tiles)
        values = [r[1] for r in mine]
        for i, r in enumerate(mine):
            rank = values.index(r[1]) + 1
            dense = len(set(values[: values.index(r[1])])) + 1
            tile = i // (size + 1) + 1 if i < more * (size + 1) else more + (i - more * (size + 1)) // max(size, 1) + 1
            yield r[2], i + 1, rank, dense, (rank - 1) / (n - 1) if n > 1 else 0.0, tile


@pytest.mark.parametrize("few", [50_000, 0])
def test_ranks_over_few_keys_with_ties_over_many_ranges(spark, few, monkeypatch):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([1, 1, 1, 1, 2, 3, None]), i) for i in range(700)] + [("one", 1, 9999)]
    df = spark.createDataFrame(rows, "k string, v int, id int").repartition(3)
    got = windows.ranked(df, ["k"], ["v"], tie=["id"], tiles=4)
    tasks = got.select(F.spark_partition_id()).distinct().count()
    got = {(r.id, r.row_number, r.rank, r.dense_rank, r.percent_rank, r.tile) for r in got.collect()}
    assert got == set(plain_ranks(rows, 4)) and tasks > 3


def test_ranks_of_25_nations_use_more_tasks_than_nations(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        df = spark.range(20_000).select((F.col("id") % 25).alias("n"), (F.col("id") * 7919 % 20_011).alias("v"), "id")
        got = windows.ranked(df, ["n"], ["v"], tie=["id"], tiles=4)
        assert windows.scratch_table(got, "t").select("n").distinct().count() == 25
        w = Window.partitionBy("n").orderBy("v", "id")
        want = df.select("id", F.row_number().over(w).cast("long").alias("rn"), F.ntile(4).over(w).cast("long").alias("t"))
        assert got.select("id", "row_number", "tile").exceptAll(want).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def series_rows(spark):
    rng = random.Random(8)
    rows = [("a", t, rng.randint(0, 9) if rng.random() < 0.9 else None) for t in range(-200, 200) if rng.random() < 0.8]
    rows += [("b", t * 37, t) for t in range(-5, 5)] + [(None, 1, 4), (None, 2, 5)]
    return spark.createDataFrame(rows, "k string, t int, v int")


@pytest.mark.parametrize("preceding, following", [(6, 0), (3, 2), (0, 0), (1, 5)])
def test_series_equals_plain_windows_for_negative_orders_too(spark, preceding, following):
    df = series_rows(spark)
    w = Window.partitionBy("k").orderBy("t")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    want = df.select("*", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("running_sum"),
                     F.avg("v").over(w.rangeBetween(-preceding, following)).alias("moving_avg"), F.lag("v").over(w).alias("lag_value"),
                     F.lead("v").over(w).alias("lead_value"), F.first("v").over(whole).alias("first_value"), F.last("v").over(whole).alias("last_value"))
    got = windows.series(df, ["k"], "t", "v", preceding, following, bucket_size=16)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    frame = windows.dense_frame(df, ["k"], "t", "v", preceding, following, 16).select("k", "t", "moving_avg")
    assert sorted(map(str, frame.collect())) == sorted(map(str, want.select("k", "t", "moving_avg").collect()))


def exchanges(df):
    """Exchanges of the final plan that are not taken over from another branch."""
    import re

    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"(?<!Reused)Exchange (?:hash|range)partitioning|(?<!Reused)Exchange SinglePartition", plan))


def events(n, seed=3):
    rng = random.Random(seed)
    t0 = dt.datetime(1970, 1, 1)
    out = []
    for i in range(n):
        user = rng.choice(["hot", "hot", "u1", "u2", None])
        at = None if rng.random() < 0.02 else t0 + dt.timedelta(seconds=rng.randint(-400_000, 400_000))
        out.append((i, user, at))
    return out + [(n, "u9", t0), (n + 1, "u9", t0)]


def test_sessions_equal_the_loop(spark):
    rows = events(500)
    df = spark.createDataFrame(rows, "id int, u string, ts timestamp")
    want, by = {}, {}
    for i, u, at in rows:
        if at is None:
            want[i] = None
        else:
            by.setdefault(u, []).append((at, i))
    for seen in by.values():
        start = last = None
        for at, i in sorted(seen):
            start = at if last is None or (at - last).total_seconds() > 1800 else start
            last, want[i] = at, start
    got = windows.sessions(df, ["u"], "ts", 1800, bucket="2 hours")
    assert {r.id: r.session_start for r in got.collect()} == want


def test_range_count_equals_the_loop(spark):
    left, right = events(120, 1), events(400, 2)
    L, R = (spark.createDataFrame(r, "id int, u string, ts timestamp") for r in (left, right))
    want = {i: sum(u is not None and t is not None and v == u and s is not None and t < s <= t + dt.timedelta(hours=1) for _, v, s in right)
            for i, u, t in left}
    for id_col in ("id", None):
        got = windows.range_count(L, R, ["u"], "ts", 3600, bucket="3 hours", out="n", id_col=id_col)
        assert got.columns == ["id", "u", "ts", "n"]
        assert {r.id: r.n for r in got.collect()} == want


def test_events_are_moved_once_or_twice(spark):
    """One partitioning of the events for sessions; one, and the sum by id, for range counts."""
    ev = spark.createDataFrame(events(50), "id int, u string, ts timestamp").persist()
    ev.count()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # The events by (key, bucket), whole and for the buckets' sums; one row a bucket by key, and back.
        assert exchanges(windows.sessions(ev, ["u"], "ts", 1800)) <= 4
        # Probes and counts by (key, bucket); buckets by key and back; the sum by id.
        assert exchanges(windows.range_count(ev, ev, ["u"], "ts", 3600, id_col="id")) <= 8
        assert exchanges(windows.series(series_rows(spark), ["k"], "t", "v", 6, 0, 64)) <= 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        ev.unpersist()


def test_time_buckets_round_down_before_1970(spark):
    df = spark.sql("SELECT explode(array(timestamp'1969-12-31 23:59:59', timestamp'1970-01-01 00:00:01', timestamp'1969-12-30 00:00:00')) AS ts")
    assert sorted(r[0] for r in df.select(fold.time_bucket("ts", "1 day")).collect()) == [-2, -1, 0]
    assert math.floor(-0.5) == -1
