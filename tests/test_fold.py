"""Fold over pages = sequential merges; skew-safe windows = plain windows."""

import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from lakefold.functions.hashing import with_content_hash
from lakefold.operators import fold, windows
from lakefold.storage.table import ArchiveTable


def test_fold_equals_sequential_merges(spark, scratch):
    random.seed(7)
    rows = []
    for page in range(6):
        for key in range(12):
            if random.random() < 0.7:
                rows.append((page, key, random.choice(["A", "B"]), page * 100 + key))
    rows += [(0, 99, "A", 0), (1, 99, "B", 1), (2, 99, "A", 2)]  # A -> B -> A: two changes
    df = spark.createDataFrame(rows, "page long, k long, v string, pos long")
    hashed = with_content_hash(df.select("k", "v", "page", "pos"), exclude=["page", "pos"])
    events = fold.change_events(hashed, ["k"], "page", pos_col="pos")
    assert events.filter("k = 99").count() == 3
    t = ArchiveTable(spark, scratch + "/seq")
    written = 0
    for page in range(6):
        batch = df.filter(F.col("page") == page).select("k", "v")
        written += t.save(batch, "merge", ["k"], ingestion_ts=dt.datetime(2025, 1, 1 + page, tzinfo=dt.timezone.utc))["rows_written"]
    assert written == events.count()
    seq_state = {r.k: r.v for r in t.current().collect()}
    fold_state = {r.k: r.v for r in fold.latest_per_key(hashed, ["k"], "page", "pos").collect()}
    assert seq_state == fold_state


def test_valid_intervals_brute_force(spark):
    random.seed(3)
    base = dt.datetime(2024, 1, 1)
    rows = [(i, random.randint(0, 3), base + dt.timedelta(hours=random.randint(0, 24 * 200))) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, e long, ts timestamp")
    got = {r.id: r.valid_to for r in fold.valid_intervals(df, ["e"], "ts", "7 days", tie=["id"]).collect()}
    pdf = pd.DataFrame(rows, columns=["id", "e", "ts"]).sort_values(["e", "ts", "id"])
    pdf["nxt"] = pdf.groupby("e")["ts"].shift(-1)
    want = {r.id: (None if pd.isna(r.nxt) else r.nxt.to_pydatetime()) for r in pdf.itertuples()}
    assert got == want


def test_asof_brute_force(spark):
    random.seed(5)
    base = dt.datetime(2024, 1, 1)
    left = [(i, random.randint(0, 2), base + dt.timedelta(minutes=random.randint(0, 60 * 24 * 5))) for i in range(200)]
    right = [(random.randint(0, 2), base + dt.timedelta(minutes=random.randint(0, 60 * 24 * 5)), float(i)) for i in range(150)]
    L = spark.createDataFrame(left, "id long, u long, ts timestamp")
    R = spark.createDataFrame(right, "u long, ts timestamp, v double")
    got = {r.id: r.asof_v for r in fold.asof_last(L, R, ["u"], "ts", "v", bucket="1 day").collect()}
    want = {}
    for i, u, ts in left:
        cands = [(t, v) for uu, t, v in right if uu == u and t < ts]
        want[i] = max(cands)[1] if cands else None
    assert got == want


def test_running_and_dense_frame_brute_force(spark):
    random.seed(11)
    rows = [(c, t, random.randint(1, 50)) for c in range(5) for t in range(random.randint(1, 40))]
    df = spark.createDataFrame(rows, "c long, t long, n long")
    out = windows.first_last(windows.dense_frame(windows.running_sum(df, ["c"], "t", "n", 8), ["c"], "t", "n", 3, 0, 8), ["c"], "t", "n")
    got = {(r.c, r.t): (r.running_sum, round(r.moving_avg, 9), r.lag_value, r.lead_value, r.first_value, r.last_value) for r in out.collect()}
    pdf = pd.DataFrame(rows, columns=["c", "t", "n"]).sort_values(["c", "t"])
    want = {}
    for c, g in pdf.groupby("c"):
        ns = list(g.n)
        for i, t in enumerate(g.t):
            win = ns[max(0, i - 3): i + 1]
            want[(c, t)] = (sum(ns[: i + 1]), round(sum(win) / len(win), 9), ns[i - 1] if i else None,
                            ns[i + 1] if i + 1 < len(ns) else None, ns[0], ns[-1])
    assert got == want


def test_sessions_brute_force(spark):
    random.seed(2)
    base = dt.datetime(2024, 1, 1)
    rows = [(i, random.randint(0, 2), base + dt.timedelta(minutes=random.randint(0, 3000))) for i in range(150)]
    df = spark.createDataFrame(rows, "id long, u long, ts timestamp")
    got = {r.id: r.session_start for r in windows.sessions(df, ["u"], "ts", 30 * 60, bucket="6 hours").collect()}
    want = {}
    for u in range(3):
        evs = sorted((ts, i) for i, uu, ts in rows if uu == u)
        start, prev = None, None
        for ts, i in evs:
            if prev is None or (ts - prev).total_seconds() > 1800:
                start = ts
            want[i] = start
            prev = ts
    assert got == want


def test_range_count_hot_key_and_ties(spark):
    random.seed(13)
    base = dt.datetime(2024, 1, 1)
    # key 0 holds about half of the rows; times repeat (ties) on purpose
    right = [(0 if random.random() < 0.5 else random.randint(1, 3), base + dt.timedelta(minutes=5 * random.randint(0, 2000)))
             for _ in range(600)]
    left = [(i, u, t) for i, (u, t) in enumerate(random.sample(right, 80))]
    L = spark.createDataFrame(left, "id long, u long, ts timestamp")
    R = spark.createDataFrame(right, "u long, ts timestamp")
    for id_col in ("id", None):
        out = windows.range_count(L, R, ["u"], "ts", 3600, bucket="6 hours", out="n", id_col=id_col)
        got = {r.id: r.n for r in out.collect()}
        want = {i: sum(1 for uu, t in right if uu == u and ts < t <= ts + dt.timedelta(hours=1)) for i, u, ts in left}
        assert got == want


def test_asof_with_nulls_and_ties(spark):
    left = spark.createDataFrame([("k", 100, 1), ("k", None, 2), (None, 100, 3), ("k", 5, 4), ("k", 200_000, 5), ("m", 100, 6)],
                                 "k string, s long, id int").selectExpr("k", "timestamp_seconds(s) AS ts", "id")
    right = spark.createDataFrame([("k", 10, 5), ("k", 50, None), (None, 1, 9), ("k", None, 8), ("m", 100, 1), ("m", 99, 2), ("m", 99, 3),
                                   ("k", 90_000, 7), ("k", 90_000, 6)], "k string, s long, v int").selectExpr("k", "timestamp_seconds(s) AS ts", "v")
    got = {r.id: r.asof_v for r in fold.asof_last(left, right, ["k"], "ts", "v").collect()}
    assert got == {1: None, 2: None, 3: None, 4: None, 5: 7, 6: 3}
    assert {r.id: r.asof_v for r in fold.asof_last(left, right, ["k"], "ts", "v", strict=False).collect()}[6] == 1


def test_intervals_keep_rows_without_time_or_entity(spark):
    df = spark.createDataFrame([("a", 0), ("a", 86_400 * 90), ("a", None), (None, 5), (None, 86_400 * 40)], "e string, s long")
    df = df.selectExpr("e", "s", "timestamp_seconds(s) AS ts")
    out = {(r.e, r.s): r.valid_to and int(r.valid_to.timestamp()) for r in fold.valid_intervals(df, ["e"], "ts").collect()}
    assert out == {("a", 0): 86_400 * 90, ("a", 86_400 * 90): None, ("a", None): None, (None, 5): 86_400 * 40, (None, 86_400 * 40): None}


def test_running_and_moving_frames_with_nulls_and_gaps(spark):
    from lakefold.operators import windows

    rows = [("a", 0, None), ("a", 1, 3), ("a", 9, None), ("a", 10, 4), ("a", 50, 7), (None, 0, 1), (None, 20, 2), ("z", 3, None)]
    df = spark.createDataFrame(rows, "k string, t long, v int")
    total = {(r.k, r.t): r.running_sum for r in windows.running_sum(df, ["k"], "t", "v", 10).collect()}
    lags = {(r.k, r.t): (r.lag_value, r.lead_value, r.moving_avg) for r in windows.dense_frame(df, ["k"], "t", "v", 1, 1, 10).collect()}
    for k in ("a", None, "z"):
        mine = sorted((t, v) for g, t, v in rows if g == k)
        for i, (t, v) in enumerate(mine):
            seen = [x for _, x in mine[: i + 1] if x is not None]
            near = [x for u, x in mine if abs(u - t) <= 1 and x is not None]
            assert total[k, t] == (sum(seen) if seen else None)
            assert lags[k, t] == (mine[i - 1][1] if i else None, mine[i + 1][1] if i + 1 < len(mine) else None,
                                  sum(near) / len(near) if near else None)
