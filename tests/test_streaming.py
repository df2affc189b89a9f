"""Streams that fail half way, and dedup whose state is bounded."""

import datetime as dt
import json

import pytest

import lakefold.streaming.ingest as ingest
from lakefold import schemas as S
from tests.conftest import sample_record
from tests.test_runtime import KEYED, _land, _page, _rec, _state


class Boom(RuntimeError):
    pass


def test_a_merge_that_fails_after_staging_is_made_up_for(spark, scratch, monkeypatch):
    landed, table, ckpt = scratch + "/landed", scratch + "/t", scratch + "/ckpt"
    _land(landed + "/run=0/program=a", [_page(0, [_rec(1, "1")], True), _page(1, [_rec(2, "2")], False)])

    def fail(*a, **k):
        raise Boom

    with monkeypatch.context() as m:
        m.setattr(ingest, "merge_pages", fail)
        with pytest.raises(Boom):
            ingest.ingest_stream(spark, landed, table, ckpt, files_per_batch=1, **KEYED)
    assert ingest.pending_batches(spark, ckpt) == [0, 1]
    st = ingest.ingest_stream(spark, landed, table, ckpt, files_per_batch=1, **KEYED)  # nothing new landed
    assert st["batches"] == 2 and st["rows_inserted"] == 2 and _state(spark, table) == {"rec1": "1", "rec2": "2"}
    assert ingest.pending_batches(spark, ckpt) == []


def test_a_mark_that_is_lost_after_the_merge_changes_nothing(spark, scratch, monkeypatch):
    landed, table, ckpt = scratch + "/landed", scratch + "/t", scratch + "/ckpt"
    _land(landed, [_page(0, [_rec(1, "1")], False)])
    real = ingest.merge_pages

    def merged_but(*a, **k):
        real(*a, **k)
        raise Boom

    with monkeypatch.context() as m:
        m.setattr(ingest, "merge_pages", merged_but)
        with pytest.raises(Boom):
            ingest.ingest_stream(spark, landed, table, ckpt, **KEYED)
    st = ingest.ingest_stream(spark, landed, table, ckpt, **KEYED)
    assert st["batches"] == 1 and st["rows_written"] == 0 and st["rows_unchanged"] == 1 and _state(spark, table) == {"rec1": "1"}


def test_a_driver_lost_between_micro_batches(spark, scratch, monkeypatch):
    """Program a lands in the first micro-batch only, the second one fails."""
    landed, table, ckpt = scratch + "/landed", scratch + "/t", scratch + "/ckpt"
    _land(landed + "/run=0/program=a", [_page(0, [_rec(1, "1")], False)])
    _land(landed + "/run=0/program=b", ["", _page(0, [_rec(2, "2")], True)])
    with monkeypatch.context() as m:
        concat = ingest.F.concat_ws
        calls = []

        def once(*a):
            calls.append(1)
            if len(calls) > 1:
                raise Boom
            return concat(*a)

        m.setattr(ingest.F, "concat_ws", once)
        with pytest.raises(Exception):
            ingest.ingest_stream(spark, landed, table, ckpt, files_per_batch=1, **KEYED)
    assert len(ingest.pending_batches(spark, ckpt)) == 1
    _land(landed + "/run=0/program=b2", [_page(0, [_rec(3, "3")], False)])
    ingest.ingest_stream(spark, landed, table, ckpt, files_per_batch=1, **KEYED)
    assert _state(spark, table) == {"rec1": "1", "rec2": "2", "rec3": "3"}


def test_later_pages_of_a_chain_meet_the_earlier_ones(spark, scratch):
    """The chain's last page lands in a later drain: pages behind it go."""
    landed, table, ckpt = scratch + "/landed", scratch + "/t", scratch + "/ckpt"
    _land(landed + "/run=0/program=a", [_page(0, [_rec(1, "1")], True)])
    assert ingest.ingest_stream(spark, landed, table, ckpt, **KEYED)["pages_fetched"] == 1
    _land(landed + "/run=0/program=a/more", [_page(1, [_rec(2, "2")], False), _page(2, [_rec(3, "3")], False)])
    st = ingest.ingest_stream(spark, landed, table, ckpt, **KEYED)
    assert st["pages_fetched"] == 2 and _state(spark, table) == {"rec1": "1", "rec2": "2"}


def _day(n, cost, day):
    when = (dt.datetime(2031, 7, 1) + dt.timedelta(days=day)).strftime("%Y-%m-%dT%H:%M:%SZ")
    return sample_record(n % 9, ID=f"rec{n}", YMileageCost=cost, UpdatedAt=when)


def test_dedup_keeps_state_bounded_and_reports_late_repeats(spark, scratch):
    landed, out, ckpt = scratch + "/landed", scratch + "/out", scratch + "/ckpt"
    days = [[_day(10 * d + k, "1", d) for k in range(4)] for d in range(18)]

    def drain(name, records):
        _land(f"{landed}/{name}", [_page(i, r, True) for i, r in enumerate(records)])
        return ingest.dedup_stream(spark, landed, out, ckpt, keys=["ID"], delay="2 days", files_per_batch=3)

    first = drain("run=0", [*days[:6], days[5], [*days[4], *days[4]]])  # repeats that state still knows
    assert first["rows"] == 24 and first["late_repeats"] == 0
    second = drain("run=1", [*days[6:12], days[2], [_day(999, "new", 3)]])  # an old repeat, and an old row that is new
    assert second["late_rows"] == 5 and second["late_repeats"] == 4 and second["rows"] == 25
    third = drain("run=2", [*days[12:], days[0]])
    assert third["late_repeats"] == 4 and third["rows"] == 24
    states = [x["state_rows"] for x in (first, second, third)]
    assert len(set(states)) == 1 and states[0] <= 3 * 4 * 6  # it does not grow: days of the delay and of a batch, with their timers
    rows = spark.read.parquet(out).select("ID", S.CONTENT_HASH)
    assert rows.count() == rows.distinct().count() == 73
    assert ingest.dedup_stream(spark, landed, out, ckpt, keys=["ID"], delay="2 days")["rows"] == 0


def test_dedup_stores_what_a_failed_drain_left(spark, scratch, monkeypatch):
    landed, out, ckpt = scratch + "/landed", scratch + "/out", scratch + "/ckpt"
    _land(landed, [_page(d, [_day(d, "1", d)], True) for d in range(4)])
    with monkeypatch.context() as m:
        real = ingest._there

        def stop(read):
            got = real(read)
            if got is not None and "late" in got.columns:
                raise Boom  # staged, not stored
            return got

        m.setattr(ingest, "_there", stop)
        with pytest.raises(Boom):
            ingest.dedup_stream(spark, landed, out, ckpt, keys=["ID"])
    assert ingest.dedup_stream(spark, landed, out, ckpt, keys=["ID"])["rows"] == 4
    assert spark.read.parquet(out).count() == 4


def test_landed_files_follow_their_input(spark, scratch):
    from lakefold.plans.jobs import landed_once

    def land():
        source = spark.read.parquet(scratch + "/in")
        return spark.read.json(landed_once(spark, "same:" + scratch, lambda path: source.write.json(path + "/rows"), source) + "/rows").count()

    spark.range(3).write.parquet(scratch + "/in")
    assert land() == land() == 3
    spark.range(2).write.mode("append").parquet(scratch + "/in")
    assert land() == 5


def test_micro_batches_stage_rows_once(spark, scratch):
    """What is staged is the parsed rows; the merge makes no second copy of them."""
    import glob

    from lakefold.session import ensure_checkpoint_dir

    def copies():
        return set(glob.glob(ensure_checkpoint_dir(spark).replace("file:", "") + "/lakefold/pages-*"))

    landed, ckpt, before = scratch + "/landed", scratch + "/ckpt", copies()
    _land(landed, [_page(0, [_rec(1, "1"), _rec(2, "2")], True), _page(1, [], True)])
    st = ingest.ingest_stream(spark, landed, scratch + "/t", ckpt, **KEYED)
    rows = ingest.staged_rows(spark, ckpt)
    assert st["rows_inserted"] == 2 and rows.count() == 3 and rows.filter("_pos IS NOT NULL").count() == 2
    assert copies() == before


def test_packed_rows_hold_no_names_and_lose_nothing(spark, scratch):
    from pyspark.sql import functions as F

    from lakefold.functions.hashing import add_metadata
    from lakefold.operators.shape import flatten_availability

    at = dt.datetime(2031, 1, 1, tzinfo=dt.timezone.utc)
    rows = add_metadata(flatten_availability(spark.createDataFrame([_rec(1, ""), _rec(2, "2", YAirlines=None)], S.AVAILABILITY_RECORD)), at)
    packed = ingest.packed_rows(rows.withColumn("_event", F.col("UpdatedAt").cast("timestamp")), ["ID", S.CONTENT_HASH])
    assert not any(name in r.row for r in packed.collect() for name in ("MileageCost", "Airport"))
    back = ingest.unpacked_rows(packed.withColumn("late", F.lit(False)), rows.schema).drop("late")
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


def test_pages_of_few_files_are_dealt_out(spark, scratch):
    """A micro-batch of fewer files than cores is parsed by more tasks than it has files."""
    landed, ckpt = scratch + "/landed", scratch + "/ckpt"
    _land(landed, ["\n".join(json.dumps(_page(k, [_rec(k, "1")], True)) for k in range(16))])
    st = ingest.ingest_stream(spark, landed, scratch + "/t", ckpt, files_per_batch=1, **KEYED)
    assert st["rows_inserted"] == 16 and st["pages_fetched"] == 16
    rows = ingest.staged_rows(spark, ckpt)
    assert rows.filter("batch = 0").select("_metadata.file_path").distinct().count() > 1


def test_dedup_moves_keys_and_places_only(spark, scratch, monkeypatch):
    """State is the keys that the watermark has not passed, as a folder a
    micro-batch; a batch that fails before its watermark is written is done again on the same state."""
    landed, out, ckpt = scratch + "/landed", scratch + "/out", scratch + "/ckpt"
    timeless = [_rec(70, "x", UpdatedAt=None), _rec(70, "x", UpdatedAt=None)]  # without time or key part: late, and stored once
    _land(landed, [_page(d, [_day(d, "1", d), _day(d, "1", d)], True) for d in range(4)] + [_page(4, [_day(3, "1", 3), *timeless], True)])

    def drain():
        return ingest.dedup_stream(spark, landed, out, ckpt, delay="2 days", files_per_batch=1)

    with monkeypatch.context() as m:
        real, calls = ingest.join_null_safe, []

        def once(*a, **k):
            calls.append(1)
            if len(calls) == 2:
                raise Boom
            return real(*a, **k)

        m.setattr(ingest, "join_null_safe", once)
        with pytest.raises(Exception):
            drain()
    st = drain()
    assert (st["rows"], st["late_rows"], st["late_repeats"]) == (5, 1, 0)
    keys = spark.read.option("basePath", ckpt + "/state-keys").parquet(ckpt + "/state-keys/batch=4")
    assert set(keys.columns) == {"RouteID", "UpdatedAt", S.CONTENT_HASH, "_event", "batch"}
    assert keys.count() == st["state_rows"] == 2  # days 2 and 3
    assert sorted(r.ID for r in spark.read.parquet(out).collect()) == ["rec0", "rec1", "rec2", "rec3", "rec70"]
