"""Archive table sequences (FIXTURES 6 + 8) on local paths."""

import datetime as dt

import pytest

from lakefold.storage.table import ArchiveTable

SCHEMA = "ID string, value int, name string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_append_then_read(spark, scratch):
    t = ArchiveTable(spark, scratch + "/t")
    st = t.save(frame(spark, [("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z")]), "append")
    assert st["input_rows"] == 3 and st["mode"] == "append" and st["table_created"]
    df = t.current()
    assert df.count() == 3
    assert {"ingestion_timestamp", "content_hash"} <= set(df.columns)


def test_overwrite_replaces(spark, scratch):
    t = ArchiveTable(spark, scratch + "/t")
    t.save(frame(spark, [("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z")]), "overwrite")
    t.save(frame(spark, [("d", 4, "w")]), "overwrite")
    assert [r.ID for r in t.current().collect()] == ["d"]


def test_merge_sequence(spark, scratch):
    t = ArchiveTable(spark, scratch + "/t")
    rows = [("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z")]
    s1 = t.save(frame(spark, rows), "merge", ["ID"])
    assert s1["table_created"] and s1["rows_inserted"] == 3
    s2 = t.save(frame(spark, rows), "merge", ["ID"])
    assert s2["rows_written"] == 0 and s2["rows_unchanged"] == 3
    assert t.current().count() == 3
    s3 = t.save(frame(spark, [("a", 1, "x"), ("b", 99999, "y"), ("c", 3, "z")]), "merge", ["ID"])
    assert s3["rows_updated"] == 1 and s3["rows_inserted"] == 0
    got = {r.ID: r.value for r in t.current().collect()}
    assert got == {"a": 1, "b": 99999, "c": 3}


def test_merge_overlapping_batches(spark, scratch):
    t = ArchiveTable(spark, scratch + "/t")
    t.save(frame(spark, [("a", 1, "x"), ("b", 2, "y")]), "merge", ["ID"])
    st = t.save(frame(spark, [("b", 88888, "y"), ("c", 3, "z")]), "merge", ["ID"])
    assert st["rows_updated"] == 1 and st["rows_inserted"] == 1
    got = {r.ID: r.value for r in t.current().collect()}
    assert got == {"a": 1, "b": 88888, "c": 3}


def test_unchanged_rows_keep_old_timestamp(spark, scratch):
    t = ArchiveTable(spark, scratch + "/t")
    t0 = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)
    t1 = dt.datetime(2025, 2, 1, tzinfo=dt.timezone.utc)
    t.save(frame(spark, [("a", 1, "x"), ("b", 2, "y")]), "merge", ["ID"], ingestion_ts=t0)
    t.save(frame(spark, [("a", 1, "x"), ("b", 3, "y")]), "merge", ["ID"], ingestion_ts=t1)
    got = {r.ID: r.ingestion_timestamp.replace(tzinfo=None) for r in t.current().collect()}
    assert got["a"].month == 1 and got["b"].month == 2


def test_null_keys_and_duplicates(spark, scratch):
    t = ArchiveTable(spark, scratch + "/t")
    st = t.save(frame(spark, [(None, 1, "x"), ("a", 1, "x"), ("a", 2, "x"), ("b", 1, "y")]), "merge", ["ID"])
    assert st["null_key_rows"] == 1 and st["duplicate_rows"] == 1 and st["rows_inserted"] == 2
    assert t.current().count() == 2


def test_empty_batch_is_noop(spark, scratch):
    t = ArchiveTable(spark, scratch + "/t")
    t.save(frame(spark, [("a", 1, "x")]), "merge", ["ID"])
    st = t.save(frame(spark, []), "merge", ["ID"])
    assert st["input_rows"] == 0 and st["rows_written"] == 0
    assert t.current().count() == 1


def test_changed_row_moves_partition(spark, scratch):
    t = ArchiveTable(spark, scratch + "/t")
    t.save(frame(spark, [("a", 1, "x"), ("b", 2, "y")]), "merge", ["ID"], partition_by=["name"])
    t.save(frame(spark, [("a", 1, "q")]), "merge", ["ID"], partition_by=["name"])
    got = {r.ID: r.name for r in t.current().collect()}
    assert got == {"a": "q", "b": "y"}


def test_replay_is_told_by_stream_and_batch(spark, scratch):
    t = ArchiveTable(spark, scratch + "/t")
    t.save(frame(spark, [("a", 1, "x")]), "merge", ["ID"])
    first, other = frame(spark, [("b", 1, "y")]), frame(spark, [("c", 1, "z")])
    assert t.save(first, "merge", ["ID"], replay=("s1", 0))["rows_inserted"] == 1
    assert t.save(other, "merge", ["ID"], replay=("s2", 0))["rows_inserted"] == 1  # the same number of another stream
    again = t.save(first, "merge", ["ID"], replay=("s1", 0))
    assert again["replayed"] and again["rows_written"] == 0
    with pytest.raises(ValueError):
        t.save(other, "merge", ["ID"], replay=("s1", 0))
    assert sorted(r.ID for r in t.current().collect()) == ["a", "b", "c"]


def test_info_and_compaction(spark, scratch):
    t = ArchiveTable(spark, scratch + "/t")
    for v in range(3):
        t.save(frame(spark, [("a", v, "x"), ("b", 1, "y")]), "merge", ["ID"])
    info = t.info()
    assert info["version"] == 2 and info["files"] >= 1
    before = sorted((r.ID, r.value) for r in t.current().collect())
    st = t.compact()
    assert st["files_added"] >= 1
    assert sorted((r.ID, r.value) for r in t.current().collect()) == before


def test_compaction_keeps_to_the_file_size_and_takes_empty_tables(spark, scratch):
    t = ArchiveTable(spark, scratch + "/t")
    t.save(spark.range(20_000).selectExpr("CAST(id AS STRING) AS ID", "CAST(id AS INT) AS value", "'p' AS name"), "merge", ["ID"], ["name"])
    size = t.info()["bytes"]
    assert t.compact(target_file_bytes=size // 4)["files_added"] >= 4  # one partition value, several files
    e = ArchiveTable(spark, scratch + "/e")
    e.save(frame(spark, []), "merge", ["ID"], ["name"])
    e.compact()
    assert e.current().count() == 0


def test_state_saved_into_itself_changes_nothing(spark, scratch):
    t = ArchiveTable(spark, scratch + "/t")
    t.save(frame(spark, [("a", 1, "x"), ("b", 2, "y")]), "merge", ["ID"])
    t.save(frame(spark, [("b", 3, "y")]), "merge", ["ID"])
    assert "_action" not in t.current().columns and "_action" not in t.schema().fieldNames()
    st = t.save(t.current(), "merge", ["ID"])
    assert (st["rows_unchanged"], st["rows_written"]) == (2, 0)


def test_appends_keep_every_row_and_do_not_mix_with_merges(spark, scratch):
    t = ArchiveTable(spark, scratch + "/t")
    rows = frame(spark, [("a", 1, "x"), ("a", 1, "x"), (None, 2, "y")])
    t.save(rows, "append")
    t.save(rows, "append")
    assert t.current().count() == 6
    with pytest.raises(ValueError):
        t.save(rows, "merge", ["ID"])
    k = ArchiveTable(spark, scratch + "/k")
    k.save(frame(spark, [("a", 1, "x")]), "merge", ["ID"])
    with pytest.raises(ValueError):
        k.save(rows, "append")
    assert k.current().count() == 1


def test_columns_may_be_added_but_not_lost_or_retyped(spark, scratch):
    t = ArchiveTable(spark, scratch + "/t")
    t.save(frame(spark, [("a", 1, "x"), ("b", 2, "y")]), "merge", ["ID"])
    for bad in (spark.createDataFrame([("a", 1)], "ID string, value int"), spark.createDataFrame([("a", "1", "x")], "ID string, value string, name string")):
        with pytest.raises(ValueError):
            t.save(bad, "merge", ["ID"])
    t.save(spark.createDataFrame([("b", 2, "y", 7)], "ID string, value int, name string, more int"), "merge", ["ID"])
    assert {r.ID: (r.name, r.more) for r in t.current().collect()} == {"a": ("x", None), "b": ("y", 7)}


def test_an_unreadable_log_is_an_error_not_an_absent_table(spark, scratch):
    import os

    t = ArchiveTable(spark, scratch + "/t")
    assert not t.exists()
    t.save(frame(spark, [("a", 1, "x")]), "append")
    assert t.exists()
    log = f"{scratch}/t/_commits"
    os.makedirs(f"{log}/k=1"), os.makedirs(f"{log}/j=1")
    for d in ("k=1", "j=1"):
        with open(f"{log}/{d}/x.json", "w") as f:
            f.write("{}")
    with pytest.raises(Exception):
        t.save(frame(spark, [("b", 1, "x")]), "append")


def test_merge_reads_only_keys_and_hash(spark, scratch):
    t = ArchiveTable(spark, scratch + "/t")
    t.save(frame(spark, [("a", 1, "x")]), "merge", ["ID"])
    state = t.current(["ID", "content_hash"])
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ID:string,content_hash:string>" in plan


def test_merge_without_input_cache(spark, scratch):
    t = ArchiveTable(spark, scratch + "/t")
    t.save(frame(spark, [("a", 1, "x"), ("b", 2, "y")]), "merge", ["ID"], cache_input=False)
    st = t.save(frame(spark, [("a", 1, "x"), ("b", 3, "y"), ("c", 1, "z")]), "merge", ["ID"], cache_input=False)
    assert (st["rows_inserted"], st["rows_updated"], st["rows_unchanged"]) == (1, 1, 1)
