"""Content hash and metadata contracts (deterministic, order-free,
exclusion, 16 hex, batch-independent, null-stable)."""

import datetime as dt
import re

from pyspark.sql import functions as F

from lakefold.functions.hashing import add_metadata, with_content_hash

HEX16 = re.compile(r"^[0-9a-f]{16}$")


def hashes(df, exclude=None):
    return [r.content_hash for r in with_content_hash(df, exclude).collect()]


def test_deterministic_and_16_hex(spark):
    df = spark.createDataFrame([(1, "test", None)], "a int, b string, c string")
    h1, h2 = hashes(df), hashes(df)
    assert h1 == h2 and HEX16.match(h1[0])


def test_column_order_does_not_matter(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("x", 1)], "b string, a int")
    assert hashes(a) == hashes(b)


def test_exclusion(spark):
    a = spark.createDataFrame([(1, "x", "t1")], "a int, b string, ts string")
    b = spark.createDataFrame([(1, "x", "t2")], "a int, b string, ts string")
    assert hashes(a, ["ts"]) == hashes(b, ["ts"])
    assert hashes(a) != hashes(b)


def test_different_values_differ_and_null_differs_from_empty(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (1, None), (1, "")], "a int, b string")
    assert len(set(hashes(df))) == 4


def test_edge_values(spark):
    rows = [("日本語 ünïcödé 🚀",), ("x" * 100_000,), ("12345.678",), (None,)]
    df = spark.createDataFrame(rows, "s string")
    assert all(HEX16.match(h) for h in hashes(df))
    nums = spark.createDataFrame([(1, 2.5, 10**12, 1e10, -0.0)], "i int, d double, l long, big double, neg double")
    assert HEX16.match(hashes(nums)[0])


def test_batch_independent_types(spark):
    """Q1: an int column with a null elsewhere in the batch must not change
    the hash of the other rows (no float widening)."""
    alone = spark.createDataFrame([(50000,)], "miles int")
    mixed = spark.createDataFrame([(50000,), (None,)], "miles int")
    assert hashes(alone)[0] == hashes(mixed)[0]


def test_timestamps_keep_microseconds(spark):
    a = spark.createDataFrame([(dt.datetime(2025, 1, 1, 0, 0, 0, 1),)], "t timestamp")
    b = spark.createDataFrame([(dt.datetime(2025, 1, 1, 0, 0, 0, 2),)], "t timestamp")
    assert hashes(a) != hashes(b)


def test_add_metadata_columns_and_input_unchanged(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z")], "ID string, value int, name string")
    ts = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)
    out = add_metadata(df, ts)
    assert out.columns == ["ID", "value", "name", "ingestion_timestamp", "content_hash"]
    assert df.columns == ["ID", "value", "name"]
    rows = out.collect()
    assert len({r.content_hash for r in rows}) == 3
    assert {r.ingestion_timestamp for r in rows} == {dt.datetime(2025, 1, 1)}


def test_metadata_not_hashed_and_recomputed(spark):
    df = spark.createDataFrame([("a", 1)], "ID string, value int")
    once = add_metadata(df, dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc))
    twice = add_metadata(once, dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc))
    assert once.collect()[0].content_hash == twice.collect()[0].content_hash


def test_empty_frame_and_duplicates(spark):
    empty = spark.createDataFrame([], "ID string, value int")
    out = add_metadata(empty)
    assert out.count() == 0 and "content_hash" in out.columns
    dup = spark.createDataFrame([("a", 1), ("a", 1)], "ID string, value int")
    assert len(set(hashes(dup))) == 1


def test_hash_is_native_no_python(spark):
    df = spark.range(10).withColumn("s", F.col("id").cast("string"))
    plan = with_content_hash(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan and "WholeStageCodegen" in plan or "*(" in plan
