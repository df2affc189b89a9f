"""Plan shape: what must hold at scale."""

import datetime as dt

from pyspark.sql import functions as F

from lakefold.functions.hashing import with_content_hash
from lakefold.operators import fold, select
from lakefold.operators.merge import dedup_latest, merge_changes
from lakefold.plans import derive
from tests.conftest import SF


def plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_merge_plan_has_no_single_partition_and_no_python(spark):
    o = with_content_hash(derive.table(spark, SF, "orders"))
    p = plan(merge_changes(o.select("o_orderkey", "content_hash"), o, ["o_orderkey"]))
    assert "SinglePartition" not in p and "Python" not in p


def test_dedup_and_fold_aggregate_before_the_shuffle(spark):
    """A hot key (a third of the rows) is combined map-side: partial
    aggregates appear below the exchange."""
    hot = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        (F.col("id") / 1000).cast("long").alias("page"), F.col("id").alias("pos"), (F.col("id") % 7).alias("v"))
    p = plan(dedup_latest(hot, ["k"], ["page", "pos"]))
    assert "partial_max_by" in p
    hashed = with_content_hash(hot, exclude=["page", "pos"])
    ev = fold.change_events(hashed, ["k"], "page", pos_col="pos")
    p2 = plan(ev)
    assert "partial_max_by" in p2 and "SinglePartition" not in p2
    # the window after the per-page dedup sees at most one row per page for the hot key
    per_page = fold.last_per_page(hashed, ["k"], "page", "pos").filter("k = 0").count()
    assert per_page == 30


def test_predicates_reach_the_scan(spark):
    o = derive.table(spark, SF, "orders")
    p = plan(o.filter(select.date_range("o_orderdate", "1996-01-01", None) | F.lit(False)).select("o_orderkey"))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in p
    p = plan(o.filter(select.in_set("o_orderpriority", ["1-URGENT"])).select("o_orderkey"))
    assert "PushedFilters: [In(o_orderpriority" in p or "EqualTo(o_orderpriority" in p


def test_page_numbering_keeps_rows_partitioned(spark):
    o = derive.table(spark, SF, "orders").select("o_orderkey")
    p = plan(select.number_pages(o, ["o_orderkey"], 100))
    assert "rangepartitioning(o_orderkey" in p
    # the only single-partition step is over the per-partition counts
    assert p.count("SinglePartition") <= 1


def test_search_paging(spark):
    df = spark.createDataFrame([(f"a{i:02d}", "aeroplan", dt.date(2025, 1, 1 + i)) for i in range(20)],
                               "ID string, Source string, Date date")
    got = [r.ID for r in select.search(df, sources=["aeroplan"], order_by=["Date"], skip=5, take=3).collect()]
    assert got == ["a05", "a06", "a07"]
