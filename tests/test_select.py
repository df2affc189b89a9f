"""Predicates, paging, page-chain cut, validation and program names."""

import pytest
from pyspark.sql import functions as F

from lakefold.operators import select
from lakefold.operators.validate import check_programs, program_lookup


def test_cabin_names():
    assert [select.cabin_code(c) for c in ["economy", "premium", "business", "first", "j"]] == ["Y", "W", "J", "F", "J"]
    with pytest.raises(ValueError):
        select.cabin_code("coach")
    assert select.cabin_column("business", "MileageCost", include_filtered=False) == "JMileageCostRaw"


def test_optional_predicates(spark):
    df = spark.range(10)
    assert df.filter(select.all_of([None, None])).count() == 10
    assert df.filter(select.all_of([F.col("id") > 3, None, F.col("id") < 6])).count() == 2


def test_first_n_none_and_zero(spark):
    df = spark.range(5)
    assert select.first_n(df, None, ["id"]).count() == 5
    assert select.first_n(df, 0, ["id"]).count() == 0
    assert [r.id for r in select.first_n(df, 2, ["id"]).collect()] == [0, 1]


def test_page_numbers_match_brute_force(spark):
    df = spark.range(0, 1037, 1, numPartitions=7).withColumn("k", (F.col("id") * 7919) % 1037)
    out = {r.k: r.page for r in select.number_pages(df.select("k"), ["k"], 100).collect()}
    assert out == {k: k // 100 + 1 for k in range(1037)}
    skipped = select.number_pages(df.select("k"), ["k"], 100, start_skip=250).collect()
    assert min(r.k for r in skipped) == 250 and {r.page for r in skipped if r.k == 250} == {1}


def test_one_page_offset(spark):
    assert [r.id for r in select.page(spark.range(100), ["id"], 20, 5).collect()] == [20, 21, 22, 23, 24]


def pages(spark, rows):
    return spark.createDataFrame(rows, "prog string, page long, n_records long, has_more boolean")


def test_page_chain_cut_rules(spark):
    rows = [("a", 1, 5, True), ("a", 2, 0, True), ("a", 3, 5, True),   # empty middle page: stop before it
            ("b", 1, 5, True), ("b", 2, 5, False), ("b", 3, 5, True),  # hasMore=false: keep it, stop after
            ("c", 1, 5, True), ("c", 2, 5, True)]
    kept = {(r.prog, r.page) for r in select.cut_page_chain(pages(spark, rows), ["prog"]).filter("kept").collect()}
    assert kept == {("a", 1), ("b", 1), ("b", 2), ("c", 1), ("c", 2)}
    none = select.cut_page_chain(pages(spark, rows), ["prog"], max_pages=0).filter("kept").count()
    assert none == 0
    one = {(r.prog, r.page) for r in select.cut_page_chain(pages(spark, rows), ["prog"], max_pages=1).filter("kept").collect()}
    assert one == {("a", 1), ("b", 1), ("c", 1)}


def test_carriers_split_and_trim(spark):
    df = spark.createDataFrame([("AC, LH, UA",), ("",), ("BA",)], "YAirlines string")
    got = [r.YAirlines for r in df.filter(select.carriers_any("YAirlines", ["lh", "BA"])).collect()]
    assert got == ["AC, LH, UA", "BA"]


def test_search_asks_everything_of_one_cabin(spark):
    cols = [f"{c}{m}" for c in "YWJF" for m in ("Available", "Direct", "Airlines")]
    row = lambda i, **on: {"ID": i, **{c: "" if c.endswith("Airlines") else False for c in cols}, **on}
    rows = [row("y", YAvailable=True, YAirlines="AC"), row("mixed", YAvailable=True, JDirect=True, JAirlines="LH"),
            row("j", JAvailable=True, JDirect=True, JAirlines="OS, LH")]
    df = spark.createDataFrame(rows, "ID string, " + ", ".join(f"{c} {'string' if c.endswith('Airlines') else 'boolean'}" for c in cols))
    found = lambda **q: sorted(r.ID for r in select.search(df, **q).collect())
    assert found(carriers=["LH"]) == ["j", "mixed"] and found(carriers=["AC"]) == ["y"]
    assert found(cabins=["economy", "business"], only_direct=True) == ["j"]
    assert found(cabins=["Y"], carriers=["LH"]) == [] and found(only_direct=True, carriers=["os"]) == ["j"]
    assert found(carriers=["LH"], order_by=["ID"], skip=1, take=1) == ["mixed"]


def test_program_names_case_and_unknown(spark):
    df = spark.createDataFrame([("AEROPLAN",), ("United",), ("lifemiles",), (" flying_blue ",)], "src string")
    out = {r.src: (r.program, r.program_error is None) for r in check_programs(df, "src").collect()}
    assert out["AEROPLAN"] == ("aeroplan", True) and out["United"] == ("united", True)
    assert out[" flying_blue "] == ("flying_blue", True)
    assert out["lifemiles"][0] is None and not out["lifemiles"][1]
    assert df.select(program_lookup(F.col("src")).alias("p")).filter("p IS NULL").count() == 1
