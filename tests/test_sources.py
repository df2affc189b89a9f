"""Sources: pages, trips, calendars, HTML, request parameters."""

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakefold import schemas as S
from lakefold.operators.shape import flatten_hotel_availability, flatten_hotels, hotel_url
from lakefold.sources import html as H
from lakefold.sources import json_pages as J


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "text string")


def test_page_envelope_empty_and_with_more(spark):
    empty = json.dumps({"data": [], "count": 0, "hasMore": False, "cursor": 0})
    more = json.dumps({"data": [{"ID": "a"}, {"ID": "b"}], "count": 2, "hasMore": True, "moreURL": "/next", "cursor": 5})
    pages = J.parse_pages(texts(spark, [empty, more]), "text")
    assert sorted((r["count"], r["hasMore"]) for r in pages.collect()) == [(0, False), (2, True)]
    recs = J.page_records(pages).collect()
    assert [(r._page, r._pos, r.ID) for r in recs] == [(5, 0, "a"), (5, 1, "b")]


def test_route_array(spark):
    arr = json.dumps([{"ID": "r1", "OriginAirport": "TRD", "NumDaysOut": 3, "Distance": 100, "Source": "aeroplan"},
                      {"ID": "r2", "OriginAirport": "BOO"}])
    out = J.routes(texts(spark, [arr]), "text").collect()
    assert [(r.ID, r.OriginAirport, r.NumDaysOut) for r in out] == [("r1", "TRD", 3), ("r2", "BOO", None)]


def test_trip_envelope_unwrap(spark):
    rows = [json.dumps({"ID": "t1", "gate": "B7", "legs": 4}), json.dumps({"data": [{"ID": "t2", "legs": "x"}, {"ID": "t3"}]}),
            json.dumps({"data": [], "ID": "t4", "legs": 0}), "no json"]
    df = texts(spark, rows).select(J.unwrap_trip(F.col("text")).alias("t"))
    out = df.select(J.trip_field(F.col("t"), "ID").alias("id"), J.trip_field(F.col("t"), "legs", "int").alias("n")).collect()
    assert [(r.id, r.n) for r in out] == [("t1", 4), ("t2", None), ("t4", 0), (None, None)]


def test_calendar_two_dates_empty_map_and_empty_list(spark):
    cal = json.dumps({"count": 2, "currency_code": "USD", "results": {
        "2032-11-08": {"lowestRate": 187.25, "lowestPointsRate": None, "available": True},
        "2032-11-09": {"lowestRate": None, "lowestPointsRate": 31500}}})
    empty_map = json.dumps({"count": 0, "results": {}})
    empty_list = json.dumps({"count": 0, "results": []})
    df = spark.createDataFrame([(1, cal), (2, empty_map), (3, empty_list)], "nid long, text string")
    rows = flatten_hotel_availability(J.calendar_rows(df, "text", "nid", True))
    assert rows.columns == S.HOTEL_AVAILABILITY.fieldNames()
    got = sorted((r.nid, r.date, r.lowest_rate, r.lowest_points_rate, r.available) for r in rows.collect())
    assert got == [(1, "2032-11-08", 187.25, None, True), (1, "2032-11-09", None, 31500, False)]


def test_points_and_cash_split(spark):
    cal = json.dumps({"count": 1, "results": {"2025-01-01": {"lowestRate": 1.0, "available": True}}})
    df = spark.createDataFrame([(1, cal)], "nid long, text string")
    both = J.calendar_rows(df, "text", "nid", True).unionByName(J.calendar_rows(df, "text", "nid", False))
    assert sorted(r.is_points for r in both.collect()) == [False, True]


def test_hotel_url_join(spark):
    df = spark.createDataFrame([("https://a.com/", "/hotel/x"), ("https://a.com", "hotel/x"), ("https://a.com//", "//hotel/x")],
                               "site string, path string")
    assert {r.u for r in df.select(hotel_url("site", "path").alias("u")).collect()} == {"https://a.com/hotel/x"}


def test_hotel_columns_fixed_order(spark):
    df = spark.createDataFrame([(1, "H", "u", 350, 7)], "nid long, name string, url string, choice_points int, synxis_id int")
    out = flatten_hotels(df)
    assert out.columns == ["nid", "name", "url", "canonical_url", "code", "num_rooms", "country", "title", "description",
                           "choice_points", "average_rate", "synxis_id", "book_with_points", "book_with_choice"]
    r = out.collect()[0]
    assert r.choice_points == "350" and r.synxis_id == "7"


def test_html_first_link_per_container(spark):
    html = ('<ul><li class="c"><a href="/h1" title="  Hotel &amp; Spa ">x</a><a href="/h1b">y</a></li>'
            '<li>no link here</li><li><a title="T">no href</a></li></ul>')
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    out = H.hotel_links(pages).orderBy("_idx").collect()
    assert [(r.has_link, r.path, r.title) for r in out] == [(True, "/h1", "Hotel & Spa"), (False, "", ""), (True, "", "T")]


def test_embedded_script_counts(spark):
    one = '<script>var a=1;</script><script id="d">track(42)</script>'
    none = "<script>var a=1;</script>"
    two = "<script>track(1)</script><script>track(2)</script>"
    pages = spark.createDataFrame([(1, one), (2, none), (3, two)], "page_id long, html string")
    marked = H.embedded_script(pages)
    out = {r.page_id: (r.n_marked, r.payload) for r in marked.collect()}
    assert out == {1: (1, "42"), 2: (0, None), 3: (2, None)}
    assert H.require_one(marked.filter("page_id = 1")).select("page_id").count() == 1
    for k in (2, 3):  # the check holds whatever columns are kept
        with pytest.raises(PySparkException):
            H.require_one(marked.filter(F.col("page_id") == k)).select("page_id").collect()


def test_request_params_drop_unset_and_iso_dates():
    p = J.request_params(source="aeroplan", cabin=None, start_date=dt.date(2032, 11, 8), end_date=None, take=5000)
    assert p == {"source": "aeroplan", "start_date": "2032-11-08", "take": 5000}


def test_numeric_entities_and_plain_values(spark):
    html = '<ul><li><a href="/caf&#233;?a=1&amp;b=2" title="Caf&#xE9; &lt;1&gt;">x</a></li><li><a href="/plain" title="Plain">y</a></li></ul>'
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    out = H.hotel_links(pages).orderBy("_idx").collect()
    assert [(r.path, r.title) for r in out] == [("/café?a=1&b=2", "Café <1>"), ("/plain", "Plain")]
