"""Queries of the hotel path over landed sources.

The sources are derived from ``pages`` and ``events``: every page gets a data
script with a hotel's JSON next to its own scripts, some of them faulty, and
a place in a directory of fifty links a page; every user's events are a
hotel's rate calendars.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from lakefold import schemas as S
from lakefold.plans import derive
from lakefold.plans.catalog import register
from lakefold.plans.jobs import LINK_BOX, PAGE_DATA, hotel_links, run_hotel_ingest, scratch_dir
from lakefold.plans.q_sources import _AVAIL_SQL
from lakefold.sources import html as H
from lakefold.sources import json_pages as J
from lakefold.storage.table import ArchiveTable

SITE = "https://hotels.example.com/"
# Which pages are faulty, in the order in which the job finds out.
_OUTCOME = """CASE WHEN page_id % 7 = 0 THEN 'missing:page' WHEN page_id % 11 = 0 THEN 'scripts:0' WHEN page_id % 13 = 0 THEN 'scripts:2'
  WHEN page_id % 17 = 0 THEN 'json' WHEN page_id % 19 = 0 THEN 'missing:nid' WHEN page_id % 23 = 0 THEN 'type:num_rooms'
  WHEN page_id % 29 = 0 THEN 'type:book_with_choice' ELSE 'stored' END"""


def hotel_pages(spark, sf_dir):
    """(page_id, url, html): the landed hotel pages."""
    pages = derive.table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("own"), F.col("url").alias("from"))
    n = F.col("page_id")
    content = F.struct(
        F.when(n % 19 != 0, n).alias("nid"), F.concat(F.lit("Hotel "), n.cast("string")).alias("fieldDisplayTitle"),
        F.concat(F.lit("H"), n.cast("string")).alias("fieldItemCode"),
        F.when(n % 23 == 0, F.lit("many")).otherwise((n * 3).cast("string")).alias("fieldNumRooms"),
        F.when(n % 2 == 0, F.lit("Norway")).alias("fieldCountryName"), (n % 40 * 1000).alias("choicePointsValue"),
        (n % 5 == 0).alias("fieldIPreferBookWithPoints"))
    page = F.struct(F.struct(F.struct(
        content.alias("nodeContent"), F.when(n % 3 != 0, F.struct(F.col("from").alias("canonical_url"), F.lit("A & B").alias("title"))).alias("metaTags")
    ).alias("pageProps")).alias("props"))
    text = F.to_json(page)
    text = F.when(n % 29 == 0, F.replace(text, F.lit("\"fieldIPreferBookWithPoints\""), F.lit("\"participatesInChoicePoints\":\"perhaps\",\"x\""))).otherwise(text)
    text = F.when(n % 17 == 0, F.concat(F.lit("{"), text)).otherwise(text)
    tags = F.element_at(F.array(*map(F.lit, ("<script id=\"__NEXT_DATA__\" type=\"application/json\">", "<SCRIPT type=x ID = '__NEXT_DATA__' defer>",
                                              "<script\nid=__NEXT_DATA__>"))), (n % 3 + 1).cast("int"))
    script = F.concat(tags, text, F.lit("</script>"))
    script = F.when(n % 11 == 0, F.lit("<script data-id=\"__NEXT_DATA__\">{}</script>")).when(n % 13 == 0, F.concat(script, script)).otherwise(script)
    html = F.replace(F.col("own"), F.lit("</head>"), F.concat(script, F.lit("</head>")))
    return pages.select("page_id", F.concat(F.lit(SITE), F.lit("p/"), n.cast("string")).alias("url"), html.alias("html"))


def directory_pages(spark, sf_dir):
    """(html): directory pages, of fifty links each."""
    n = F.col("page_id").cast("string")
    quote = F.element_at(F.array(F.lit("\""), F.lit("'")), (F.col("page_id") % 2 + 1).cast("int"))
    link = F.concat(F.lit(f"<div class=\"wide {LINK_BOX}\"><span>no link</span><a\n title = "), quote, F.lit(" Hotel &amp; Spa "), n, quote,
                    F.lit(" href="), quote, F.lit("/p/"), n, quote, F.lit(">more</a><a href='/other'>other</a></div>"))
    pages = derive.table(spark, sf_dir, "pages").select(F.expr("page_id div 50").alias("nr"), link.alias("link"))
    other = f"<div class={LINK_BOX}><b>sold out</b></div><div class='x{LINK_BOX}'><a href='/wrong'>wrong</a></div>"
    return pages.groupBy("nr").agg(F.concat_ws("", F.collect_list("link"), F.lit(other)).alias("html")).drop("nr")


@register("s5_directory_links", f"SELECT '{SITE}p/' || page_id AS url, 'Hotel & Spa ' || page_id AS title FROM pages")
def s5_directory_links(spark, sf_dir):
    """Links of containers by class, with attributes in any quotes."""
    return hotel_links(directory_pages(spark, sf_dir), SITE)


_SCRIPTS = "CASE WHEN page_id % 11 = 0 THEN 0 WHEN page_id % 13 = 0 THEN 2 ELSE 1 END"


@register(
    "s6_hotel_details",
    f"""SELECT page_id, n, CASE WHEN n <> 1 OR page_id % 17 = 0 OR page_id % 19 = 0 THEN NULL ELSE page_id END AS nid,
              CASE WHEN n = 1 AND page_id % 17 <> 0 THEN 'Hotel ' || page_id END AS name,
              CASE WHEN n = 1 AND page_id % 17 <> 0 AND page_id % 3 <> 0 THEN url END AS canonical_url,
              CASE WHEN n = 1 AND page_id % 17 <> 0 AND page_id % 3 <> 0 THEN 'A & B' END AS title,
              CASE WHEN n = 1 AND page_id % 17 <> 0 AND page_id % 23 <> 0 THEN CAST(page_id * 3 AS INTEGER) END AS num_rooms,
              CASE WHEN n = 1 AND page_id % 17 <> 0 THEN CAST(page_id % 40 * 1000 AS VARCHAR) END AS choice_points,
              CASE WHEN n = 1 AND page_id % 17 <> 0 AND page_id % 29 <> 0 THEN page_id % 5 = 0 END AS book_with_points
       FROM (SELECT *, {_SCRIPTS} AS n FROM pages)""",
)
def s6_hotel_details(spark, sf_dir):
    """JSON of the one script with the right id, looked up with defaults."""
    script = H.marked_script(hotel_pages(spark, sf_dir), "html", *PAGE_DATA).drop("html")
    out = J.hotel_details(script, "script")
    return out.select("page_id", F.col("n_marked").alias("n"), "nid", "name", "canonical_url", "title", "num_rooms", "choice_points", "book_with_points")


@register(
    "p5_hotel_reasons",
    f"SELECT reason, count(*) AS rows FROM (SELECT {_OUTCOME.replace(chr(39) + 'missing:page' + chr(39), chr(39) + 'stored' + chr(39))} AS reason FROM pages WHERE page_id % 7 <> 0) GROUP BY reason",
)
def p5_hotel_reasons(spark, sf_dir):
    """Why hotel pages are rejected: scripts, JSON, missing and wrong values."""
    script = H.marked_script(hotel_pages(spark, sf_dir).filter("page_id % 7 <> 0"), "html", *PAGE_DATA).drop("html")
    out = J.hotel_details(script, "script")
    reason = F.when(F.col("n_marked") != 1, F.concat(F.lit("scripts:"), F.col("n_marked").cast("string"))).otherwise(
        F.coalesce(F.try_element_at("_reasons", F.lit(1)), F.lit("stored")))
    return out.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("rows"))


_CAL_FAULT = """CASE user_id % 8 WHEN 1 THEN 'missing:count' WHEN 2 THEN 'type:results' WHEN 3 THEN 'type:results[].lowestRate'
  WHEN 4 THEN 'type:results[].available' WHEN 5 THEN 'json' ELSE 'valid' END"""


def faulty_calendars(spark, sf_dir):
    """Every user's calendars; those of most users have some fault."""
    cals = derive.calendar_texts(spark, sf_dir)
    n, text = F.col("nid") % 8, F.col("text")
    text = (F.when(n == 1, F.regexp_replace(text, r'"count":[0-9]+,', ""))
            .when(n == 2, F.regexp_replace(text, r'"results":\{.*\}\}$', '"results":["2001-01-01"]}'))
            .when(n == 3, F.regexp_replace(text, r'\{"(lowestRate|lowestPointsRate)":[-0-9.E]+', '{"lowestRate":"n/a"'))
            .when(n == 4, F.regexp_replace(text, r'"available":(true|false)\}\}\}$', '"available":"maybe"}}}'))
            .when(n == 5, F.substring(text, 1, 20)).otherwise(text))
    return cals.withColumn("text", text)


@register("p5_calendar_reasons", f"""SELECT reason, count(*) AS rows FROM (
    SELECT DISTINCT user_id, event_type = 'purchase' AS is_points, {_CAL_FAULT} AS reason FROM events) GROUP BY reason""")
def p5_calendar_reasons(spark, sf_dir):
    """Why rate calendars are rejected, by rules over all their days."""
    cals = faulty_calendars(spark, sf_dir).withColumn("_reasons", J.calendar_reasons(F.col("text")))
    reason = F.explode(F.when(F.size("_reasons") == 0, F.array(F.lit("valid"))).otherwise(F.col("_reasons")))
    return cals.select(reason.alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


@register(
    "k9_hotel_pages",
    f"""SELECT page_id, outcome, CASE WHEN outcome = 'stored' THEN coalesce(days, 0) ELSE 0 END AS days
        FROM (SELECT page_id, {_OUTCOME} AS outcome FROM pages)
        LEFT JOIN (SELECT nid, count(*) AS days FROM ({_AVAIL_SQL}) WHERE nid % 8 NOT IN (1, 2, 3, 4, 5) GROUP BY nid) ON nid = page_id""",
)
def k9_hotel_pages(spark, sf_dir):
    """The whole hotel job over landed sources: what became of each link, and
    how many days of rates were stored for it."""
    root = scratch_dir(spark, "hotel-pages")
    landed = hotel_pages(spark, sf_dir).filter("page_id % 7 <> 0").select("url", "html")
    run_hotel_ingest(spark, directory_pages(spark, sf_dir), landed, faulty_calendars(spark, sf_dir), root, SITE,
                     _dt.datetime(2025, 1, 1, tzinfo=_dt.timezone.utc))
    days = ArchiveTable(spark, f"{root}/hotel_availability").current(["nid"]).groupBy("nid").agg(F.count(F.lit(1)).alias("days"))
    stored = ArchiveTable(spark, f"{root}/hotels").current(["nid", "url"]).join(days, "nid", "left")
    stored = stored.select("url", F.lit("stored").alias("outcome"), F.coalesce("days", F.lit(0)).alias("days"))
    rejects = spark.read.schema(S.T.StructType([S.T.StructField("url", S.T.StringType()), S.T.StructField("_reasons", S.T.ArrayType(S.T.StringType()))])
                                ).parquet(f"{root}/rejects").filter("url IS NOT NULL")
    rejects = rejects.select("url", F.element_at("_reasons", 1).alias("outcome"), F.lit(0).cast("long").alias("days"))
    both = stored.unionByName(rejects)
    return both.select(F.regexp_extract("url", "([0-9]+)$", 1).cast("long").alias("page_id"), "outcome", "days")


_ROUTE_FAULT = """CASE (c_custkey // 20) % 7 WHEN 1 THEN 'missing:routes[].Distance' WHEN 2 THEN 'type:routes[].NumDaysOut' WHEN 3 THEN 'type:routes'
  WHEN 4 THEN 'json' WHEN 5 THEN 'type:routes[].OriginAirport' ELSE 'valid' END"""


@register("p5_route_reasons", f"""SELECT reason, count(*) AS pages, CAST(sum(n) AS BIGINT) AS routes FROM (
    SELECT c_custkey // 20 AS page, {_ROUTE_FAULT} AS reason, count(*) AS n FROM customer GROUP BY ALL) GROUP BY reason""")
def p5_route_reasons(spark, sf_dir):
    """Pages of twenty routes: one bad route rejects its page; the routes that go with it are counted."""
    c = derive.table(spark, sf_dir, "customer")
    page, first = F.expr("c_custkey div 20"), F.col("c_custkey") % 20 == 7
    fault = page % 7
    route = F.struct(
        F.concat(F.lit("route-"), F.col("c_custkey").cast("string")).alias("ID"), F.col("c_name").alias("OriginAirport"),
        F.col("c_mktsegment").alias("OriginRegion"), F.col("c_name").alias("DestinationAirport"), F.lit("DOMESTIC").alias("DestinationRegion"),
        F.col("c_nationkey").cast("int").alias("NumDaysOut"), F.when(~(first & (fault == 1)), F.col("c_nationkey") * 100).alias("Distance"),
        F.lit("aeroplan").alias("Source"))
    text = F.to_json(route)
    text = (F.when(first & (fault == 2), F.regexp_replace(text, '"NumDaysOut":[0-9]+', '"NumDaysOut":"soon"'))
            .when(first & (fault == 5), F.regexp_replace(text, '"OriginAirport":"[^"]*"', '"OriginAirport":12')).otherwise(text))
    # Twenty routes a page at most.
    landed = c.select(page.alias("page"), fault.alias("fault"), text.alias("t")).groupBy("page", "fault").agg(
        F.concat(F.lit("["), F.concat_ws(",", F.collect_list("t")), F.lit("]")).alias("text"), F.count(F.lit(1)).alias("n"))
    text = F.when(F.col("fault") == 3, F.concat(F.lit('{"data":'), "text", F.lit("}"))).when(
        F.col("fault") == 4, F.expr("substring(text, 1, length(text) - 3)")).otherwise(F.col("text"))
    told = landed.select("n", J.route_reasons(text).alias("r"))
    reason = F.explode(F.when(F.size("r") == 0, F.array(F.lit("valid"))).otherwise(F.col("r")))
    return told.select("n", reason.alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("pages"), F.sum("n").alias("routes"))
