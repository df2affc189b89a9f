"""Queries: sources and hotel shaping."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakefold.operators.shape import flatten_hotel_availability, flatten_hotels, hotel_url
from lakefold.plans import derive
from lakefold.plans.catalog import register
from lakefold.sources import html as H
from lakefold.sources import json_pages as J

EVENT_RECORD = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
EVENT_PAGE = T.StructType(
    [
        T.StructField("data", T.ArrayType(EVENT_RECORD)),
        T.StructField("count", T.IntegerType()),
        T.StructField("hasMore", T.BooleanType()),
        T.StructField("moreURL", T.StringType()),
        T.StructField("cursor", T.LongType()),
    ]
)


# --- S1: page objects -> records ---------------------------------------------
@register(
    "s1_page_reader",
    """SELECT event_id // 500 AS page, (event_id // 500) * 500 AS cursor,
              (event_id // 500) < (SELECT max(event_id // 500) FROM events) AS has_more,
              CAST(count(*) OVER (PARTITION BY event_id // 500) AS INTEGER) AS declared,
              event_id, user_id, event_type, value, CAST(json_extract(props, '$.k') AS INTEGER) AS k
       FROM events""",
)
def s1_page_reader(spark, sf_dir):
    pages = J.parse_pages(derive.page_texts(spark, sf_dir), "text", EVENT_PAGE)
    recs = J.page_records(pages, "page")
    return recs.select(
        F.col("_page").alias("page"),
        (F.col("_page") * 500).alias("cursor"),
        F.col("_has_more").alias("has_more"),
        F.col("_declared").alias("declared"),
        "event_id", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


# --- S2: route array reader ----------------------------------------------------
@register(
    "s2_route_reader",
    """SELECT 'route-' || CAST(n_nationkey AS VARCHAR) AS ID, n_name AS OriginAirport, r_name AS OriginRegion,
              n_name AS DestinationAirport, r_name AS DestinationRegion, CAST(n_nationkey AS INTEGER) AS NumDaysOut,
              CAST(n_regionkey * 1000 AS INTEGER) AS Distance, 'aeroplan' AS Source
       FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def s2_route_reader(spark, sf_dir):
    # nation/region are fixed-size dimensions (25/5 rows): one array per region
    nation = derive.table(spark, sf_dir, "nation")
    region = F.broadcast(derive.table(spark, sf_dir, "region"))
    route = F.struct(
        F.concat(F.lit("route-"), F.col("n_nationkey").cast("string")).alias("ID"),
        F.col("n_name").alias("OriginAirport"), F.col("r_name").alias("OriginRegion"),
        F.col("n_name").alias("DestinationAirport"), F.col("r_name").alias("DestinationRegion"),
        F.col("n_nationkey").cast("int").alias("NumDaysOut"), (F.col("n_regionkey") * 1000).cast("int").alias("Distance"),
        F.lit("aeroplan").alias("Source"),
    )
    landed = nation.join(region, nation.n_regionkey == region.r_regionkey).groupBy("r_regionkey").agg(
        F.to_json(F.collect_list(route)).alias("text")
    )
    return J.routes(landed, "text")


# --- S3: open-record trips, envelope unwrap ---------------------------------------
@register(
    "s3_trip_reader",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
              CASE WHEN event_type IN ('click', 'view') THEN 'wrapped'
                   WHEN event_type = 'purchase' THEN 'empty_data' ELSE 'object' END AS shape
       FROM events""",
)
def s3_trip_reader(spark, sf_dir):
    ev = derive.table(spark, sf_dir, "events")
    text = (
        F.when(F.col("event_type").isin("click", "view"), F.concat(F.lit('{"data":['), F.col("props"), F.lit("]}")))
        .when(F.col("event_type") == "purchase", F.concat(F.lit('{"data":[],'), F.expr("substring(props, 2)")))
        .otherwise(F.col("props"))
    )
    trip = J.unwrap_trip(text)
    shape = (
        F.when(F.col("event_type").isin("click", "view"), F.lit("wrapped"))
        .when(F.col("event_type") == "purchase", F.lit("empty_data"))
        .otherwise(F.lit("object"))
    )
    return ev.select("event_id", J.trip_field(trip, "k", "int").alias("k"), shape.alias("shape"))


# --- S5: directory containers -> first link ------------------------------------------
_LINKS_SQL = r"""
WITH c AS (
  SELECT page_id,
         unnest(regexp_extract_all(html, '(?s)<li\b[^>]*>(.*?)</li>', 1)) AS inner_html,
         unnest(range(len(regexp_extract_all(html, '(?s)<li\b[^>]*>(.*?)</li>', 1)))) AS link_pos
  FROM pages),
a AS (SELECT page_id, link_pos, regexp_extract(inner_html, '(?s)<a\b[^>]*>', 0) AS anchor FROM c)
SELECT page_id, CAST(link_pos AS INTEGER) AS link_pos, anchor <> '' AS has_link,
       regexp_extract(anchor, '\bhref\s*=\s*"([^"]*)"', 1) AS path,
       regexp_replace(regexp_extract(anchor, '\btitle\s*=\s*"([^"]*)"', 1), '^\s+|\s+$', '', 'g') AS title
FROM a
"""


@register("s5_hotel_links", _LINKS_SQL)
def s5_hotel_links(spark, sf_dir):
    links = H.hotel_links(derive.table(spark, sf_dir, "pages").select("page_id", "html"))
    return links.select("page_id", F.col("_idx").alias("link_pos"), "has_link", "path",
                        F.regexp_replace("title", r"^\s+|\s+$", "").alias("title"))


# --- S6: embedded marked script -----------------------------------------------------
@register(
    "s6_embedded_script",
    r"""SELECT page_id,
              CAST(len(list_filter(regexp_extract_all(html, '(?s)<script\b[^>]*>(.*?)</script>', 1),
                                   lambda s: regexp_matches(s, 'track\((\d+)\)'))) AS INTEGER) AS n_marked,
              CAST(regexp_extract(html, 'track\((\d+)\)', 1) AS BIGINT) AS payload
       FROM pages""",
)
def s6_embedded_script(spark, sf_dir):
    out = H.embedded_script(derive.table(spark, sf_dir, "pages").select("page_id", "html"))
    return out.select("page_id", "n_marked", F.col("payload").cast("bigint").alias("payload"))


# --- J7: link -> detail page lookup (missing pages are rejects) ---------------------------
@register(
    "j7_link_page_lookup",
    """WITH t AS (SELECT url, min(page_id) AS target_id FROM pages WHERE page_id % 7 <> 0 GROUP BY url)
       SELECT p.url, t.target_id, t.target_id IS NULL AS rejected FROM pages p LEFT JOIN t ON p.url = t.url""",
)
def j7_link_page_lookup(spark, sf_dir):
    """Directory pages (fifty links each) against the landed pages, of which
    every seventh is missing: the whole URL is the key, a URL that landed
    more than once is one target, and links without a page are rejects."""
    pages = derive.table(spark, sf_dir, "pages").select("page_id", "url")
    item = F.concat(F.lit('<li><a href="'), F.col("url"), F.lit('" title="t">x</a></li>'))
    directory = pages.groupBy(F.expr("page_id div 50").alias("page_id")).agg(F.concat_ws("", F.collect_list(item)).alias("html"))
    links = H.hotel_links(directory.select("page_id", "html")).filter("has_link").select(F.col("path").alias("url"))
    targets = pages.filter("page_id % 7 <> 0").groupBy("url").agg(F.min("page_id").alias("target_id"))
    return links.join(targets, "url", "left").select("url", "target_id", F.col("target_id").isNull().alias("rejected"))


# --- S7 / P3 / P6 / P9: rate calendars -> hotel availability rows -------------------------
_DAILY_SQL = """
SELECT user_id, event_type = 'purchase' AS is_points, strftime(ts, '%Y-%m-%d') AS day,
       min(value) AS lo, count(*) FILTER (WHERE event_type <> 'error') AS ok
FROM events GROUP BY ALL
"""
_AVAIL_SQL = f"""
SELECT CAST(user_id AS BIGINT) AS nid, CASE WHEN is_points THEN NULL ELSE 'USD' END AS currency_code,
       day AS date, is_points, CASE WHEN is_points THEN NULL ELSE lo END AS lowest_rate,
       CASE WHEN is_points THEN CAST(floor(lo * 100) AS INTEGER) END AS lowest_points_rate, ok > 0 AS available
FROM ({_DAILY_SQL})
"""


def hotel_availability_rows(spark, sf_dir):
    cals = derive.calendar_texts(spark, sf_dir)
    return flatten_hotel_availability(J.calendar_rows(cals, "text", "nid", F.col("is_points")))


@register("s7_rate_calendar", _AVAIL_SQL)
def s7_rate_calendar(spark, sf_dir):
    return hotel_availability_rows(spark, sf_dir)


@register(
    "a5_count_reconciliation",
    """SELECT count(*) AS calendars, count(*) FILTER (WHERE days <> n) AS mismatched FROM (
         SELECT user_id, event_type = 'purchase' AS p, count(*) AS n, count(DISTINCT strftime(ts, '%Y-%m-%d')) AS days
         FROM events GROUP BY ALL)""",
)
def a5_count_reconciliation(spark, sf_dir):
    """A5: actual rows per calendar vs its declared count (warn-only rows).
    These calendars declare their events, so days with several do not add up."""
    cals = derive.calendar_texts(spark, sf_dir, declare_events=True)
    rows = J.calendar_rows(cals, "text", "nid", F.col("is_points"))
    per = rows.groupBy("nid", "is_points").agg(F.count(F.lit(1)).alias("actual"), F.max("_declared").alias("declared"))
    return per.agg(F.count(F.lit(1)).alias("calendars"), F.count_if(F.col("actual") != F.col("declared")).alias("mismatched"))


# --- P2 / P7: hotels (14 columns, order pinned) ---------------------------------------------
_HOTELS_SQL = """
SELECT s_suppkey AS nid, s_name AS name, 'https://hotels.example.com/hotel/' || CAST(s_suppkey AS VARCHAR) AS url,
       'https://hotels.example.com/hotel/' || CAST(s_suppkey AS VARCHAR) AS canonical_url,
       'H' || CAST(s_suppkey AS VARCHAR) AS code, CAST(s_nationkey * 10 + 5 AS INTEGER) AS num_rooms,
       n_name AS country, s_name AS title, CAST(NULL AS VARCHAR) AS description,
       CAST(s_nationkey AS VARCHAR) AS choice_points, '$' || CAST(CAST(floor(s_acctbal) AS BIGINT) AS VARCHAR) AS average_rate,
       CAST(s_suppkey AS VARCHAR) AS synxis_id, s_acctbal > 0 AS book_with_points, s_nationkey % 2 = 0 AS book_with_choice
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
"""


@register("p2_flatten_hotels", _HOTELS_SQL)
def p2_flatten_hotels(spark, sf_dir):
    return flatten_hotels(derive.hotel_details(spark, sf_dir))


# --- P4: hotel URL join ----------------------------------------------------------------
@register(
    "p4_hotel_url",
    r"""SELECT page_id, rtrim(regexp_extract(url, '^(https?://[^/]+/*)', 1), '/') || '/' ||
              ltrim(regexp_replace(url, '^https?://[^/]+', ''), '/') AS joined
       FROM pages""",
)
def p4_hotel_url(spark, sf_dir):
    pages = derive.table(spark, sf_dir, "pages")
    site = F.regexp_extract("url", r"^(https?://[^/]+/*)", 1)
    path = F.regexp_replace("url", r"^https?://[^/]+", "")
    return pages.select("page_id", hotel_url(site, path).alias("joined"))


# --- S8: column-projected scan of the hotel key ------------------------------------------
@register("s8_projected_scan", "SELECT s_suppkey AS nid FROM supplier")
def s8_projected_scan(spark, sf_dir):
    return derive.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("nid"))


# --- P8: numeric text with '' allowed ----------------------------------------------------
@register(
    "p8_numeric_text",
    """SELECT l_returnflag, count(*) AS n, count(c) AS parsed, CAST(sum(c) AS BIGINT) AS total
       FROM (SELECT l_returnflag, TRY_CAST(NULLIF(trim(CASE WHEN l_returnflag = 'R' THEN '' ELSE
                    CAST(CAST(l_quantity * 1000 AS INTEGER) AS VARCHAR) END), '') AS INTEGER) AS c FROM lineitem)
       GROUP BY l_returnflag""",
)
def p8_numeric_text(spark, sf_dir):
    from lakefold.operators.shape import numeric_text

    li = derive.table(spark, sf_dir, "lineitem")
    text = F.when(F.col("l_returnflag") == "R", F.lit("")).otherwise((F.col("l_quantity") * 1000).cast("int").cast("string"))
    c = numeric_text(text)
    return li.select("l_returnflag", c.alias("c")).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count("c").alias("parsed"), F.sum("c").alias("total")
    )


# --- S9: SQL over a path (table function style) -------------------------------------------
@register("s9_sql_path_scan", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority")
def s9_sql_path_scan(spark, sf_dir):
    from lakefold.plans.sqlrun import run_sql

    df, _ = run_sql(spark, f"SELECT o_orderpriority, count(*) AS n FROM parquet.`{sf_dir}/orders.parquet` GROUP BY o_orderpriority")
    return df
