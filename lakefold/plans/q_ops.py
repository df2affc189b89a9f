"""Queries: predicates and paging (S4, F1-F16), validation (P5, F9), fold
(W1-W5), statistics (A2-A4, A7, A8), set operations (U1-U3), joins (J5, J6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakefold import schemas as S
from lakefold.functions.hashing import with_content_hash
from lakefold.operators import fold, select, stats
from lakefold.operators.merge import dedup_latest
from lakefold.operators.shape import flatten_availability
from lakefold.operators.validate import availability_rules, check_programs, validate
from lakefold.plans import derive
from lakefold.plans import oracle as O
from lakefold.plans.catalog import register
from lakefold.plans.q_sources import _AVAIL_SQL, _HOTELS_SQL, hotel_availability_rows
from lakefold.sources import json_pages as J

FLAT = O.availability_flat_sql(None)


def flat(spark, sf_dir):
    return flatten_availability(derive.availability_records(spark, sf_dir))


def _ids(df):
    return df.select("ID")


# --- S4 / F1-F8: search predicates on the flat table ----------------------------
@register("f1_date_range", f"SELECT ID FROM ({FLAT}) WHERE Date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'")
def f1_date_range(spark, sf_dir):
    return _ids(select.search(flat(spark, sf_dir), start_date="1996-01-01", end_date="1996-12-31"))


@register("f2_cabin", f"SELECT ID FROM ({FLAT}) WHERE JAvailable")
def f2_cabin(spark, sf_dir):
    return _ids(select.search(flat(spark, sf_dir), cabins=["business"]))


@register("f3_program", f"SELECT ID FROM ({FLAT}) WHERE Source IN ('aeroplan', 'united')")
def f3_program(spark, sf_dir):
    return _ids(select.search(flat(spark, sf_dir), sources=["aeroplan", "united"]))


@register("f4_region", f"SELECT ID FROM ({FLAT}) WHERE OriginRegion = 'EUROPE' AND DestinationRegion = 'DOMESTIC'")
def f4_region(spark, sf_dir):
    return _ids(select.search(flat(spark, sf_dir), origin_region="EUROPE", destination_region="DOMESTIC"))


@register(
    "f5_airports",
    f"SELECT ID FROM ({FLAT}) WHERE OriginAirport IN ('NATION_1', 'NATION_2') AND DestinationAirport = 'MACHINERY'",
)
def f5_airports(spark, sf_dir):
    return _ids(select.search(flat(spark, sf_dir), origin=["NATION_1", "NATION_2"], destination="MACHINERY"))


@register(
    "f6_direct_carriers",
    f"""SELECT ID FROM ({FLAT}) WHERE YAvailable AND YDirect
        AND len(list_intersect(list_transform(string_split(YAirlines, ','), lambda x: trim(x)), ['S7', 'S42', 'S77'])) > 0""",
)
def f6_direct_carriers(spark, sf_dir):
    return _ids(select.search(flat(spark, sf_dir), cabins=["economy"], only_direct=True, carriers=["S7", "S42", "S77"]))


_FLIES = "len(list_intersect(list_transform(string_split({c}Airlines, ','), lambda x: trim(x)), ['S3', 'S8', 'S21', 'S55'])) > 0"


@register("s4_carriers_alone", f"SELECT ID FROM ({FLAT}) WHERE {' OR '.join(_FLIES.format(c=c) for c in S.CABINS)}")
def s4_carriers_alone(spark, sf_dir):
    """Carriers without a cabin: any cabin may fly them."""
    return _ids(select.search(flat(spark, sf_dir), carriers=["S3", "s8", "S21", "S55"]))


_CABINS_DIRECT = " OR ".join(f"({c}Available AND {c}Direct AND {_FLIES.format(c=c)})" for c in ("Y", "J"))


@register(
    "s4_search_paged",
    f"""SELECT ID, strftime(Date, '%Y-%m-%d') AS day FROM ({FLAT}) WHERE ({_CABINS_DIRECT}) AND Date >= DATE '1994-01-01'
        ORDER BY Date, ID LIMIT 20 OFFSET 5""",
)
def s4_search_paged(spark, sf_dir):
    """Several cabins, direct flights and carriers together (one cabin must meet all three), ordered and paged."""
    out = select.search(flat(spark, sf_dir), cabins=["economy", "business"], only_direct=True, carriers=["S3", "S8", "S21", "S55"],
                        start_date="1994-01-01", order_by=["Date", "ID"], skip=5, take=20)
    return out.select("ID", F.date_format("Date", "yyyy-MM-dd").alias("day"))


@register("f7_raw_values", f"SELECT ID, FMileageCostRaw AS miles FROM ({FLAT}) WHERE FAvailableRaw")
def f7_raw_values(spark, sf_dir):
    df = select.search(flat(spark, sf_dir), cabins=["first"], include_filtered=False)
    return df.select("ID", F.col(select.cabin_column("first", "MileageCost", False)).alias("miles"))


@register("f8_optional_args", f"SELECT ID FROM ({FLAT}) WHERE Date >= DATE '2000-06-01' AND Source = 'alaska'")
def f8_optional_args(spark, sf_dir):
    return _ids(select.search(flat(spark, sf_dir), origin=None, destination=None, start_date="2000-06-01", end_date=None,
                              sources=["alaska"], carriers=None))


# --- F9: program names, any case -> canonical or reject ----------------------------
_PROGRAM_IN = ", ".join(f"'{p}'" for p in S.PROGRAMS)


@register(
    "f9_program_check",
    f"""SELECT raw, CASE WHEN lower(trim(raw)) IN ({_PROGRAM_IN}) THEN lower(trim(raw)) END AS program,
               count(*) AS rows, count(*) FILTER (WHERE lower(trim(raw)) NOT IN ({_PROGRAM_IN})) AS errors
        FROM (SELECT CASE WHEN TaxesCurrency = 'USD' THEN upper(Source) ELSE Source END AS raw FROM ({FLAT}))
        GROUP BY ALL""",
)
def f9_program_check(spark, sf_dir):
    recs = derive.availability_records(spark, sf_dir)
    raw = F.when(F.col("TaxesCurrency") == "USD", F.upper("Source")).otherwise(F.col("Source"))
    checked = check_programs(recs.select(raw.alias("raw")), "raw")
    return checked.groupBy("raw", "program").agg(
        F.count(F.lit(1)).alias("rows"), F.count("program_error").alias("errors")
    )


# --- P5: record validation against the rule table --------------------------------------
@register(
    "p5_validate_availability",
    f"""SELECT CASE WHEN lower(Source) IN ({_PROGRAM_IN}) THEN 'valid' ELSE 'value:Source' END AS reason, count(*) AS rows
        FROM ({FLAT}) GROUP BY ALL""",
)
def p5_validate_availability(spark, sf_dir):
    checked = validate(derive.availability_records(spark, sf_dir), availability_rules())
    reasons = F.when(F.size("_reasons") == 0, F.array(F.lit("valid"))).otherwise(F.col("_reasons"))
    return checked.select(F.explode(reasons).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


# --- F10 / U2: points or cash, and their union ---------------------------------------------
@register("f10_points_cash", f"SELECT is_points, count(*) AS rows FROM ({_AVAIL_SQL}) WHERE is_points GROUP BY ALL")
def f10_points_cash(spark, sf_dir):
    rows = hotel_availability_rows(spark, sf_dir)
    return rows.filter(F.col("is_points").isin([True])).groupBy("is_points").agg(F.count(F.lit(1)).alias("rows"))


@register("u2_points_union_cash", f"SELECT is_points, count(*) AS rows, CAST(sum(lowest_points_rate) AS BIGINT) AS pts FROM ({_AVAIL_SQL}) GROUP BY ALL")
def u2_points_union_cash(spark, sf_dir):
    rows = hotel_availability_rows(spark, sf_dir)
    both = rows.filter("is_points").unionByName(rows.filter("NOT is_points"))
    return both.groupBy("is_points").agg(F.count(F.lit(1)).alias("rows"), F.sum("lowest_points_rate").alias("pts"))


@register("p6_empty_calendars", f"""SELECT nid, count(date) AS days FROM (
    SELECT u.nid, a.date FROM (SELECT DISTINCT user_id AS nid FROM events) u LEFT JOIN ({_AVAIL_SQL}) a ON a.nid = u.nid AND u.nid % 3 <> 0) GROUP BY nid""")
def p6_empty_calendars(spark, sf_dir):
    """Calendars whose ``results`` is an empty list in place of a map have no days, and are no error."""
    cals = derive.calendar_texts(spark, sf_dir)
    empty = F.regexp_replace("text", r'"results":.*$', '"results":[]}')
    cals = cals.withColumn("text", F.when(F.col("nid") % 3 == 0, empty).otherwise(F.col("text")))
    cals = cals.withColumn("_reasons", J.calendar_reasons(F.col("text"))).filter(F.size("_reasons") == 0)
    rows = J.calendar_rows(cals, "text", "nid", F.col("is_points")).groupBy("nid").agg(F.count(F.lit(1)).alias("days"))
    return cals.select("nid").distinct().join(rows, "nid", "left").select("nid", F.coalesce("days", F.lit(0)).alias("days"))


@register(
    "q1_sql_report",
    """SELECT o_orderpriority, count(*) AS n, 5 AS rows FROM orders GROUP BY o_orderpriority ORDER BY n DESC, o_orderpriority LIMIT 3""",
)
def q1_sql_report(spark, sf_dir):
    """The first rows of a statement over a stored archive table, and how many it has."""
    from lakefold.plans.jobs import scratch_dir
    from lakefold.plans.sqlrun import run_sql_report
    from lakefold.storage.table import ArchiveTable

    t = ArchiveTable(spark, scratch_dir(spark, "report"))
    t.save(derive.table(spark, sf_dir, "orders"), "overwrite", partition_by=["o_orderpriority"])
    got = run_sql_report(spark, "SELECT o_orderpriority, count(*) AS n FROM archive GROUP BY 1 ORDER BY n DESC, 1", {"archive": t}, limit=3)
    rows = [(*r, got["rows"]) for r in got["data"]]
    return spark.createDataFrame(rows, "o_orderpriority string, n long, rows int")


# --- F11 / F15 / J6: first-N hotels, batches of 30, hotel x rate kind -------------------------
@register("f11_first_n_hotels", f"SELECT nid FROM ({_HOTELS_SQL}) ORDER BY nid LIMIT 30")
def f11_first_n_hotels(spark, sf_dir):
    from lakefold.operators.shape import flatten_hotels

    return select.first_n(flatten_hotels(derive.hotel_details(spark, sf_dir)), 30, ["nid"]).select("nid")


@register("f15_batches_of_30", "SELECT s_suppkey AS nid, (row_number() OVER (ORDER BY s_suppkey) - 1) // 30 + 1 AS batch FROM supplier")
def f15_batches_of_30(spark, sf_dir):
    sup = derive.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("nid"))
    return select.number_pages(sup, ["nid"], 30, col="batch")


@register("j6_hotel_rate_kinds", "SELECT s_suppkey AS nid, k AS is_points FROM supplier, (VALUES (true), (false)) t(k)")
def j6_hotel_rate_kinds(spark, sf_dir):
    sup = derive.table(spark, sf_dir, "supplier")
    # each hotel is asked for points and cash: a 2-element explode, no join
    return sup.select(F.col("s_suppkey").alias("nid"), F.explode(F.array(F.lit(True), F.lit(False))).alias("is_points"))


@register(
    "j5_hotel_semi_join",
    f"SELECT is_points, count(*) AS rows FROM ({_AVAIL_SQL}) WHERE nid IN (SELECT s_suppkey FROM supplier) GROUP BY ALL",
)
def j5_hotel_semi_join(spark, sf_dir):
    hotels = derive.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("nid"))  # S8: key column only
    rows = hotel_availability_rows(spark, sf_dir).join(hotels, "nid", "left_semi")
    return rows.groupBy("is_points").agg(F.count(F.lit(1)).alias("rows"))


# --- F12: offset paging -----------------------------------------------------------------
@register("f12_page_numbers", "SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 + 1 AS page FROM orders")
def f12_page_numbers(spark, sf_dir):
    orders = derive.table(spark, sf_dir, "orders").select("o_orderkey")
    return select.number_pages(orders, ["o_orderkey"], 1000)


@register("f12_one_page", "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 1000 OFFSET 2000")
def f12_one_page(spark, sf_dir):
    return select.page(derive.table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 2000, 1000)


# --- F13: page-chain cut ------------------------------------------------------------------
_PAGES_SQL = "SELECT event_type, event_id // 500 AS page, count(*) AS n_records, max(value) < 400 AS has_more FROM events GROUP BY ALL"


@register(
    "f13_page_chain_cut",
    f"""WITH p AS ({_PAGES_SQL}),
        c AS (SELECT event_type, least(min(CASE WHEN n_records = 0 THEN page - 1 END),
                                       min(CASE WHEN NOT has_more THEN page END)) AS cut FROM p GROUP BY event_type)
        SELECT p.event_type, page, n_records, has_more, page <= coalesce(cut, page) AND n_records > 0 AS kept
        FROM p JOIN c USING (event_type)""",
)
def f13_page_chain_cut(spark, sf_dir):
    ev = derive.table(spark, sf_dir, "events")
    pages = ev.groupBy("event_type", F.expr("event_id div 500").alias("page")).agg(
        F.count(F.lit(1)).alias("n_records"), (F.max("value") < 400).alias("has_more")
    )
    return select.cut_page_chain(pages, ["event_type"])


# --- F14 / F16: top-k and preview --------------------------------------------------------
@register("f14_top_orders", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def f14_top_orders(spark, sf_dir):
    o = derive.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return select.top_k(o, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10)


@register(
    "f16_preview",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
       FROM orders ORDER BY o_orderkey LIMIT 10""",
)
def f16_preview(spark, sf_dir):
    shown = select.preview(derive.table(spark, sf_dir, "orders"), ["o_orderkey"])
    return shown.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


# --- W1-W3: fold of all event pages in one job --------------------------------------------
_EV_KINDS = [("event_type", "str"), ("user_id", "int"), ("v", "int")]
_EV_SQL = f"""SELECT user_id, event_type, event_id // 500 AS page, event_id, ts,
                     CAST(CAST(json_extract(props, '$.k') AS INTEGER) // 25 AS INTEGER) AS v
              FROM events"""
_EV_LAST_SQL = f"""SELECT *, {O.hash_sql(_EV_KINDS)} AS content_hash FROM (
    SELECT * FROM ({_EV_SQL}) QUALIFY row_number() OVER (PARTITION BY user_id, event_type, page ORDER BY event_id DESC) = 1)"""
_EV_CHANGES_SQL = f"""SELECT *, CASE WHEN prev IS NULL THEN 'insert' ELSE 'update' END AS _change FROM (
    SELECT *, lag(content_hash) OVER (PARTITION BY user_id, event_type ORDER BY page) AS prev,
              row_number() OVER (PARTITION BY user_id, event_type ORDER BY page) AS rn FROM ({_EV_LAST_SQL}))
    WHERE rn = 1 OR prev IS DISTINCT FROM content_hash"""


def event_versions(spark, sf_dir):
    ev = derive.table(spark, sf_dir, "events")
    v = (F.get_json_object("props", "$.k").cast("int") / 25).cast("int")
    rows = ev.select("user_id", "event_type", F.expr("event_id div 500").alias("page"), "event_id", "ts", v.alias("v"))
    return with_content_hash(rows.select("user_id", "event_type", "v", "page", "event_id", "ts"), exclude=["page", "event_id", "ts"])


@register(
    "w1_latest_per_key",
    f"""SELECT user_id, event_type, page, v FROM ({_EV_SQL})
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY page DESC, event_id DESC) = 1""",
)
def w1_latest_per_key(spark, sf_dir):
    return fold.latest_per_key(event_versions(spark, sf_dir), ["user_id", "event_type"], "page", "event_id").select(
        "user_id", "event_type", "page", "v"
    )


@register("w2_change_events", f"SELECT user_id, event_type, page, _change FROM ({_EV_CHANGES_SQL})")
def w2_change_events(spark, sf_dir):
    ev = event_versions(spark, sf_dir)
    return fold.change_events(ev, ["user_id", "event_type"], "page", pos_col="event_id").select(
        "user_id", "event_type", "page", "_change"
    )


@register(
    "w3_last_changed",
    f"""SELECT l.user_id, l.event_type, l.v, strftime(c.last_changed, '%Y-%m-%dT%H:%M:%S.%f') AS last_changed
        FROM (SELECT * FROM ({_EV_SQL}) QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY page DESC, event_id DESC) = 1) l
        JOIN (SELECT user_id, event_type, max(ts) AS last_changed FROM ({_EV_CHANGES_SQL}) GROUP BY ALL) c
        USING (user_id, event_type)""",
)
def w3_last_changed(spark, sf_dir):
    st = fold.fold_state(event_versions(spark, sf_dir), ["user_id", "event_type"], "page", "ts", pos_col="event_id")
    return st.select("user_id", "event_type", "v", F.date_format("last_changed", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("last_changed"))


_W4_ORDER = ["l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@register(
    "w4_batch_dedup",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(c + ' DESC' for c in _W4_ORDER)}) = 1""",
)
def w4_batch_dedup(spark, sf_dir):
    li = derive.table(spark, sf_dir, "lineitem").select("l_orderkey", *_W4_ORDER)
    return dedup_latest(li, ["l_orderkey"], _W4_ORDER).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@register(
    "w5_valid_intervals",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS valid_from,
              strftime(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), '%Y-%m-%d') AS valid_to
       FROM orders""",
)
def w5_valid_intervals(spark, sf_dir):
    o = derive.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    iv = fold.valid_intervals(o, ["o_custkey"], "o_orderdate", "90 days", tie=["o_orderkey"])
    return iv.select("o_orderkey", F.date_format("valid_from", "yyyy-MM-dd").alias("valid_from"),
                     F.date_format("valid_to", "yyyy-MM-dd").alias("valid_to"))


# --- A2 / A3 / A4: run totals, no-data programs, bulk summary --------------------------------
_PAGE_STATS_SQL = f"""
SELECT e.event_type, e.page, e.records, e.input_rows, coalesce(c.written, 0) AS rows_written,
       coalesce(c.inserted, 0) AS rows_inserted, e.page = min(e.page) OVER (PARTITION BY e.event_type) AS table_created, e.ts
FROM (SELECT event_type, page, count(*) AS records, count(DISTINCT user_id) AS input_rows, max(ts) AS ts
      FROM ({_EV_SQL}) GROUP BY ALL) e
LEFT JOIN (SELECT event_type, page, count(*) AS written, count(*) FILTER (WHERE _change = 'insert') AS inserted
           FROM ({_EV_CHANGES_SQL}) GROUP BY ALL) c USING (event_type, page)"""
_TOTALS_SQL = f"""SELECT event_type, count(*) AS pages_fetched, CAST(sum(records) AS BIGINT) AS api_records,
       CAST(sum(input_rows) AS BIGINT) AS input_rows, CAST(sum(rows_written) AS BIGINT) AS rows_written,
       CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted, bool_or(table_created) AS table_created,
       strftime(max_by(ts, page), '%Y-%m-%dT%H:%M:%S.%f') AS timestamp
FROM ({_PAGE_STATS_SQL}) GROUP BY event_type"""


def page_stats(spark, sf_dir):
    ev = event_versions(spark, sf_dir)
    per_page = ev.groupBy("event_type", "page").agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("user_id").alias("input_rows"), F.max("ts").alias("timestamp")
    )
    ch = fold.change_events(ev, ["user_id", "event_type"], "page", pos_col="event_id").groupBy("event_type", "page").agg(
        F.count(F.lit(1)).alias("rows_written"), F.count_if(F.col("_change") == "insert").alias("rows_inserted")
    )
    firsts = per_page.groupBy("event_type").agg(F.min("page").alias("_first"))
    out = per_page.join(ch, ["event_type", "page"], "left").join(firsts, "event_type")
    return out.select(
        "event_type", "page", "records", "input_rows",
        F.coalesce("rows_written", F.lit(0)).alias("rows_written"), F.coalesce("rows_inserted", F.lit(0)).alias("rows_inserted"),
        (F.col("page") == F.col("_first")).alias("table_created"), "timestamp",
    )


@register("a2_run_totals", _TOTALS_SQL)
def a2_run_totals(spark, sf_dir):
    t = stats.run_totals(page_stats(spark, sf_dir), ["event_type"])
    return t.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


_REQUESTED = ["click", "view", "purchase", "signup", "error", "refund"]


@register(
    "a3_no_data",
    f"""SELECT r.event_type, coalesce(t.api_records, 0) AS api_records,
               CASE WHEN coalesce(t.api_records, 0) = 0 THEN 'no_data' ELSE 'ok' END AS status
        FROM (VALUES {', '.join(f"('{x}')" for x in _REQUESTED)}) r(event_type)
        LEFT JOIN (SELECT event_type, count(*) AS api_records FROM events GROUP BY ALL) t USING (event_type)""",
)
def a3_no_data(spark, sf_dir):
    requested = spark.createDataFrame([(x,) for x in _REQUESTED], "event_type string")
    totals = derive.table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("api_records"))
    return stats.with_no_data(requested, totals, "event_type").select("event_type", "api_records", "status")


@register(
    "a4_bulk_summary",
    """SELECT count(*) FILTER (WHERE success) AS successful, count(*) FILTER (WHERE NOT success) AS failed,
              CAST(coalesce(sum(records) FILTER (WHERE success), 0) AS BIGINT) AS total_records,
              coalesce(string_agg(program, ',' ORDER BY program) FILTER (WHERE NOT success), '') AS failed_programs
       FROM (SELECT event_type AS program, count(*) AS records, count(*) FILTER (WHERE value >= 450) = 0 AS success
             FROM events GROUP BY ALL)""",
)
def a4_bulk_summary(spark, sf_dir):
    runs = derive.table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("program")).agg(
        F.count(F.lit(1)).alias("records"), (F.count_if(F.col("value") >= 450) == 0).alias("success")
    )
    return stats.bulk_summary(runs)


# --- A7 / A8: hotel run totals and combined stages -------------------------------------------
@register(
    "a8_hotel_run_stats",
    f"""SELECT 'hotels' AS stage, count(*) AS records, count(DISTINCT nid) AS distinct_keys FROM ({_HOTELS_SQL})
        UNION ALL
        SELECT 'availability', count(*), count(DISTINCT (nid, date, is_points)) FROM ({_AVAIL_SQL})""",
)
def a8_hotel_run_stats(spark, sf_dir):
    from lakefold.operators.shape import flatten_hotels

    hotels = flatten_hotels(derive.hotel_details(spark, sf_dir))
    avail = hotel_availability_rows(spark, sf_dir)
    a7_h = hotels.agg(F.count(F.lit(1)).alias("records"), F.count_distinct("nid").alias("distinct_keys"))
    a7_a = avail.agg(F.count(F.lit(1)).alias("records"), F.count_distinct("nid", "date", "is_points").alias("distinct_keys"))
    return stats.combine_stages(hotels=a7_h, availability=a7_a)


# --- U1 / U3: append halves; program list union ---------------------------------------------
@register(
    "u1_append_halves",
    "SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'base' ELSE 'batch' END AS half FROM orders",
)
def u1_append_halves(spark, sf_dir):
    o = derive.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    cut = F.lit(derive.BASE_AS_OF).cast("timestamp_ntz")
    base = o.filter(F.col("o_orderdate") < cut).select("o_orderkey", F.lit("base").alias("half"))
    batch = o.filter(F.col("o_orderdate") >= cut).select("o_orderkey", F.lit("batch").alias("half"))
    return base.unionByName(batch)


@register("u3_name_list_union", "SELECT lower(n_name) AS name FROM nation UNION SELECT lower(r_name) FROM region")
def u3_name_list_union(spark, sf_dir):
    a = derive.table(spark, sf_dir, "nation").select(F.lower("n_name").alias("name"))
    b = derive.table(spark, sf_dir, "region").select(F.lower("r_name").alias("name"))
    return a.unionByName(b).distinct()
