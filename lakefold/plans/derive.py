"""Domain frames derived from the driver's test tables.

The archive's inputs (landed pages, hotel pages, calendars) are not in the
test tables, so each domain record is derived from them by a Spark job whose
work grows with the tables:

* availability record  = one order, its route = customer -> nation -> region,
  its program = order priority, its four cabins = line numbers 1-4 of the
  order's line items (filtered = not returned, Raw = all);
* hotel               = one supplier (country = nation name);
* rate calendar day   = one user's events on one day (points = purchases);
* web pages           = ``pages``.

``as_of`` gives a snapshot: only orders and line items known by then.  Two
snapshots of the same tables are the base and the batch of a merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakefold import schemas as S

# Order priority -> program name.  The last one is not a known
# program on purpose (it exercises the reject path of program validation).
PRIORITY_PROGRAM = {
    "1-URGENT": "aeroplan",
    "2-HIGH": "united",
    "3-MEDIUM": "american",
    "4-NOT SPECIFIED": "alaska",
    "5-LOW": "lifemiles",
}
# Order status -> taxes currency.
STATUS_CURRENCY = {"F": "USD", "O": "EUR", "P": "GBP"}
# Snapshot boundary used for the base side of merges.
BASE_AS_OF = "1999-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def case_sql(mapping: dict, expr: str) -> str:
    whens = " ".join(f"WHEN {expr} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"(CASE {whens} END)"


def _cabin_aggs(k: int, cabin: str) -> list[str]:
    """Conditional aggregates (SQL text) for one cabin over one order's items."""
    out = []
    for variant in S.VARIANTS:
        keep = f"(l_linenumber - 1) % {len(S.CABINS)} = {k - 1}" + ("" if variant == "Raw" else " AND l_returnflag <> 'R'")
        tax = "CAST(floor(l_extendedprice * l_tax) AS INT)"
        p = f"{cabin}{variant}_"
        out += [
            f"CAST(count_if({keep}) AS INT) AS {p}n",
            f"sum(CASE WHEN {keep} THEN l_quantity END) AS {p}qty",
            f"min(CASE WHEN {keep} THEN l_quantity END) AS {p}minqty",
            f"sum(CASE WHEN {keep} THEN {tax} END) AS {p}tax",
            f"min(CASE WHEN {keep} THEN {tax} END) AS {p}mintax",
            f"count_if({keep} AND l_linestatus = 'O') AS {p}open",
            f"array_distinct(transform(filter(items, i -> {keep.replace('l_linenumber', 'i.n').replace('l_returnflag', 'i.r')} AND i.s IS NOT NULL), i -> i.s)) AS {p}sups",
            f"min(CASE WHEN {keep} THEN l_suppkey END) AS {p}minsup",
        ]
    return out


def _cabin_columns() -> list[str]:
    """The 88 per-cabin columns + TaxesCurrency (SQL text), from the aggregates."""
    cols = {}
    for cabin in S.CABINS:
        for variant in S.VARIANTS:
            p = f"{cabin}{variant}_"
            n = f"coalesce({p}n, 0)"
            miles = f"CAST(coalesce({p}qty, 0.0) * 1000 AS INT)"
            cols[f"{cabin}Available{variant}"] = f"{n} > 0"
            cols[f"{cabin}MileageCost{variant}"] = f"CAST({miles} AS STRING)" if variant == "" else miles
            cols[f"{cabin}DirectMileageCost{variant}"] = f"CAST({p}minqty * 1000 AS INT)"
            cols[f"{cabin}TotalTaxes{variant}"] = f"CAST(coalesce({p}tax, 0) AS INT)"
            cols[f"{cabin}DirectTotalTaxes{variant}"] = f"CAST({p}mintax AS INT)"
            cols[f"{cabin}RemainingSeats{variant}"] = n
            cols[f"{cabin}DirectRemainingSeats{variant}"] = f"CAST(coalesce({p}open, 0) AS INT)"
            cols[f"{cabin}Airlines{variant}"] = (
                f"coalesce(concat_ws(', ', sort_array(transform({p}sups, x -> concat('S', CAST(x AS STRING))))), '')"
            )
            cols[f"{cabin}DirectAirlines{variant}"] = f"coalesce(concat('S', CAST({p}minsup AS STRING)), '')"
            cols[f"{cabin}Direct{variant}"] = f"{n} = 1"
    cols["TaxesCurrency"] = case_sql(STATUS_CURRENCY, "o_orderstatus")
    return [f"{cols[name]} AS {name}" for name in S.CABIN_COLUMNS]


RECORD_ID = "concat('avail-', CAST({} AS STRING))"


def slice_of(identifier: str, n: int) -> Column:
    """Number of the slice (of ``n``) of a record's ID, an SQL expression."""
    return F.expr(f"pmod(crc32(CAST({identifier} AS BINARY)), {int(n)}L)")


def availability_records(spark: SparkSession, sf_dir: str, as_of: str | None = None, part: tuple[int, int] | None = None) -> DataFrame:
    """Nested availability records (one per order), as landed by the API;
    ``part`` (k, n): those of slice ``k`` of ``n`` by their ID, made of the
    orders and line items of these alone.

    Plan: line items -> partial+final aggregates on the order key (the
    aggregates' hash partitioning is reused by the joins with each other and
    with orders); customers joined by key (sort-merge at scale) while the
    orders are still narrow, so that the cabins' columns are never moved;
    nation and region are fixed-size (25/5 rows) and broadcast.
    """
    orders = table(spark, sf_dir, "orders")
    items = table(spark, sf_dir, "lineitem")
    if as_of is not None:
        cut = F.lit(as_of).cast("timestamp_ntz")
        orders = orders.filter(F.col("o_orderdate") < cut)
        items = items.filter(F.col("l_shipdate") < cut)
    if part is not None:
        orders = orders.filter(slice_of(RECORD_ID.format("o_orderkey"), part[1]) == part[0])
        items = items.filter(slice_of(RECORD_ID.format("l_orderkey"), part[1]) == part[0])
    # Line numbers fold onto the four cabins, so that every line counts.
    aggs = [a for k, c in enumerate(S.CABINS, 1) for a in _cabin_aggs(k, c)]
    # Numeric aggregates run in a code-generated hash aggregate; the suppliers
    # need an object aggregate, of one list an order, so they get their own.  Both
    # come out hash-partitioned on the order key, so joining them adds no shuffle.
    numeric = items.groupBy("l_orderkey").agg(*[F.expr(a) for a in aggs if "array_distinct" not in a])
    listed = F.collect_list(F.struct(F.col("l_linenumber").alias("n"), F.col("l_returnflag").alias("r"), F.col("l_suppkey").alias("s")))
    sets = items.groupBy("l_orderkey").agg(listed.alias("items")).selectExpr("l_orderkey", *[a for a in aggs if "array_distinct" in a])
    cabins = numeric.join(sets, "l_orderkey")
    nation = F.broadcast(table(spark, sf_dir, "nation"))
    region = F.broadcast(table(spark, sf_dir, "region"))
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    j = (
        orders.join(cust, orders.o_custkey == cust.c_custkey, "left")
        .join(nation, F.col("c_nationkey") == nation.n_nationkey, "left")
        .join(region, F.col("n_regionkey") == region.r_regionkey, "left")
        .join(cabins, orders.o_orderkey == cabins.l_orderkey, "left")
    )
    route_id = "concat('route-', CAST(o_custkey AS STRING))"
    source = case_sql(PRIORITY_PROGRAM, "o_orderpriority")
    iso_ts = "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
    route = (
        f"named_struct('ID', {route_id}, 'OriginAirport', n_name, 'OriginRegion', r_name, "
        "'DestinationAirport', c_mktsegment, "
        "'DestinationRegion', CASE WHEN c_acctbal >= 0 THEN 'DOMESTIC' ELSE 'INTERNATIONAL' END, "
        "'NumDaysOut', CAST(dayofyear(o_orderdate) AS INT), "
        "'Distance', CAST(c_nationkey * 100 + n_regionkey * 10 AS INT), "
        f"'Source', {source})"
    )
    return j.selectExpr(
        f"{RECORD_ID.format('o_orderkey')} AS ID",
        f"{route_id} AS RouteID",
        f"{route} AS Route",
        "date_format(o_orderdate, 'yyyy-MM-dd') AS Date",
        f"{iso_ts} AS ParsedDate",
        *_cabin_columns(),
        f"{source} AS Source",
        f"{iso_ts} AS CreatedAt",
        f"{iso_ts} AS UpdatedAt",
        "CAST(NULL AS STRING) AS AvailabilityTrips",
    )


# --- hotels: one supplier = one hotel --------------------------------------
HOTEL_SITE = "https://hotels.example.com/"


def hotel_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hotel detail records (P2 input): supplier joined to its (fixed-size,
    25-row) nation dimension, broadcast."""
    sup = table(spark, sf_dir, "supplier")
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    j = sup.join(nation, sup.s_nationkey == nation.n_nationkey, "left")
    return j.selectExpr(
        "s_suppkey AS nid",
        "s_name AS name",
        f"concat(regexp_replace('{HOTEL_SITE}', '/+$', ''), '/', regexp_replace(concat('/hotel/', CAST(s_suppkey AS STRING)), '^/+', '')) AS url",
        f"concat('{HOTEL_SITE}', 'hotel/', CAST(s_suppkey AS STRING)) AS canonical_url",
        "concat('H', CAST(s_suppkey AS STRING)) AS code",
        "CAST(s_nationkey * 10 + 5 AS INT) AS num_rooms",
        "n_name AS country",
        "s_name AS title",
        "CAST(NULL AS STRING) AS description",
        "CAST(s_nationkey AS STRING) AS choice_points",
        "concat('$', CAST(CAST(floor(s_acctbal) AS BIGINT) AS STRING)) AS average_rate",
        "CAST(s_suppkey AS STRING) AS synxis_id",
        "s_acctbal > 0 AS book_with_points",
        "s_nationkey % 2 = 0 AS book_with_choice",
    )


def daily_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rate per (user, points/cash, day) from events: purchases are the
    points calendar, everything else the cash calendar.  A partial aggregate,
    so a hot user is combined map-side."""
    ev = table(spark, sf_dir, "events")
    return ev.groupBy(
        F.col("user_id"),
        (F.col("event_type") == F.lit("purchase")).alias("is_points"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
    ).agg(F.min("value").alias("lo"), F.count_if(F.col("event_type") != F.lit("error")).alias("ok"), F.count(F.lit(1)).alias("events"))


def calendar_texts(spark: SparkSession, sf_dir: str, declare_events: bool = False) -> DataFrame:
    """Rate calendars as landed JSON text, one per (hotel = user, kind).

    Each calendar holds one entry per day, so the collected map is bounded by
    the number of days, not by the number of events of a hot user."""
    d = daily_rates(spark, sf_dir)
    rate = F.expr(
        "named_struct('lowestRate', CASE WHEN is_points THEN NULL ELSE lo END, "
        "'lowestPointsRate', CASE WHEN is_points THEN CAST(floor(lo * 100) AS INT) END, "
        "'available', ok > 0)"
    )
    cal = d.groupBy("user_id", "is_points").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("day"), rate))).alias("results"),
        (F.sum("events") if declare_events else F.count(F.lit(1))).cast("int").alias("count"),
    )
    text = F.to_json(
        F.struct(
            F.col("count"),
            F.when(~F.col("is_points"), F.lit("USD")).alias("currency_code"),
            F.col("results"),
        )
    )
    return cal.select(F.col("user_id").alias("nid"), "is_points", text.alias("text"))


def page_texts(spark: SparkSession, sf_dir: str, page_size: int = 500) -> DataFrame:
    """Events landed as API pages of ``page_size`` records (page = id div
    size), each a JSON object {data, count, hasMore, moreURL, cursor}.  A page
    is bounded by the page size."""
    ev = table(spark, sf_dir, "events")
    last = ev.agg(F.max(F.expr(f"event_id div {page_size}"))).scalar()  # scalar subquery
    rec = F.struct("event_id", "user_id", "event_type", "value", "props")
    pages = ev.groupBy(F.expr(f"event_id div {page_size}").alias("page")).agg(
        F.array_sort(F.collect_list(rec)).alias("data"), F.count(F.lit(1)).cast("int").alias("count")
    )
    pages = pages.withColumn("m", last)
    return pages.select(
        "page",
        F.to_json(
            F.struct(
                "data",
                "count",
                (F.col("page") < F.col("m")).alias("hasMore"),
                F.when(F.col("page") < F.col("m"), F.concat(F.lit("/page/"), (F.col("page") + 1).cast("string"))).alias("moreURL"),
                (F.col("page") * page_size).alias("cursor"),
            )
        ).alias("text"),
    )
