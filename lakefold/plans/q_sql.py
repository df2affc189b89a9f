"""SQL surface coverage (C1-C22): what a user of the ad-hoc SQL runner can
type, one query per category, each with its DuckDB twin.

Most are plain Spark SQL through ``run_sql``; the categories whose naive
plan puts a whole key into one task (range join, as-of, running and moving
windows, sessions) use the skew-safe operators instead.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakefold.operators import fold, windows
from lakefold.plans import derive
from lakefold.plans.catalog import register
from lakefold.plans.sqlrun import register_tables, run_sql


def _sql(name: str, spark_sql: str, duck_sql: str | None = None, tables: tuple[str, ...] = ()):
    """Register a query that runs ``spark_sql`` over the named test tables."""

    def fn(spark, sf_dir):
        register_tables(spark, {t: f"{sf_dir}/{t}.parquet" for t in tables})
        return run_sql(spark, spark_sql)[0]

    fn.__name__ = name
    register(name, duck_sql if duck_sql is not None else spark_sql)(fn)


# Inner / left / right / full equi joins ------------------------------------------
_C1 = """
SELECT 'inner' AS kind, count(*) AS rows_out, count(o_orderkey) AS left_rows, count(c_custkey) AS right_rows
  FROM orders JOIN customer ON o_custkey = c_custkey
UNION ALL SELECT 'left', count(*), count(o_orderkey), count(c_custkey) FROM orders LEFT JOIN customer ON o_custkey = c_custkey
UNION ALL SELECT 'right', count(*), count(o_orderkey), count(c_custkey) FROM orders RIGHT JOIN customer ON o_custkey = c_custkey
UNION ALL SELECT 'full', count(*), count(o_orderkey), count(c_custkey) FROM orders FULL JOIN customer ON o_custkey = c_custkey
UNION ALL SELECT 'supplier_nation', count(*), count(s_suppkey), count(n_nationkey) FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey
"""
_sql("c1_equi_joins", _C1, tables=("orders", "customer", "nation", "supplier"))

# Semi / anti -----------------------------------------------------------------------
_C2 = """
SELECT 'with_orders' AS kind, count(*) AS customers FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)
UNION ALL
SELECT 'without_orders', count(*) FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)
"""
_sql("c2_semi_anti", _C2, tables=("orders", "customer"))

# Theta join of the fixed-size dimensions (5 x 25 rows by definition) ----------------
_C3 = "SELECT r_name, count(*) AS nations_below FROM region JOIN nation ON n_regionkey < r_regionkey GROUP BY r_name"
_sql("c3_theta_join", _C3, tables=("region", "nation"))


# C4: range join as a pair-free range count -----------------------------------------------
@register(
    "c4_range_join",
    """SELECT e.event_id, count(x.event_id) AS followers
       FROM events e LEFT JOIN events x ON x.user_id = e.user_id AND x.ts > e.ts AND x.ts <= e.ts + INTERVAL 1 HOUR
       WHERE e.event_type = 'error' GROUP BY e.event_id""",
)
def c4_range_join(spark, sf_dir):
    """Events of the same user within one hour after each error, counted
    without forming (error, event) pairs: N(t + 1h) - N(t) from running
    counts and as-of lookups (skew-safe for a hot user)."""
    ev = derive.table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    errors = ev.filter(F.col("event_type") == "error").select("event_id", "user_id", "ts")
    out = windows.range_count(errors, ev.select("user_id", "ts"), ["user_id"], "ts", 3600, out="followers", id_col="event_id")
    return out.select("event_id", "followers")


# As-of: last view before each purchase ------------------------------------------------
@register(
    "c5_asof_join",
    """SELECT p.event_id, v.value AS asof_value
       FROM (SELECT * FROM events WHERE event_type = 'purchase') p
       ASOF LEFT JOIN (SELECT user_id, ts, value FROM events WHERE event_type = 'view') v
       ON p.user_id = v.user_id AND p.ts > v.ts""",
)
def c5_asof_join(spark, sf_dir):
    ev = derive.table(spark, sf_dir, "events")
    purchases = ev.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    views = ev.filter(F.col("event_type") == "view").select("user_id", "ts", "value")
    out = fold.asof_last(purchases, views, ["user_id"], "ts", "value", bucket="1 day", strict=True)
    return out.select("event_id", F.col("asof_value"))


# Group by, having, distinct aggregates ---------------------------------------------------
_C6 = """
SELECT o_orderpriority, count(*) AS orders, count(DISTINCT o_custkey) AS customers,
       CAST(sum(CAST(floor(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS revenue_cents
FROM orders GROUP BY o_orderpriority HAVING count(*) > 100
"""
_sql("c6_group_having", _C6, tables=("orders",))

# Rollup / cube / grouping sets -------------------------------------------------------
_C7 = """
SELECT r_name, n_name, c_mktsegment, CAST(GROUPING(r_name) AS INT) AS g_r, CAST(GROUPING(n_name) AS INT) AS g_n, CAST(GROUPING(c_mktsegment) AS INT) AS g_s,
       count(*) AS customers, CAST(sum(CAST(floor(c_acctbal) AS BIGINT)) AS BIGINT) AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY GROUPING SETS ((r_name, n_name, c_mktsegment), (r_name, n_name), (r_name), (c_mktsegment), ())
"""
_sql("c7_grouping_sets", _C7, tables=("customer", "nation", "region"))
_C7B = """
SELECT r_name, c_mktsegment, CAST(GROUPING(r_name) AS INT) AS g_r, CAST(GROUPING(c_mktsegment) AS INT) AS g_s, count(*) AS customers
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY CUBE (r_name, c_mktsegment)
"""
_sql("c7_cube", _C7B, tables=("customer", "nation", "region"))
_C7C = """
SELECT r_name, n_name, CAST(GROUPING(r_name) AS INT) AS g_r, CAST(GROUPING(n_name) AS INT) AS g_n, count(*) AS customers
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY ROLLUP (r_name, n_name)
"""
_sql("c7_rollup", _C7C, tables=("customer", "nation", "region"))


# Approximate distinct / quantile, held against the exact ones within their bounds -------
def c8_approx(spark, sf_dir):
    """Exact distinct users, and whether the approximations keep their bounds:
    15 % (three standard errors) for the count, 1 % of the ranks for quantiles."""
    ev = derive.table(spark, sf_dir, "events")
    near = ev.groupBy("event_type").agg(
        F.approx_count_distinct("user_id").alias("users_approx"),
        F.percentile_approx("value", [0.5, 0.9], 1000).alias("q"),
    )
    users = ev.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))
    j = ev.join(near, "event_type").groupBy("event_type").agg(
        F.count("value").alias("n"), F.first("users_approx").alias("users_approx"),
        *(F.count_if(F.col("value") < F.col("q")[k]).alias(f"below{k}") for k in (0, 1)),
        *(F.count_if(F.col("value") <= F.col("q")[k]).alias(f"upto{k}") for k in (0, 1)),
    )
    # The rank that is asked for lies among the ranks of the value that was returned.
    fits = lambda k, p: (F.col(f"below{k}") <= (p + 0.01) * F.col("n")) & (F.col(f"upto{k}") >= (p - 0.01) * F.col("n"))
    return j.join(users, "event_type").select(
        "event_type", "users", (F.abs(F.col("users_approx") - F.col("users")) <= 0.15 * F.col("users") + 1).alias("users_close"),
        fits(0, 0.5).alias("p50_close"), fits(1, 0.9).alias("p90_close"))


register("c8_approx_aggregates", """SELECT event_type, count(DISTINCT user_id) AS users, true AS users_close, true AS p50_close,
    true AS p90_close FROM events GROUP BY event_type""")(c8_approx)

# Pivot / unpivot ---------------------------------------------------------------------
_C9P_SPARK = """
SELECT * FROM (SELECT l_linestatus, l_returnflag, l_quantity FROM lineitem)
PIVOT (sum(l_quantity) FOR l_returnflag IN ('A' AS A, 'N' AS N, 'R' AS R))
"""
_C9P_DUCK = """
SELECT l_linestatus, sum(l_quantity) FILTER (WHERE l_returnflag = 'A') AS A,
       sum(l_quantity) FILTER (WHERE l_returnflag = 'N') AS N, sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS R
FROM lineitem GROUP BY l_linestatus
"""
_sql("c9_pivot", _C9P_SPARK, _C9P_DUCK, tables=("lineitem",))


@register(
    "c9_unpivot",
    """SELECT cabin, count(*) AS rows, CAST(sum(miles) AS BIGINT) AS miles FROM (
         SELECT ID, 'Y' AS cabin, YMileageCostRaw AS miles FROM flat UNION ALL SELECT ID, 'W', WMileageCostRaw FROM flat
         UNION ALL SELECT ID, 'J', JMileageCostRaw FROM flat UNION ALL SELECT ID, 'F', FMileageCostRaw FROM flat)
       GROUP BY cabin""".replace("flat", "(" + __import__("lakefold.plans.oracle", fromlist=["x"]).availability_flat_sql(None) + ")"),
)
def c9_unpivot(spark, sf_dir):
    from lakefold.operators.shape import flatten_availability

    wide = flatten_availability(derive.availability_records(spark, sf_dir)).select(
        "ID", "YMileageCostRaw", "WMileageCostRaw", "JMileageCostRaw", "FMileageCostRaw"
    )
    long = wide.unpivot("ID", [f"{c}MileageCostRaw" for c in "YWJF"], "metric", "miles")
    long = long.withColumn("cabin", F.substring("metric", 1, 1))
    return long.groupBy("cabin").agg(F.count(F.lit(1)).alias("rows"), F.sum("miles").alias("miles"))


# Ranking windows (top-3 per customer: the filter on row_number lets
# Spark cut each key to 3 rows before the shuffle, WindowGroupLimit) -------------------
_C10 = """
SELECT o_custkey, o_orderkey, rn, rnk, drnk FROM (
  SELECT o_custkey, o_orderkey,
         CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS INT) AS rn,
         CAST(rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS INT) AS rnk,
         CAST(dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS INT) AS drnk
  FROM orders) t
WHERE rn <= 3
"""
_sql("c10_top3_per_customer", _C10, tables=("orders",))
_C10B = """
SELECT c_custkey, CAST(ntile(4) OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) AS INT) AS quartile,
       percent_rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) AS pct
FROM customer
"""


@register("c10_ntile_percent_rank", _C10B)
def c10_ntile_percent_rank(spark, sf_dir):
    """Quartiles of few, large keys: each nation is dealt over many ranges."""
    customers = derive.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    out = windows.ranked(customers, ["c_nationkey"], ["c_acctbal", "c_custkey"], tiles=4)
    return out.select("c_custkey", F.col("tile").cast("int").alias("quartile"), F.col("percent_rank").alias("pct"))


# Equal values: an order's priority and status rank alike.
_C10C = """
SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderpriority, o_orderkey) AS rn,
       rank() OVER (PARTITION BY o_orderstatus ORDER BY o_orderpriority) AS rnk,
       dense_rank() OVER (PARTITION BY o_orderstatus ORDER BY o_orderpriority) AS drnk,
       percent_rank() OVER (PARTITION BY o_orderstatus ORDER BY o_orderpriority) AS pct
FROM orders
"""


@register("c10_ranks_of_ties", _C10C)
def c10_ranks_of_ties(spark, sf_dir):
    """Ranks of five values in three keys: each value runs over many ranges."""
    orders = derive.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    out = windows.ranked(orders, ["o_orderstatus"], ["o_orderpriority"], tie=["o_orderkey"])
    return out.select("o_orderkey", F.col("row_number").alias("rn"), F.col("rank").alias("rnk"), F.col("dense_rank").alias("drnk"),
                      F.col("percent_rank").alias("pct"))


# C11: analytic windows and frames over conversations (bucketed, exact) -------------------------
@register(
    "c11_running_and_moving",
    """SELECT conv_id, turn, length(text) AS n,
              CAST(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_sum,
              avg(length(text)) OVER (PARTITION BY conv_id ORDER BY turn RANGE BETWEEN 6 PRECEDING AND CURRENT ROW) AS moving_avg,
              lag(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) AS lag_value,
              lead(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) AS lead_value,
              first_value(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_value,
              last_value(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_value
       FROM conversations""",
)
def c11_running_and_moving(spark, sf_dir):
    conv = derive.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.length("text").cast("bigint").alias("n"))
    out = windows.series(conv, ["conv_id"], "turn", "n", preceding=6, following=0, bucket_size=64)
    return out.select("conv_id", "turn", "n", "running_sum", "moving_avg", "lag_value", "lead_value", "first_value", "last_value")


# Top-k with offset and null ordering ---------------------------------------------------
_C12 = """
SELECT o_orderkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 10 OFFSET 5
"""
_sql("c12_topk_offset", _C12, tables=("orders",))

# Union / intersect / except, distinct and all ---------------------------------------------
_C13 = """
SELECT 'union' AS op, count(*) AS rows_out FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'union_all', count(*) FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'intersect', count(*) FROM (SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'intersect_all', count(*) FROM (SELECT c_nationkey AS k FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'except', count(*) FROM (SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'except_all', count(*) FROM (SELECT c_nationkey AS k FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier)
"""
_sql("c13_set_operations", _C13, tables=("customer", "supplier"))

# C14: CTE, correlated scalar subquery, EXISTS ----------------------------------------------------
_C14 = """
WITH big AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders o
             WHERE o_totalprice > (SELECT avg(i.o_totalprice) FROM orders i WHERE i.o_custkey = o.o_custkey))
SELECT o_orderkey, o_custkey FROM big b
WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = b.o_orderkey AND l.l_returnflag = 'R')
"""
_sql("c14_subqueries", _C14, tables=("orders", "lineitem"))

# String functions ------------------------------------------------------------------------
_C15_SPARK = r"""
SELECT doc_id, length(text) AS n_chars_calc, n_chars,
       size(split(trim(text), '\\s+')) AS n_words,
       regexp_extract(text, '^(\\S+)', 1) AS first_word,
       text RLIKE '[A-Za-z0-9._]+@[A-Za-z0-9.]+\\.[a-z]+' AS has_email,
       concat_ws('|', lang, source) AS tag,
       length(replace(text, ' ', '')) AS non_space,
       instr(text, 'the') AS first_the,
       lpad(CAST(doc_id AS STRING), 6, '0') AS padded
FROM documents
"""
_C15_DUCK = r"""
SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars_calc, n_chars,
       CAST(len(regexp_split_to_array(trim(text, ' '), '\s+')) AS INTEGER) AS n_words,
       regexp_extract(text, '^(\S+)', 1) AS first_word,
       regexp_matches(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+\.[a-z]+') AS has_email,
       concat_ws('|', lang, source) AS tag,
       CAST(length(replace(text, ' ', '')) AS INTEGER) AS non_space,
       CAST(instr(text, 'the') AS INTEGER) AS first_the,
       lpad(CAST(doc_id AS VARCHAR), 6, '0') AS padded
FROM documents
"""
_sql("c15_string_functions", _C15_SPARK, _C15_DUCK, tables=("documents",))
_C15B_SPARK = r"""
SELECT page_id, regexp_extract(url, '^https?://([^/:?#]+)', 1) AS host,
       regexp_extract(url, '/(en|de|fr|es)/', 1) AS lang, lower(url) AS lower_url,
       split_part(url, '?', 1) AS no_query, replace(url, 'https://', '') AS no_scheme
FROM pages
"""
_C15B_DUCK = r"""
SELECT page_id, regexp_extract(url, '^https?://([^/:?#]+)', 1) AS host,
       regexp_extract(url, '/(en|de|fr|es)/', 1) AS lang, lower(url) AS lower_url,
       split_part(url, '?', 1) AS no_query, replace(url, 'https://', '') AS no_scheme
FROM pages
"""
_sql("c15_url_functions", _C15B_SPARK, _C15B_DUCK, tables=("pages",))

# Date / time functions ----------------------------------------------------------------------
_C16_SPARK = """
SELECT date_format(date_trunc('DAY', ts), 'yyyy-MM-dd') AS day, count(*) AS events,
       count(DISTINCT user_id) AS users, datediff(to_date(date_trunc('DAY', ts)), DATE'2024-01-01') AS day_no,
       min(hour(ts)) AS first_hour, max(dayofweek(ts)) AS dow,
       date_format(max(ts) + INTERVAL 30 MINUTES, 'yyyy-MM-dd HH:mm') AS last_plus_30m
FROM events GROUP BY date_trunc('DAY', ts)
"""
_C16_DUCK = """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*) AS events,
       count(DISTINCT user_id) AS users, CAST(datediff('day', DATE '2024-01-01', CAST(date_trunc('day', ts) AS DATE)) AS INTEGER) AS day_no,
       CAST(min(hour(ts)) AS INTEGER) AS first_hour, CAST(max(dayofweek(ts) + 1) AS INTEGER) AS dow,
       strftime(max(ts) + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M') AS last_plus_30m
FROM events GROUP BY date_trunc('day', ts)
"""
_sql("c16_datetime_functions", _C16_SPARK, _C16_DUCK, tables=("events",))

# C17: math ---------------------------------------------------------------------------------------
_C17_SPARK = """
SELECT l_returnflag, CAST(sum(CAST(floor(l_extendedprice * (1 - l_discount) * 100) AS BIGINT)) AS BIGINT) AS net_cents,
       CAST(sum(l_quantity) AS BIGINT) div 7 AS weeks, max(ceil(l_extendedprice)) AS max_ceil,
       min(abs(l_extendedprice - 50000)) AS nearest, max(pmod(l_partkey, 7)) AS max_mod, min(round(l_tax * 3, 2)) AS min_tax3
FROM lineitem GROUP BY l_returnflag
"""
_C17_DUCK = """
SELECT l_returnflag, CAST(sum(CAST(floor(l_extendedprice * (1 - l_discount) * 100) AS BIGINT)) AS BIGINT) AS net_cents,
       CAST(sum(l_quantity) AS BIGINT) // 7 AS weeks, CAST(max(ceil(l_extendedprice)) AS BIGINT) AS max_ceil,
       min(abs(l_extendedprice - 50000)) AS nearest, max(((l_partkey % 7) + 7) % 7) AS max_mod, min(round(l_tax * 3, 2)) AS min_tax3
FROM lineitem GROUP BY l_returnflag
"""
_sql("c17_math", _C17_SPARK, _C17_DUCK, tables=("lineitem",))

# Arrays, maps, lambdas ---------------------------------------------------------------------
_C18_SPARK = """
SELECT vec_id, size(embedding) AS dims, size(filter(embedding, x -> x > 0)) AS positives,
       round(aggregate(embedding, CAST(0 AS DOUBLE), (acc, x) -> acc + CAST(x AS DOUBLE) * CAST(x AS DOUBLE)), 6) AS norm2,
       round(CAST(array_max(embedding) AS DOUBLE), 6) AS top,
       element_at(map_from_arrays(array('label'), array(label)), 'label') AS label_from_map,
       size(array_distinct(transform(embedding, x -> x > 0))) AS signs
FROM embeddings
"""
_C18_DUCK = """
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dims, CAST(len(list_filter(embedding, lambda x: x > 0)) AS INTEGER) AS positives,
       round(list_reduce(list_prepend(CAST(0 AS DOUBLE), list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))), lambda a, b: a + b), 6) AS norm2,
       round(CAST(list_max(embedding) AS DOUBLE), 6) AS top,
       map_from_entries([('label', label)])['label'] AS label_from_map,
       CAST(len(list_distinct(list_transform(embedding, lambda x: x > 0))) AS INTEGER) AS signs
FROM embeddings
"""
_sql("c18_arrays_lambdas", _C18_SPARK, _C18_DUCK, tables=("embeddings",))

# JSON --------------------------------------------------------------------------------------
_C19_SPARK = """
SELECT CAST(get_json_object(props, '$.k') AS INT) DIV 10 AS k_bucket, count(*) AS events,
       sum(from_json(props, 'k INT').k) AS k_sum
FROM events GROUP BY CAST(get_json_object(props, '$.k') AS INT) DIV 10
"""
_C19_DUCK = """
SELECT CAST(CAST(json_extract(props, '$.k') AS INTEGER) // 10 AS BIGINT) AS k_bucket, count(*) AS events,
       CAST(sum(CAST(json_extract(props, '$.k') AS INTEGER)) AS BIGINT) AS k_sum
FROM events GROUP BY ALL
"""
_sql("c19_json", _C19_SPARK, _C19_DUCK, tables=("events",))

# C20: CASE / COALESCE / null-safe logic ------------------------------------------------------------
_C20 = """
SELECT d.lang, count(*) AS docs, count(l.doc_id) AS labelled,
       CAST(sum(CASE WHEN coalesce(l.quality, -1) = 1 THEN 1 ELSE 0 END) AS BIGINT) AS good,
       CAST(sum(CASE WHEN l.toxic IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unknown_toxic,
       CAST(sum(CASE WHEN l.toxic IS NOT DISTINCT FROM l.quality THEN 1 ELSE 0 END) AS BIGINT) AS same_flags,
       CAST(sum(CASE WHEN nullif(l.quality, 0) IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS zero_or_null
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
GROUP BY d.lang
"""
_sql("c20_null_logic", _C20, tables=("documents", "labels"))

# Event-time windows: tumbling, sliding, sessions ---------------------------------------------
_C21_SPARK = """
SELECT date_format(window.start, 'yyyy-MM-dd HH:mm') AS window_start, count(*) AS events, count(DISTINCT user_id) AS users
FROM events GROUP BY window(ts, '1 hour')
"""
_C21_DUCK = """
SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M') AS window_start, count(*) AS events, count(DISTINCT user_id) AS users
FROM events GROUP BY ALL
"""
_sql("c21_tumbling_window", _C21_SPARK, _C21_DUCK, tables=("events",))
_C21S_SPARK = """
SELECT date_format(window.start, 'yyyy-MM-dd HH:mm') AS window_start, count(*) AS events
FROM events GROUP BY window(ts, '2 hours', '1 hour')
"""
_C21S_DUCK = """
SELECT strftime(s, '%Y-%m-%d %H:%M') AS window_start, count(*) AS events FROM (
  SELECT time_bucket(INTERVAL 1 HOUR, ts) AS s FROM events
  UNION ALL SELECT time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 1 HOUR FROM events)
GROUP BY ALL
"""
_sql("c21_sliding_window", _C21S_SPARK, _C21S_DUCK, tables=("events",))


@register(
    "c21_sessions",
    """WITH g AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                   OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS s FROM events),
            n AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
       SELECT user_id, strftime(min(ts), '%Y-%m-%dT%H:%M:%S.%f') AS session_start, count(*) AS events FROM n GROUP BY user_id, sid""",
)
def c21_sessions(spark, sf_dir):
    ev = derive.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    s = windows.sessions(ev, ["user_id"], "ts", 30 * 60)
    return s.groupBy("user_id", "session_start").agg(F.count(F.lit(1)).alias("events")).select(
        "user_id", F.date_format("session_start", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("session_start"), "events"
    )


# Describe / summarize ----------------------------------------------------------------------
def _profile_sql(cols, text_of):
    parts = [
        f"SELECT '{c}' AS column_name, count({c}) AS non_null, count(DISTINCT {c}) AS distinct_values, "
        f"{text_of(f'min({c})', k)} AS min_value, {text_of(f'max({c})', k)} AS max_value FROM orders"
        for c, k in cols
    ]
    return " UNION ALL ".join(parts)


_ORD_COLS = [("o_orderkey", "int"), ("o_custkey", "int"), ("o_orderstatus", "str"), ("o_totalprice", "double"),
             ("o_orderdate", "ts"), ("o_orderpriority", "str")]
_C22_SPARK = _profile_sql(_ORD_COLS, lambda e, k: f"date_format({e}, 'yyyy-MM-dd HH:mm:ss')" if k == "ts" else f"CAST({e} AS STRING)")
_C22_DUCK = _profile_sql(_ORD_COLS, lambda e, k: f"strftime({e}, '%Y-%m-%d %H:%M:%S')" if k == "ts" else f"CAST({e} AS VARCHAR)")
_sql("c22_profile", _C22_SPARK, _C22_DUCK, tables=("orders",))
