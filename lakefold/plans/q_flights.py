"""Queries: flatten, hash, metadata and the snapshot merge (P1, P10-P13,
J1-J4, A1, A6, K3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakefold import schemas as S
from lakefold.functions.hashing import add_metadata, with_content_hash
from lakefold.operators.merge import ACTION, merge_counts
from lakefold.plans import derive, flights
from lakefold.plans import oracle as O
from lakefold.plans.catalog import register


def iso_text(df: DataFrame) -> DataFrame:
    """Export form: dates and timestamps as ISO text."""
    from pyspark.sql import types as T

    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _iso_sql_cols(kinds: list[tuple[str, str]]) -> str:
    out = []
    for name, kind in kinds:
        if kind == "date":
            out.append(f"strftime(\"{name}\", '%Y-%m-%d') AS \"{name}\"")
        elif kind == "ts":
            out.append(f"strftime(\"{name}\", '%Y-%m-%dT%H:%M:%S.%f') AS \"{name}\"")
        else:
            out.append(f'"{name}"')
    return ", ".join(out)


# --- K3 / J1-J4: flagship snapshot merge -----------------------------------
@register(
    "k3_merge_state",
    O.merge_state_sql(
        O.availability_hashed_sql(O.BASE),
        O.availability_hashed_sql(None),
        ["ID"],
        "coalesce(b.ID, t.ID) AS ID, {action} AS _action, "
        "CASE WHEN {action} IN ('insert','update') THEN b.content_hash ELSE t.content_hash END AS content_hash, "
        "CASE WHEN {action} IN ('insert','update') THEN b.Source ELSE t.Source END AS Source",
    ),
)
def k3_merge_state(spark, sf_dir):
    return flights.snapshot_merge(spark, sf_dir, columns=["Source"]).select("ID", ACTION, S.CONTENT_HASH, "Source")


@register(
    "a1_merge_counts",
    "SELECT _action, count(*) AS rows FROM ("
    + O.merge_state_sql(O.availability_hashed_sql(O.BASE), O.availability_hashed_sql(None), ["ID"], "{action} AS _action")
    + ") GROUP BY _action",
)
def a1_merge_counts(spark, sf_dir):
    return merge_counts(flights.snapshot_merge(spark, sf_dir, columns=[]))


@register(
    "j1_merge_changes",
    "SELECT _action, count(*) AS rows FROM ("
    + O.merge_state_sql(O.availability_hashed_sql(O.BASE), O.availability_hashed_sql(None), ["ID"], "{action} AS _action")
    + ") WHERE _action <> 'kept' GROUP BY _action",
)
def j1_merge_changes(spark, sf_dir):
    """Writer path: batch rows tagged, target read as keys + hash only."""
    return merge_counts(flights.snapshot_changes(spark, sf_dir, columns=[]))


# --- P1: flatten (94 columns, order kept) ----------------------------------
@register(
    "p1_flatten_availability",
    f"SELECT {_iso_sql_cols(O.AVAILABILITY_KINDS)} FROM ({O.availability_flat_sql(None)})",
)
def p1_flatten_availability(spark, sf_dir):
    from lakefold.operators.shape import flatten_availability

    return iso_text(flatten_availability(derive.availability_records(spark, sf_dir)))


# --- P11: content hash over a table with doubles ---------------------------
_CUSTOMER_KINDS = [("c_custkey", "int"), ("c_name", "str"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "str")]


@register("p11_content_hash", f"SELECT c_custkey, {O.hash_sql(_CUSTOMER_KINDS)} AS content_hash FROM customer")
def p11_content_hash(spark, sf_dir):
    cust = derive.table(spark, sf_dir, "customer")
    return with_content_hash(cust).select("c_custkey", S.CONTENT_HASH)


# --- P10/P12: metadata columns (batch instant fixed for determinism) -------
_ORDERS_KINDS = [
    ("o_orderkey", "int"), ("o_custkey", "int"), ("o_orderstatus", "str"), ("o_totalprice", "double"),
    ("o_orderdate", "ts"), ("o_orderpriority", "str"),
]


@register(
    "p12_add_metadata",
    "SELECT o_orderkey, '2025-01-01T00:00:00.000000' AS ingestion_timestamp, "
    f"{O.hash_sql(_ORDERS_KINDS)} AS content_hash FROM orders",
)
def p12_add_metadata(spark, sf_dir):
    orders = derive.table(spark, sf_dir, "orders")
    out = add_metadata(orders, flights.QUERY_INGESTION_TS)
    return iso_text(out.select("o_orderkey", S.INGESTION_TS, S.CONTENT_HASH))


# --- A6: equal rows hash equal, distinct rows hash distinct -----------------
@register(
    "a6_distinct_hashes",
    f"SELECT count(DISTINCT h) AS distinct_hashes, "
    f"count(DISTINCT (c_name, c_nationkey, c_acctbal, c_mktsegment)) AS distinct_rows, count(*) AS rows "
    f"FROM (SELECT *, {O.hash_sql([k for k in _CUSTOMER_KINDS if k[0] != 'c_custkey'])} AS h FROM customer)",
)
def a6_distinct_hashes(spark, sf_dir):
    cust = derive.table(spark, sf_dir, "customer")
    hashed = with_content_hash(cust, exclude=["c_custkey"])
    return hashed.agg(
        F.count_distinct(S.CONTENT_HASH).alias("distinct_hashes"),
        F.count_distinct(F.struct("c_name", "c_nationkey", "c_acctbal", "c_mktsegment")).alias("distinct_rows"),
        F.count(F.lit(1)).alias("rows"),
    )
