"""SQL text builders for the DuckDB oracle of the derived domain frames.

These mirror ``lakefold.plans.derive`` and ``lakefold.functions.hashing`` in
plain SQL so the driver can check our Spark results value by value.
"""

from __future__ import annotations

from lakefold import schemas as S
from lakefold.plans.derive import BASE_AS_OF, PRIORITY_PROGRAM, STATUS_CURRENCY


def case_map(mapping: dict, expr: str) -> str:
    whens = " ".join(f"WHEN {expr} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"(CASE {whens} END)"


def hash_sql(columns: list[tuple[str, str]]) -> str:
    """16-hex hash over (name, kind) pairs; kind in str/int/bool/double/date/ts."""
    parts = []
    for name, kind in sorted(columns):
        ref = f'"{name}"'
        if kind == "double":
            ref = f"CAST({ref} AS VARCHAR)"
        elif kind == "date":
            ref = f"strftime({ref}, '%Y-%m-%d')"
        elif kind == "ts":
            ref = f"strftime({ref}, '%Y-%m-%dT%H:%M:%S.%f')"
        parts.append(f'"{name}" := {ref}')
    return f"substr(sha256(CAST(to_json(struct_pack({', '.join(parts)})) AS VARCHAR)), 1, 16)"


def kind_of(dtype) -> str:
    from pyspark.sql import types as T

    if isinstance(dtype, T.BooleanType):
        return "bool"
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return "int"
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        return "double"
    if isinstance(dtype, T.DateType):
        return "date"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "ts"
    return "str"


AVAILABILITY_KINDS = [(f.name, kind_of(f.dataType)) for f in S.AVAILABILITY.fields]


def _cabin_select() -> str:
    cols = []
    for cabin in S.CABINS:
        for variant in S.VARIANTS:
            p = f"{cabin}{variant}_"
            n = f"coalesce({p}n, 0)"
            miles = f"CAST(coalesce({p}qty, 0.0) * 1000 AS INTEGER)"
            cols += [
                f"{n} > 0 AS {cabin}Available{variant}",
                (f"CAST({miles} AS VARCHAR)" if variant == "" else miles) + f" AS {cabin}MileageCost{variant}",
                f"CAST({p}minqty * 1000 AS INTEGER) AS {cabin}DirectMileageCost{variant}",
                f"CAST(coalesce({p}tax, 0) AS INTEGER) AS {cabin}TotalTaxes{variant}",
                f"CAST({p}mintax AS INTEGER) AS {cabin}DirectTotalTaxes{variant}",
                f"CAST({n} AS INTEGER) AS {cabin}RemainingSeats{variant}",
                f"CAST(coalesce({p}open, 0) AS INTEGER) AS {cabin}DirectRemainingSeats{variant}",
                f"coalesce({p}sups, '') AS {cabin}Airlines{variant}",
                f"coalesce('S' || CAST({p}minsup AS VARCHAR), '') AS {cabin}DirectAirlines{variant}",
                f"{n} = 1 AS {cabin}Direct{variant}",
            ]
    cols.append(f"{case_map(STATUS_CURRENCY, 'o_orderstatus')} AS TaxesCurrency")
    return ", ".join(cols)


def _cabin_aggs() -> str:
    aggs = []
    for k, cabin in enumerate(S.CABINS, 1):
        for variant in S.VARIANTS:
            keep = f"(l_linenumber - 1) % {len(S.CABINS)} = {k - 1}" + ("" if variant == "Raw" else " AND l_returnflag <> 'R'")
            p = f"{cabin}{variant}_"
            tax = "CAST(floor(l_extendedprice * l_tax) AS INTEGER)"
            aggs += [
                f"CAST(count(*) FILTER (WHERE {keep}) AS INTEGER) AS {p}n",
                f"sum(l_quantity) FILTER (WHERE {keep}) AS {p}qty",
                f"min(l_quantity) FILTER (WHERE {keep}) AS {p}minqty",
                f"sum({tax}) FILTER (WHERE {keep}) AS {p}tax",
                f"min({tax}) FILTER (WHERE {keep}) AS {p}mintax",
                f"count(*) FILTER (WHERE {keep} AND l_linestatus = 'O') AS {p}open",
                f"array_to_string(list_sort(list_distinct(list('S' || CAST(l_suppkey AS VARCHAR)) FILTER (WHERE {keep}))), ', ') AS {p}sups",
                f"min(l_suppkey) FILTER (WHERE {keep}) AS {p}minsup",
            ]
    return ", ".join(aggs)


def availability_flat_sql(as_of: str | None) -> str:
    """SELECT producing the 94-column flight table from the test tables."""
    o_cut = f"WHERE o_orderdate < TIMESTAMP '{as_of}'" if as_of else ""
    l_cut = f"WHERE l_shipdate < TIMESTAMP '{as_of}'" if as_of else ""
    src = case_map(PRIORITY_PROGRAM, "o_orderpriority")
    return f"""
    SELECT 'avail-' || CAST(o_orderkey AS VARCHAR) AS ID,
           'route-' || CAST(o_custkey AS VARCHAR) AS RouteID,
           CAST(o_orderdate AS DATE) AS Date,
           CAST(o_orderdate AS TIMESTAMP) AS ParsedDate,
           n_name AS OriginAirport, r_name AS OriginRegion, c_mktsegment AS DestinationAirport,
           CASE WHEN c_acctbal >= 0 THEN 'DOMESTIC' ELSE 'INTERNATIONAL' END AS DestinationRegion,
           CAST(dayofyear(o_orderdate) AS INTEGER) AS NumDaysOut,
           CAST(c_nationkey * 100 + n_regionkey * 10 AS INTEGER) AS Distance,
           {_cabin_select()},
           {src} AS Source,
           CAST(o_orderdate AS TIMESTAMP) AS CreatedAt,
           CAST(o_orderdate AS TIMESTAMP) AS UpdatedAt
    FROM (SELECT * FROM orders {o_cut}) o
    LEFT JOIN (SELECT l_orderkey, {_cabin_aggs()} FROM (SELECT * FROM lineitem {l_cut}) GROUP BY l_orderkey) c
           ON o.o_orderkey = c.l_orderkey
    LEFT JOIN customer ON o.o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey
    """


def availability_hashed_sql(as_of: str | None) -> str:
    return f"SELECT *, {hash_sql(AVAILABILITY_KINDS)} AS content_hash FROM ({availability_flat_sql(as_of)})"


def merge_action_sql(keys: list[str]) -> str:
    """CASE expression of the merge action over ``t FULL JOIN b``."""
    return (
        f"(CASE WHEN t.{keys[0]} IS NULL THEN 'insert' WHEN b.{keys[0]} IS NULL THEN 'kept' "
        "WHEN t.content_hash IS DISTINCT FROM b.content_hash THEN 'update' ELSE 'unchanged' END)"
    )


def merge_state_sql(base: str, batch: str, keys: list[str], select: str) -> str:
    """Full-outer merge of two hashed relations with the same action rules.

    ``select`` may use ``{action}`` for the action expression and the
    aliases ``t`` (stored) and ``b`` (batch).
    """
    on = " AND ".join(f"t.{k} = b.{k}" for k in keys)
    sel = select.replace("{action}", merge_action_sql(keys))
    return f"WITH t AS ({base}), b AS ({batch}) SELECT {sel} FROM t FULL JOIN b ON {on}"


BASE = BASE_AS_OF
