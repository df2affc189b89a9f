"""Projections and shaping: flatten nested records, enforce declared schemas,
tag constants, build hotel URLs (P1-P4, P9, P13, P14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakefold import schemas as S
from lakefold.functions.hashing import ident


def _field(schema: T.StructType, path: str) -> str | None:
    """SQL reference for a dotted path if the schema has it, else None.

    Takes the schema (fetched once per frame): asking a frame for its schema
    is a round trip to the JVM, which adds up over a hundred columns."""
    head, *rest = path.split(".")
    if head not in schema.fieldNames():
        return None
    dtype = schema[head].dataType
    for part in rest:
        if not isinstance(dtype, T.StructType) or part not in dtype.fieldNames():
            return None
        dtype = dtype[part].dataType
    return ".".join(ident(p) for p in path.split("."))


def _typed(ref: str | None, dtype: T.DataType) -> str:
    """Cast to the declared type; text that does not parse becomes null
    (validation reports it).  Missing input gives a typed null, never void."""
    if ref is None:
        return f"CAST(NULL AS {dtype.simpleString()})"
    return f"try_cast({ref} AS {dtype.simpleString()})"


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns in declared order with declared types.

    Absent columns become typed nulls (P13: an all-null column keeps its
    type; nothing is ever stored as the text "None" or as a void column).
    """
    have = df.schema
    return df.selectExpr(*[f"{_typed(_field(have, f.name), f.dataType)} AS {ident(f.name)}" for f in schema.fields])


def availability_sql(have: T.StructType) -> dict[str, str]:
    """SQL text of each column of the flight table, from records of a schema."""
    route = {n for n, _ in S.ROUTE_FIELDS}
    return {f.name: _typed(_field(have, f"Route.{f.name}" if f.name in route else f.name), f.dataType) for f in S.AVAILABILITY.fields}


def flatten_availability(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Nested availability records -> the 94-column flight table.

    Route fields are lifted from the nested ``Route`` struct (a missing or
    null route gives null fields); ``Route.ID``, ``Route.Source`` and
    ``AvailabilityTrips`` are not selected.  One output row per input row.
    ``keep`` carries extra columns (e.g. page and position) through.
    """
    cols = [f"{sql} AS {ident(name)}" for name, sql in availability_sql(records.schema).items()]
    return records.selectExpr(*cols, *map(ident, keep))


def flatten_hotels(details: DataFrame) -> DataFrame:
    """Hotel details -> 14 columns; string-or-int fields kept as text."""
    return enforce_schema(details, S.HOTELS)


def flatten_hotel_availability(rows: DataFrame) -> DataFrame:
    """Calendar rows -> 7 columns; ``available`` defaults to False."""
    out = enforce_schema(rows, S.HOTEL_AVAILABILITY)
    return out.withColumn("available", F.coalesce(F.col("available"), F.lit(False)))


def hotel_url(site: Column | str, path: Column | str) -> Column:
    """Site without trailing '/', path without leading '/', one '/' between."""
    site_c = F.col(site) if isinstance(site, str) else site
    path_c = F.col(path) if isinstance(path, str) else path
    return F.concat(F.regexp_replace(site_c, "/+$", ""), F.lit("/"), F.regexp_replace(path_c, "^/+", ""))


def tag(df: DataFrame, **values) -> DataFrame:
    """Add request-level constants (nid, currency, is_points, url...)."""
    return df.select("*", *[F.lit(v).alias(k) for k, v in values.items()])


def numeric_text(c: Column) -> Column:
    """Numeric text such as a mileage cost ("" and "0" are legal) as int."""
    return F.nullif(F.trim(c), F.lit("")).try_cast(T.IntegerType())
