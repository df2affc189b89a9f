"""Content hash and ingestion metadata as native Spark expressions.

Contract: deterministic, independent of column order and of the batch the
row arrives in (the declared type decides the text, not the data), nulls kept
as JSON ``null``, 16 lower-case hex characters (first 64 bits of SHA-256).

Canonical text = ``to_json`` of a struct of the hashed columns in name order,
with doubles/decimals as their shortest decimal text, dates as
``yyyy-MM-dd`` and timestamps as ``yyyy-MM-ddTHH:mm:ss.ffffff`` (UTC).  All of
it runs inside whole-stage codegen; there is no Python on the row path.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakefold.schemas import CONTENT_HASH, HASH_LENGTH, INGESTION_TS

METADATA_COLUMNS = [INGESTION_TS, CONTENT_HASH]
TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def ident(name: str) -> str:
    """Quoted SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def canonical_sql(c: str, dtype: T.DataType) -> str:
    """SQL text of the text-stable form of one column (or expression) for hashing."""
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return f"CAST({c} AS STRING)"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return f'date_format({c}, "{TS_TEXT}")'
    if isinstance(dtype, T.DateType):
        return f'date_format({c}, "yyyy-MM-dd")'
    if isinstance(dtype, T.BinaryType):
        return f"base64({c})"
    return c


def hash_columns(schema: T.StructType, exclude: Iterable[str] | None = None) -> list[str]:
    skip = set(METADATA_COLUMNS) | set(exclude or [])
    return sorted(c for c in schema.fieldNames() if c not in skip)


def content_hash_sql(schema: T.StructType, exclude: Iterable[str] | None = None, exprs: dict[str, str] | None = None) -> str:
    """``exprs``: what stands for a column (default: the column of that name)."""
    types, of = {f.name: f.dataType for f in schema.fields}, exprs or {}
    fields = ", ".join(f"'{c}', {canonical_sql(of.get(c, ident(c)), types[c])}" for c in hash_columns(schema, exclude))
    text = f"to_json(named_struct({fields}), map('ignoreNullFields', 'false'))"
    return f"substring(sha2({text}, 256), 1, {HASH_LENGTH})"


def content_hash_expr(df: DataFrame, exclude: Iterable[str] | None = None, schema: T.StructType | None = None) -> Column:
    """16-hex content hash over all columns except ``exclude`` and metadata.

    Built as one SQL expression (parsed once in the JVM) rather than a tree
    of Python column objects: the flight table hashes 94 columns.
    """
    return F.expr(content_hash_sql(schema or df.schema, exclude))


def with_content_hash(df: DataFrame, exclude: Iterable[str] | None = None) -> DataFrame:
    return df.withColumn(CONTENT_HASH, content_hash_expr(df, exclude))


def add_metadata(
    df: DataFrame,
    ingestion_ts: _dt.datetime | None = None,
    hash_exclude: Iterable[str] | None = None,
) -> DataFrame:
    """Add ``ingestion_timestamp`` (one instant per batch) and ``content_hash``.

    The instant is taken once on the driver (or passed in, which keeps a
    query deterministic), never per task.  The input frame is not changed.
    """
    ts = ingestion_ts or _dt.datetime.now(_dt.timezone.utc)
    if ts.tzinfo is None:  # naive instants are taken as UTC
        ts = ts.replace(tzinfo=_dt.timezone.utc)
    schema = df.schema
    data = T.StructType([f for f in schema.fields if f.name not in METADATA_COLUMNS])
    return df.select(
        *[F.col(ident(f.name)) for f in data.fields],
        F.lit(ts).cast("timestamp").alias(INGESTION_TS),
        content_hash_expr(df, hash_exclude, data).alias(CONTENT_HASH),
    )
