"""Flight availability plans: records -> flat table -> hashed batch -> merge."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from lakefold.functions.hashing import add_metadata
from lakefold.operators.merge import dedup_latest, merge_changes, merge_state
from lakefold.operators.shape import flatten_availability
from lakefold.plans import derive
from lakefold.schemas import CONTENT_HASH, FLIGHT_KEYS

# Fixed instant used by queries so their output is deterministic.
QUERY_INGESTION_TS = _dt.datetime(2025, 1, 1, tzinfo=_dt.timezone.utc)


def availability_batch(records: DataFrame, ingestion_ts: _dt.datetime | None = None) -> DataFrame:
    """P1 + P10-P12: flatten nested records, then ingestion time + hash."""
    return add_metadata(flatten_availability(records), ingestion_ts)


def snapshot(spark: SparkSession, sf_dir: str, as_of: str | None) -> DataFrame:
    return availability_batch(derive.availability_records(spark, sf_dir, as_of), QUERY_INGESTION_TS)


def _sides(spark: SparkSession, sf_dir: str, keys: list[str], columns: list[str] | None) -> tuple[DataFrame, DataFrame]:
    """The earlier snapshot and the full one, one row a key, with the keys,
    the hash and ``columns`` (None: all) of their rows."""
    base, batch = snapshot(spark, sf_dir, derive.BASE_AS_OF), snapshot(spark, sf_dir, None)
    if columns is not None:
        want = list(dict.fromkeys([*keys, CONTENT_HASH, *columns]))
        base, batch = base.select(*want), batch.select(*dict.fromkeys([*want, "UpdatedAt"]))
    batch = dedup_latest(batch, keys, ["UpdatedAt"])
    return base, batch.select(*base.columns)


def snapshot_merge(spark: SparkSession, sf_dir: str, keys: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """Flagship: merge the full snapshot into the earlier snapshot.

    Orders placed after the boundary are inserts, orders whose line items
    shipped after it changed (updates), the rest are unchanged.  ``columns``
    names the payload that the caller wants of the state: nothing else is
    moved (None: all of it).
    """
    keys = keys or ["ID"]
    return merge_state(*_sides(spark, sf_dir, keys, columns), keys)


def snapshot_changes(spark: SparkSession, sf_dir: str, keys: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """The writer's view of the same merge: batch rows tagged by action,
    reading only keys + hash of the stored side."""
    keys = keys or ["ID"]
    return merge_changes(*_sides(spark, sf_dir, keys, columns), keys)


DEFAULT_KEYS = FLIGHT_KEYS
