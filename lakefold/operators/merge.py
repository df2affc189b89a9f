"""Keyed upsert as pure DataFrame operators.

``merge_changes`` is what a writer needs: the batch rows tagged
insert / update / unchanged, reading only keys + hash of the target.
``merge_state`` is the full new state (for queries and oracle checks).

Scale notes
-----------
* The batch is deduplicated per key with ``max_by`` under ``groupBy``: a
  partial (map-side) aggregate, so a hot key is combined before the shuffle
  instead of landing whole in one task (a window would not).
* The change join reads only (keys, hash) of the target; Spark picks a
  broadcast of the smaller side only when its measured size is under
  ``spark.sql.adaptive.autoBroadcastJoinThreshold`` (AQE), else sort-merge
  with skew-split of oversized partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakefold.functions.hashing import ident
from lakefold.schemas import CONTENT_HASH

ACTION = "_action"
INSERT, UPDATE, UNCHANGED, KEPT = "insert", "update", "unchanged", "kept"


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def null_key(keys: Sequence[str]) -> Column:
    """True when any key part is null (Q4: such rows can never match)."""
    cond = F.lit(False)
    for k in keys:
        cond = cond | _q(k).isNull()
    return cond


def split_null_keys(batch: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a full key, rows with a null key part -> rejects)."""
    bad = null_key(keys)
    return batch.filter(~bad), batch.filter(bad)


def dedup_latest(batch: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key, the latest by ``order`` (ties by content hash).

    Partial aggregation (``max_by``) keeps a hot key from becoming a single
    oversized task.
    """
    cols = batch.columns
    others = [c for c in cols if c not in keys]
    if not others:
        return batch.dropDuplicates(list(keys))
    tie = [c for c in [CONTENT_HASH] if c in cols and c not in order]
    rank_cols = list(order) + tie or others
    packed = f"max_by(struct({', '.join(map(ident, others))}), struct({', '.join(map(ident, rank_cols))})) AS _row"
    return (
        batch.groupBy(*[_q(k) for k in keys])
        .agg(F.expr(packed))
        .selectExpr(*[ident(c) if c in keys else f"_row.{ident(c)} AS {ident(c)}" for c in cols])
    )


def merge_changes(
    target: DataFrame | None,
    batch: DataFrame,
    keys: Sequence[str],
    hash_col: str = CONTENT_HASH,
) -> DataFrame:
    """Batch rows + ``_action`` in {insert, update, unchanged}.

    Only the key columns and the hash of ``target`` are read (column pruning
    reaches the scan).  A null stored hash counts as changed (``<=>``).
    """
    if target is None:
        return batch.withColumn(ACTION, F.lit(INSERT))
    t = target.select(*[_q(k) for k in keys], _q(hash_col).alias("_t_hash"), F.lit(True).alias("_t_hit"))
    j = batch.join(t, list(keys), "left")
    action = (
        F.when(F.col("_t_hit").isNull(), F.lit(INSERT))
        .when(~_q(hash_col).eqNullSafe(F.col("_t_hash")), F.lit(UPDATE))
        .otherwise(F.lit(UNCHANGED))
    )
    return j.withColumn(ACTION, action).drop("_t_hash", "_t_hit")


def merge_state(
    target: DataFrame | None,
    batch: DataFrame,
    keys: Sequence[str],
    hash_col: str = CONTENT_HASH,
) -> DataFrame:
    """Complete state after the upsert, with ``_action`` per row.

    insert / update -> the batch row; unchanged -> the stored row (its old
    ingestion time stays, Q9); kept -> stored row absent from the batch (Q8).
    One full outer join = one shuffle of both sides on the keys, of the keys,
    the hash and those columns that are asked of the result: each column
    stands by itself, so that the others are pruned below the exchange (counts
    by action move keys and hashes only).
    """
    if target is None:
        return batch.withColumn(ACTION, F.lit(INSERT))
    cols = target.columns
    other = [c for c in cols if c not in keys]
    side = lambda df, p: df.selectExpr(*map(ident, keys), *(f"{ident(c)} AS {ident(p + c)}" for c in other), f"true AS {p}_hit")
    j = side(target, "_t_").join(side(batch, "_b_"), list(keys), "full")
    action = (
        f"CASE WHEN _t__hit IS NULL THEN '{INSERT}' WHEN _b__hit IS NULL THEN '{KEPT}' "
        f"WHEN NOT ({ident('_b_' + hash_col)} <=> {ident('_t_' + hash_col)}) THEN '{UPDATE}' ELSE '{UNCHANGED}' END"
    )
    j = j.selectExpr("*", f"{action} AS {ACTION}")
    take = f"{ACTION} IN ('{INSERT}', '{UPDATE}')"
    return j.selectExpr(
        *[ident(c) if c in keys else f"CASE WHEN {take} THEN {ident('_b_' + c)} ELSE {ident('_t_' + c)} END AS {ident(c)}" for c in cols],
        ACTION,
    )


def merge_counts(tagged: DataFrame) -> DataFrame:
    """A1: one pass over a tagged frame -> rows per action."""
    return tagged.groupBy(ACTION).agg(F.count(F.lit(1)).alias("rows"))
