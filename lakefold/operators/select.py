"""Predicates, paging, page-chain cut and limits.

Predicates are plain column expressions so Catalyst pushes them into the
Parquet scan and prunes ``Source`` / ``Date`` partitions.  Numbering rows
into pages never uses an un-partitioned window: rows are range-partitioned,
numbered inside their partition, and shifted by the row counts of the
partitions before them (a frame with one row per partition).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakefold.schemas import CABIN_NAMES, CABINS


def all_of(preds: Iterable[Column | None]) -> Column:
    """F8: AND of the given predicates, unset (None) ones dropped."""
    return reduce(lambda a, b: a & b, [p for p in preds if p is not None], F.lit(True))


def _lit_date(v):
    if isinstance(v, str):
        return F.lit(v).cast("date")
    if isinstance(v, _dt.datetime):
        return F.lit(v.date())
    return F.lit(v)


def date_range(col: str, start=None, end=None) -> Column | None:
    """inclusive bounds, either may be absent."""
    c = F.col(col)
    preds = []
    if start is not None:
        preds.append(c >= _lit_date(start))
    if end is not None:
        preds.append(c <= _lit_date(end))
    return all_of(preds) if preds else None


def cabin_code(cabin: str) -> str:
    """economy/premium/business/first (or Y/W/J/F) -> cabin letter."""
    c = cabin.strip()
    if c.upper() in CABINS:
        return c.upper()
    code = CABIN_NAMES.get(c.lower())
    if code is None:
        raise ValueError(f"unknown cabin {cabin!r}; valid: {', '.join(CABIN_NAMES)}")
    return code


def cabin_column(cabin: str, metric: str, include_filtered: bool = True) -> str:
    """the filtered value or the unfiltered (``Raw``) one, chosen at plan time."""
    return f"{cabin_code(cabin)}{metric}{'' if include_filtered else 'Raw'}"


def cabin_available(cabin: str, include_filtered: bool = True) -> Column:
    return F.col(cabin_column(cabin, "Available", include_filtered)) == F.lit(True)


def in_set(col: str, values: Sequence | None) -> Column | None:
    """membership (partition pruning when ``col`` is a partition column)."""
    if values is None:
        return None
    return F.col(col).isin(list(values))


def equals(col: str, value) -> Column | None:
    """equality when the parameter is set."""
    return None if value is None else F.col(col) == F.lit(value)


def airline_list(col: str) -> Column:
    """Airlines are stored as "AC, LH, UA": split and trim."""
    return F.filter(F.transform(F.split(F.col(col), ","), lambda x: F.trim(x)), lambda x: x != F.lit(""))


def carriers_any(col: str, carriers: Sequence[str] | None) -> Column | None:
    """row flies any of ``carriers``."""
    if not carriers:
        return None
    return F.arrays_overlap(airline_list(col), F.array(*[F.lit(c.strip().upper()) for c in carriers]))


def search(
    df: DataFrame,
    origin: Sequence[str] | str | None = None,
    destination: Sequence[str] | str | None = None,
    start_date=None,
    end_date=None,
    cabins: Sequence[str] | None = None,
    sources: Sequence[str] | None = None,
    origin_region: str | None = None,
    destination_region: str | None = None,
    only_direct: bool = False,
    carriers: Sequence[str] | None = None,
    include_filtered: bool = True,
    order_by: Sequence[str] | None = None,
    skip: int = 0,
    take: int | None = None,
) -> DataFrame:
    """The cached-search parameters as predicates on the flat table;
    ``order_by`` / ``skip`` / ``take`` page through the result."""
    as_list = lambda v: [v] if isinstance(v, str) else v
    cab = [cabin_code(c) for c in cabins] if cabins else None
    preds = [
        in_set("OriginAirport", as_list(origin)),
        in_set("DestinationAirport", as_list(destination)),
        date_range("Date", start_date, end_date),
        in_set("Source", sources),
        equals("OriginRegion", origin_region),
        equals("DestinationRegion", destination_region),
    ]
    if cab or only_direct or carriers:
        # One and the same cabin must meet all that is asked of cabins.
        preds.append(reduce(lambda a, b: a | b, [
            all_of([
                cabin_available(c, include_filtered) if cab else None,
                F.col(cabin_column(c, "Direct", include_filtered)) == F.lit(True) if only_direct else None,
                carriers_any(cabin_column(c, "Airlines", include_filtered), carriers),
            ])
            for c in cab or CABINS
        ]))
    out = df.filter(all_of(preds))
    if take is not None or skip:
        order = list(order_by or ["ID"])
        out = page(out, order, skip, take) if take is not None else out.orderBy(*order).offset(skip)
    elif order_by:
        out = out.orderBy(*order_by)
    return out


def first_n(df: DataFrame, n: int | None, order: Sequence[str]) -> DataFrame:
    """the first ``n`` rows by ``order``; None = no limit, 0 = no rows
    (the reference's two readings of 0 are unified)."""
    if n is None:
        return df
    return df.orderBy(*order).limit(n)


def page(df: DataFrame, order: Sequence[str], skip: int, take: int) -> DataFrame:
    """F12 (one page): ``skip`` rows then ``take`` rows by ``order``."""
    return df.orderBy(*order).offset(skip).limit(take)


def global_row_number(df: DataFrame, order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Exact 1-based row number by ``order`` without a single-task window.

    Range partitioning gives partitions of contiguous, balanced key ranges;
    rows are numbered inside each partition and shifted by the row count of
    all earlier partitions (a frame of one row per partition, broadcast).
    ``order`` must be unique for a deterministic result."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id())
    local = ranged.withColumn("_local", F.row_number().over(Window.partitionBy("_pid").orderBy(*order)))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid", (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_off")
    )
    # ``offsets`` has one row per partition: its size is bounded by ``n``.
    out = local.join(F.broadcast(offsets), "_pid", "left")
    return out.withColumn("_row", F.coalesce(F.col("_off"), F.lit(0)) + F.col("_local")).drop("_pid", "_local", "_off")


def number_pages(df: DataFrame, order: Sequence[str], size: int, start_skip: int = 0, col: str = "page") -> DataFrame:
    """page (or batch) number of every row, ``skip = start +
    (page-1)*size``; rows before ``start_skip`` are not in any page."""
    numbered = global_row_number(df, order)
    pos = F.col("_row") - F.lit(start_skip)
    nth = F.expr(f"(_row - {int(start_skip)} - 1) div {int(size)}")
    return numbered.filter(pos >= 1).withColumn(col, nth.cast("long") + 1).drop("_row")


def cut_page_chain(pages: DataFrame, group: Sequence[str], page_col: str = "page", count_col: str = "n_records",
                   has_more_col: str = "has_more", max_pages: int | None = None) -> DataFrame:
    """which landed pages the sequential fetch loop would have used.

    Per group: stop before the first empty page, after the first page with
    ``has_more = false``, and after ``max_pages``.  Adds ``kept``.  The cut is
    a per-group aggregate joined back on the group keys."""
    last_ok = F.least(
        F.min(F.when(F.col(count_col) == 0, F.col(page_col) - 1)),
        F.min(F.when(~F.col(has_more_col), F.col(page_col))),
    )
    cuts = pages.groupBy(*group).agg(last_ok.alias("_cut"))
    j = pages.join(cuts, list(group), "left") if group else pages.withColumn("_cut", pages.agg(last_ok).scalar())
    cut = F.col("_cut")
    if max_pages is not None:
        cut = F.least(F.coalesce(cut, F.lit(max_pages)), F.lit(max_pages))
    kept = F.col(page_col) <= F.coalesce(cut, F.col(page_col))
    return j.withColumn("kept", kept & (F.col(count_col) > 0)).drop("_cut")


def top_k(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """order + limit, planned as TakeOrderedAndProject (per-partition
    top-k, then a merge of k rows per partition)."""
    return df.orderBy(*order).limit(k)


def preview(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """F16: the default ``SELECT * ... LIMIT 10`` with a stable order."""
    return df.orderBy(*order).limit(n)
