"""Run statistics and summaries as aggregates.

All of them are (partial + final) aggregates over per-page or per-run
frames; nothing is looped over on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_totals(pages: DataFrame, group: Sequence[str], page_col: str = "page", ts_col: str = "timestamp") -> DataFrame:
    """A2: per program: pages, records, input / written / inserted rows,
    any(table_created), and the timestamp of the last page."""
    return pages.groupBy(*group).agg(
        F.count(F.lit(1)).alias("pages_fetched"),
        F.sum("records").alias("api_records"),
        F.sum("input_rows").alias("input_rows"),
        F.sum("rows_written").alias("rows_written"),
        F.sum("rows_inserted").alias("rows_inserted"),
        F.bool_or("table_created").alias("table_created"),
        F.max_by(F.col(ts_col), F.col(page_col)).alias("timestamp"),
    )


def with_no_data(requested: DataFrame, totals: DataFrame, key: str) -> DataFrame:
    """A3: every requested program gets a row; programs without records get
    status ``no_data`` (zero records)."""
    j = requested.join(totals, key, "left")
    return j.withColumn(
        "status", F.when(F.coalesce(F.col("api_records"), F.lit(0)) == 0, F.lit("no_data")).otherwise(F.lit("ok"))
    ).withColumn("api_records", F.coalesce(F.col("api_records"), F.lit(0)))


def bulk_summary(runs: DataFrame, name_col: str = "program", ok_col: str = "success", records_col: str = "records") -> DataFrame:
    """A4: successes, failures, total records of successful runs, and the
    sorted names of failed runs (one row per program, so the list is bounded
    by the number of programs asked for)."""
    return runs.agg(
        F.count_if(F.col(ok_col)).alias("successful"),
        F.count_if(~F.col(ok_col)).alias("failed"),
        F.coalesce(F.sum(F.when(F.col(ok_col), F.col(records_col))), F.lit(0)).alias("total_records"),
        F.array_join(F.sort_array(F.collect_list(F.when(~F.col(ok_col), F.col(name_col)))), ",").alias("failed_programs"),
    )


def combine_stages(**frames: DataFrame) -> DataFrame:
    """Several stat frames as one, tagged by stage."""
    out = None
    for stage, df in frames.items():
        tagged = df.select(F.lit(stage).alias("stage"), "*")
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out
