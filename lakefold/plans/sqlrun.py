"""Ad-hoc SQL over archive and test tables (Q1 of the SQL surface, S9).

``run_sql`` registers tables as temporary views, rejects blank text, plans
the statement with Spark SQL (parse -> analyze -> Catalyst -> AQE at run
time) and returns the DataFrame with statistics.  Engine-specific syntax of
other engines is not translated; Spark's error text is returned instead.
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakefold.session import scratch_table
from lakefold.storage.table import ArchiveTable

TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def register_tables(spark: SparkSession, tables: Mapping[str, str | DataFrame | ArchiveTable]) -> None:
    """Temp view per table; a string is a Parquet path (S9), an archive table
    stands for its current state."""
    for name, src in tables.items():
        df = spark.read.parquet(src) if isinstance(src, str) else src.current() if isinstance(src, ArchiveTable) else src
        df.createOrReplaceTempView(name)


def register_test_tables(spark: SparkSession, sf_dir: str) -> None:
    register_tables(spark, {t: f"{sf_dir}/{t}.parquet" for t in TEST_TABLES})


def run_sql(spark: SparkSession, sql: str, tables: Mapping[str, str | DataFrame | ArchiveTable] | None = None) -> tuple[DataFrame, dict]:
    """Plan ``sql``; the returned frame is lazy (the caller acts once)."""
    if not sql or not sql.strip():
        raise ValueError("Please enter a query.")
    if tables:
        register_tables(spark, tables)
    t0 = time.time()
    df = spark.sql(sql)
    return df, {"sql": sql, "plan_seconds": round(time.time() - t0, 4)}


def _storable(df: DataFrame) -> DataFrame:
    """Columns by place (names of a result may repeat); types that Parquet has
    no form for as text."""
    kinds = [f.dataType for f in df.schema.fields]
    placed = df.toDF(*(f"c{k}" for k in range(len(kinds))))
    odd = (T.NullType, T.CalendarIntervalType, T.DayTimeIntervalType, T.YearMonthIntervalType, T.VariantType)
    return placed.withColumns({f"c{k}": F.col(f"c{k}").cast("string") for k, t in enumerate(kinds) if isinstance(t, odd)})


def run_sql_report(spark: SparkSession, sql: str, tables: Mapping[str, str | DataFrame | ArchiveTable] | None = None, limit: int = 100) -> dict:
    """Run to completion like the interactive explorer: ``columns``, the first
    ``limit`` rows as ``data`` (in the result's order), ``rows`` of the whole
    result, ``truncated``, ``seconds``, or the ``error``'s text.

    The statement runs once, all its columns included, so an error in a
    column that is only shown surfaces too: the result is written to the
    shared scratch folder while an ``Observation`` counts it, and only the
    first rows of what was written reach the driver."""
    t0 = time.time()
    try:
        df, stats = run_sql(spark, sql, tables)
        seen = Observation()
        numbered = _storable(df).withColumn("_row", F.monotonically_increasing_id())  # grows in the result's order
        stored = scratch_table(numbered.observe(seen, F.count(F.lit(1)).alias("rows")), "result")
        stats["rows"] = int(seen.get["rows"])
        data = stored.orderBy("_row").limit(limit).drop("_row").collect()
    except (PySparkException, Py4JJavaError, ValueError) as e:
        text = str(e).strip().splitlines()
        return {"sql": sql, "error": text[0] if text else type(e).__name__}
    stats |= {"columns": df.columns, "data": [list(r) for r in data], "truncated": stats["rows"] > len(data)}
    stats["seconds"] = round(time.time() - t0, 4)
    return stats
