"""JSON sources: availability pages, routes, trips (open records), rate
calendars (S1-S4, S7, P6, X3, X9, X10).

Every reader takes either landed files (``spark.read.json`` with a declared
schema, never inference) or a text column (``from_json``), so the same code
serves files, streams and derived test data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakefold import schemas as S


def read_json_files(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True) -> DataFrame:
    """Landed JSON documents (one page / calendar per file) with their file."""
    df = spark.read.schema(schema).option("multiLine", multiline).option("mode", "PERMISSIVE").json(path)
    return df.withColumn("_file", F.col("_metadata.file_path"))


def page_records(pages: DataFrame, page_col: str | None = None) -> DataFrame:
    """Page objects -> one row per record, with page number and position.

    ``page_col`` names a column that orders pages (e.g. the cursor); each
    record keeps ``_page`` and ``_pos`` so later folds know which version is
    newer.  Empty pages give no rows (``posexplode`` on an empty array).
    """
    order = F.col(page_col) if page_col else F.col("cursor")
    return pages.select(
        order.alias("_page"),
        F.col("hasMore").alias("_has_more"),
        F.col("count").alias("_declared"),
        F.posexplode("data").alias("_pos", "_rec"),
    ).select("_page", "_has_more", "_declared", "_pos", "_rec.*")


def parse_pages(df: DataFrame, text_col: str, schema: T.StructType = S.AVAILABILITY_PAGE) -> DataFrame:
    """S1 on a text column: JSON page text -> page struct columns."""
    return df.select("*", F.from_json(F.col(text_col), schema).alias("_p")).select("*", "_p.*").drop("_p")


def routes(df: DataFrame, text_col: str) -> DataFrame:
    """A top-level JSON array of routes -> one row per route."""
    arr = F.from_json(F.col(text_col), T.ArrayType(S.ROUTE))
    return df.select(F.explode(arr).alias("r")).select("r.*")


def unwrap_trip(text: Column) -> Column:
    """S3: open-schema trip; the first element of ``data`` when it is a
    non-empty array, else the object itself (extra fields kept, variant)."""
    v = F.try_parse_json(text)
    first = F.try_variant_get(v, "$.data[0]", "variant")
    return F.coalesce(first, v)


def trip_field(trip: Column, field: str, dtype: str = "string") -> Column:
    return F.try_variant_get(trip, f"$.{field}", dtype)


def calendar_rows(df: DataFrame, text_col: str, nid: Column | str, is_points: Column | bool) -> DataFrame:
    """Rate calendar JSON -> one row per date, tagged.

    An empty *list* in place of the ``results`` map parses to null and gives
    no rows (P6).  ``_declared`` keeps the declared count for A5.
    """
    nid_c = F.col(nid) if isinstance(nid, str) else nid
    pts = F.lit(is_points) if isinstance(is_points, bool) else is_points
    cal = F.from_json(F.col(text_col), S.RATE_CALENDAR)
    base = df.select(nid_c.cast("long").alias("nid"), pts.alias("is_points"), cal.alias("c"))
    return base.select(
        "nid",
        "is_points",
        F.col("c.count").alias("_declared"),
        F.col("c.currency_code").alias("currency_code"),
        F.explode(F.coalesce(F.col("c.results"), F.create_map().cast(S.RATE_CALENDAR["results"].dataType))).alias("date", "r"),
    ).select(
        "nid",
        "currency_code",
        "date",
        "is_points",
        F.col("r.lowestRate").alias("lowest_rate"),
        F.col("r.lowestPointsRate").alias("lowest_points_rate"),
        F.coalesce(F.col("r.available"), F.lit(False)).alias("available"),
        "_declared",
    )


# Where a hotel page's JSON holds the columns of the hotels
# table, and the kinds of value that each may have.
_CONTENT, _META = "props.pageProps.nodeContent", "props.pageProps.metaTags"
HOTEL_PATHS = {
    "nid": (f"{_CONTENT}.nid", "int"),
    "name": (f"{_CONTENT}.fieldDisplayTitle", "text"),
    "canonical_url": (f"{_META}.canonical_url", "text"),
    "code": (f"{_CONTENT}.fieldItemCode", "text"),
    "num_rooms": (f"{_CONTENT}.fieldNumRooms", "int"),
    "country": (f"{_CONTENT}.fieldCountryName", "text"),
    "title": (f"{_META}.title", "text"),
    "description": (f"{_META}.description", "text"),
    "choice_points": (f"{_CONTENT}.choicePointsValue", "text or int"),
    "average_rate": (f"{_CONTENT}.fieldAvgRateDisplay", "text"),
    "synxis_id": (f"{_CONTENT}.fieldSynxisId", "text or int"),
    "book_with_points": (f"{_CONTENT}.fieldIPreferBookWithPoints", "bool"),
    "book_with_choice": (f"{_CONTENT}.participatesInChoicePoints", "bool"),
}
_CASTS = {"int": "long", "text": "string", "text or int": "string", "bool": "boolean", "number": "double"}


def variant_field(v: Column, path: str, kind: str) -> tuple[Column, Column]:
    """(value, whether a value is there that is not of the kind) of a path in
    a variant.  Any part of the path may be missing: the value is then null.
    Numbers may come as text, text not as numbers unless the kind says so."""
    where = f"$.{path}" if path else "$"
    raw, value = F.try_variant_get(v, where, "variant"), F.try_variant_get(v, where, _CASTS[kind])
    shape = F.schema_of_variant(raw)
    wrong = value.isNull()
    if kind.startswith("text"):
        wrong = ~(shape == "STRING") if kind == "text" else ~shape.isin("STRING", "BIGINT")
    elif kind == "int":
        exact = F.try_variant_get(v, where, "double")
        wrong = value.isNull() | shape.isin("BOOLEAN") | (exact != value)
    elif kind == "bool":  # a truth value, its text, 0 or 1
        number = F.coalesce(F.try_variant_get(v, where, "long"), F.lit(2))
        wrong = value.isNull() | ~(shape.isin("BOOLEAN", "STRING") | (shape == "BIGINT") & number.isin(0, 1))
    there = raw.isNotNull() & ~F.coalesce(F.is_variant_null(raw), F.lit(False))
    return F.when(there, value), there & F.coalesce(wrong, F.lit(True))


def hotel_details(pages: DataFrame, json_col: str, url_col: str = "url") -> DataFrame:
    """The JSON of hotel pages -> the 14 hotel columns and ``_reasons``:
    no JSON, no ``nid``, or values of another kind.  Other columns stay."""
    rows = pages.withColumn("_json", F.try_parse_json(F.col(json_col)))
    found = {c: variant_field(F.col("_json"), path, kind) for c, (path, kind) in HOTEL_PATHS.items()}
    checks = [F.when(F.col("_json").isNull(), F.lit("json")),
              F.when(F.col("_json").isNotNull() & found["nid"][0].isNull() & ~found["nid"][1], F.lit("missing:nid")),
              *(F.when(F.col("_json").isNotNull() & wrong, F.lit(f"type:{c}")) for c, (_, wrong) in found.items())]
    mine = {"url": F.col(url_col)} | {c: value for c, (value, _) in found.items()}
    keep = [c for c in pages.columns if c not in (json_col, *mine)]
    return rows.select(*keep, *(mine[f.name].cast(f.dataType).alias(f.name) for f in S.HOTELS.fields),
                       F.array_compact(F.array(*checks)).alias("_reasons"))


def calendar_reasons(text: Column) -> Column:
    """P5 for a rate calendar's JSON: what is wrong with it, over all its days
    (empty: nothing).  ``results`` is a map of days, or an empty list.  One bad
    day rejects its calendar, as one bad record rejects its page."""
    v = F.try_parse_json(text)
    count, bad_count = variant_field(v, "count", "int")
    _, bad_currency = variant_field(v, "currency_code", "text")
    results = F.try_variant_get(v, "$.results", "variant")
    shape = F.coalesce(F.schema_of_variant(results), F.lit("VOID"))
    no_map = results.isNotNull() & ~shape.startswith("OBJECT") & (shape != "ARRAY<VOID>")
    days = F.map_values(F.try_variant_get(v, "$.results", "map<string,variant>"))

    def any_day(field: str, kind: str) -> Column:
        return F.coalesce(F.exists(days, lambda d: variant_field(d, field, kind)[1]), F.lit(False))

    no_day = F.coalesce(F.exists(days, lambda d: ~F.coalesce(F.schema_of_variant(d).startswith("OBJECT"), F.lit(False))), F.lit(False))
    told = [(v.isNull(), "json"), (v.isNotNull() & count.isNull() & ~bad_count, "missing:count"), (bad_count, "type:count"),
            (bad_currency, "type:currency_code"), (no_map, "type:results"), (no_day, "type:results[]"),
            *((any_day(f, k), f"type:results[].{f}") for f, k in (("lowestRate", "number"), ("lowestPointsRate", "int"), ("available", "bool")))]
    return F.array_compact(F.array(*(F.when(F.coalesce(cond, F.lit(False)), F.lit(reason)) for cond, reason in told)))


def route_reasons(text: Column) -> Column:
    """P5 for a landed array of routes: what is wrong with it, over all its
    routes (empty: nothing).  All fields of a route are required; one bad
    route rejects the whole page."""
    v = F.try_parse_json(text)
    is_list = F.coalesce(F.schema_of_variant(v).startswith("ARRAY"), F.lit(False))
    items = F.when(is_list, F.try_variant_get(v, "$", "array<variant>"))
    some = lambda test: F.coalesce(F.exists(items, test), F.lit(False))
    no_object = some(lambda x: ~F.coalesce(F.schema_of_variant(x).startswith("OBJECT"), F.lit(False)))
    told = [(v.isNull(), "json"), (v.isNotNull() & ~is_list, "type:routes"), (no_object, "type:routes[]")]
    def field_is(test, name: str, kind: str) -> Column:
        return some(lambda x: test(*variant_field(x, name, kind)))

    for f in S.ROUTE.fields:
        kind = "int" if isinstance(f.dataType, T.IntegerType) else "text"
        missing = field_is(lambda value, wrong: value.isNull() & ~wrong, f.name, kind) & ~no_object
        told += [(missing, f"missing:routes[].{f.name}"), (field_is(lambda value, wrong: wrong, f.name, kind), f"type:routes[].{f.name}")]
    return F.array_compact(F.array(*(F.when(F.coalesce(cond, F.lit(False)), F.lit(reason)) for cond, reason in told)))


def request_params(**params) -> dict:
    """Drop unset parameters; dates become ISO text."""
    import datetime as _dt

    out = {}
    for k, v in params.items():
        if v is None:
            continue
        out[k] = v.isoformat() if isinstance(v, (_dt.date, _dt.datetime)) else v
    return out
