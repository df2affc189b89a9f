"""Declared schemas of every table and landed record.

The flight table is generated from the cabin x variant x metric product
instead of listing 94 names; the hotel tables are short and fixed.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's so results agree.
# Cabin letters and their names, in the stored column order.
CABINS = ["Y", "W", "J", "F"]
CABIN_NAMES = {"economy": "Y", "premium": "W", "business": "J", "first": "F"}
# Variant suffixes: the filtered value, then the unfiltered ("Raw") value.
VARIANTS = ["", "Raw"]
# Mileage programs known to the archive (canonical lower-case names).
PROGRAMS = [
    "aeromexico", "aeroplan", "flying_blue", "alaska", "american", "azul",
    "connectmiles", "delta_skymiles", "emirates", "ethiopian", "etihad",
    "finnair", "smiles", "jetblue", "lufthansa", "qantas", "qatar",
    "eurobonus", "saudia", "singapore", "turkish", "united",
    "virgin_atlantic", "velocity",
]
# Default merge keys and partition columns per table.
FLIGHT_KEYS = ["RouteID", "UpdatedAt"]
FLIGHT_PARTITIONS = ["Source", "Date"]
HOTEL_KEYS = ["nid"]
HOTEL_PARTITIONS = ["country"]
HOTEL_AVAIL_KEYS = ["nid", "date", "is_points"]
# Metadata columns added on save.
INGESTION_TS = "ingestion_timestamp"
CONTENT_HASH = "content_hash"
HASH_LENGTH = 16
# ---------------------------------------------------------------------------

# Per-cabin metrics in stored order: (metric name, type).  ``TaxesCurrency``
# is a single column that sits between the direct mileage cost and the taxes.
_CABIN_METRICS_BEFORE_CURRENCY = [
    ("Available", T.BooleanType()),
    ("MileageCost", None),  # string filtered value, int raw value
    ("DirectMileageCost", T.IntegerType()),
]
_CABIN_METRICS_AFTER_CURRENCY = [
    ("TotalTaxes", T.IntegerType()),
    ("DirectTotalTaxes", T.IntegerType()),
    ("RemainingSeats", T.IntegerType()),
    ("DirectRemainingSeats", T.IntegerType()),
    ("Airlines", T.StringType()),
    ("DirectAirlines", T.StringType()),
    ("Direct", T.BooleanType()),
]

ROUTE_FIELDS = [
    ("OriginAirport", T.StringType()),
    ("OriginRegion", T.StringType()),
    ("DestinationAirport", T.StringType()),
    ("DestinationRegion", T.StringType()),
    ("NumDaysOut", T.IntegerType()),
    ("Distance", T.IntegerType()),
]


def _metric_fields(metric: str, dtype: T.DataType | None) -> list[T.StructField]:
    out = []
    for variant in VARIANTS:
        for cabin in CABINS:
            if dtype is None:  # MileageCost: text when filtered, int when raw
                t = T.StringType() if variant == "" else T.IntegerType()
            else:
                t = dtype
            out.append(T.StructField(f"{cabin}{metric}{variant}", t, True))
    return out


def cabin_fields() -> list[T.StructField]:
    fields: list[T.StructField] = []
    for metric, dtype in _CABIN_METRICS_BEFORE_CURRENCY:
        fields += _metric_fields(metric, dtype)
    fields.append(T.StructField("TaxesCurrency", T.StringType(), True))
    for metric, dtype in _CABIN_METRICS_AFTER_CURRENCY:
        fields += _metric_fields(metric, dtype)
    return fields


# Flat flight availability table: 94 data columns.
AVAILABILITY = T.StructType(
    [
        T.StructField("ID", T.StringType(), True),
        T.StructField("RouteID", T.StringType(), True),
        T.StructField("Date", T.DateType(), True),
        T.StructField("ParsedDate", T.TimestampType(), True),
    ]
    + [T.StructField(n, t, True) for n, t in ROUTE_FIELDS]
    + cabin_fields()
    + [
        T.StructField("Source", T.StringType(), True),
        T.StructField("CreatedAt", T.TimestampType(), True),
        T.StructField("UpdatedAt", T.TimestampType(), True),
    ]
)
CABIN_COLUMNS = [f.name for f in cabin_fields()]
AVAILABILITY_COLUMNS = AVAILABILITY.fieldNames()

# Nested route as landed (ID and Source are dropped on flatten).
ROUTE = T.StructType(
    [T.StructField("ID", T.StringType(), True)]
    + [T.StructField(n, t, True) for n, t in ROUTE_FIELDS]
    + [T.StructField("Source", T.StringType(), True)]
)

# A landed availability record: identifiers and timestamps are ISO text,
# the route is nested, trips are kept as raw JSON text.
AVAILABILITY_RECORD = T.StructType(
    [
        T.StructField("ID", T.StringType(), True),
        T.StructField("RouteID", T.StringType(), True),
        T.StructField("Route", ROUTE, True),
        T.StructField("Date", T.StringType(), True),
        T.StructField("ParsedDate", T.StringType(), True),
    ]
    + cabin_fields()
    + [
        T.StructField("Source", T.StringType(), True),
        T.StructField("CreatedAt", T.StringType(), True),
        T.StructField("UpdatedAt", T.StringType(), True),
        T.StructField("AvailabilityTrips", T.StringType(), True),
    ]
)

# One landed page of bulk availability.
AVAILABILITY_PAGE = T.StructType(
    [
        T.StructField("data", T.ArrayType(AVAILABILITY_RECORD), True),
        T.StructField("count", T.IntegerType(), True),
        T.StructField("hasMore", T.BooleanType(), True),
        T.StructField("moreURL", T.StringType(), True),
        T.StructField("cursor", T.LongType(), True),
    ]
)

HOTEL_LINK = T.StructType(
    [
        T.StructField("site", T.StringType(), False),
        T.StructField("path", T.StringType(), False),
        T.StructField("title", T.StringType(), False),
    ]
)

# Hotels table: 14 columns in this order.
HOTELS = T.StructType(
    [
        T.StructField("nid", T.LongType(), False),
        T.StructField("name", T.StringType(), True),
        T.StructField("url", T.StringType(), False),
        T.StructField("canonical_url", T.StringType(), True),
        T.StructField("code", T.StringType(), True),
        T.StructField("num_rooms", T.IntegerType(), True),
        T.StructField("country", T.StringType(), True),
        T.StructField("title", T.StringType(), True),
        T.StructField("description", T.StringType(), True),
        T.StructField("choice_points", T.StringType(), True),
        T.StructField("average_rate", T.StringType(), True),
        T.StructField("synxis_id", T.StringType(), True),
        T.StructField("book_with_points", T.BooleanType(), True),
        T.StructField("book_with_choice", T.BooleanType(), True),
    ]
)

# Hotel availability table: 7 columns in this order.
HOTEL_AVAILABILITY = T.StructType(
    [
        T.StructField("nid", T.LongType(), False),
        T.StructField("currency_code", T.StringType(), True),
        T.StructField("date", T.StringType(), False),
        T.StructField("is_points", T.BooleanType(), False),
        T.StructField("lowest_rate", T.DoubleType(), True),
        T.StructField("lowest_points_rate", T.IntegerType(), True),
        T.StructField("available", T.BooleanType(), False),
    ]
)

RATE_DAY = T.StructType(
    [
        T.StructField("lowestRate", T.DoubleType(), True),
        T.StructField("lowestPointsRate", T.IntegerType(), True),
        T.StructField("available", T.BooleanType(), True),
    ]
)

# One landed rate calendar (``results`` may arrive as an empty list).
RATE_CALENDAR = T.StructType(
    [
        T.StructField("count", T.IntegerType(), True),
        T.StructField("currency_code", T.StringType(), True),
        T.StructField("results", T.MapType(T.StringType(), RATE_DAY), True),
    ]
)


def with_metadata(schema: T.StructType) -> T.StructType:
    """Schema of a stored table: data columns + ingestion time + hash."""
    return T.StructType(
        list(schema.fields)
        + [
            T.StructField(INGESTION_TS, T.TimestampType(), True),
            T.StructField(CONTENT_HASH, T.StringType(), True),
        ]
    )
