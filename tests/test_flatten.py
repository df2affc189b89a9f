"""Flatten contracts for the 94-column flight table."""

from lakefold import schemas as S
from lakefold.operators.shape import enforce_schema, flatten_availability


def records(spark, rows):
    return spark.createDataFrame(rows, S.AVAILABILITY_RECORD)


def test_schema_has_94_columns_in_order():
    names = S.AVAILABILITY_COLUMNS
    assert len(names) == 94
    assert names[:10] == ["ID", "RouteID", "Date", "ParsedDate", "OriginAirport", "OriginRegion",
                          "DestinationAirport", "DestinationRegion", "NumDaysOut", "Distance"]
    assert names[10:18] == ["YAvailable", "WAvailable", "JAvailable", "FAvailable",
                            "YAvailableRaw", "WAvailableRaw", "JAvailableRaw", "FAvailableRaw"]
    assert names.index("TaxesCurrency") == 34
    assert names[-3:] == ["Source", "CreatedAt", "UpdatedAt"]
    assert dict((f.name, f.dataType.simpleString()) for f in S.AVAILABILITY.fields)["YMileageCost"] == "string"
    assert dict((f.name, f.dataType.simpleString()) for f in S.AVAILABILITY.fields)["YMileageCostRaw"] == "int"


def test_full_record_values_kept(spark, wide_rows):
    out = flatten_availability(records(spark, wide_rows)).collect()
    assert [r.ID for r in out] == ["rec0", "rec1", "rec2"]
    r0 = out[0]
    assert r0.OriginAirport == "OSL" and r0.DestinationAirport == "X00" and r0.Distance == 700
    assert r0.YMileageCost == "1000" and r0.FMileageCostRaw == 1003
    assert r0.Date.isoformat() == "2031-07-01" and r0.UpdatedAt.microsecond == 250000
    assert out[0].YAirlines == "" and out[2].YAirlines == "SK, DY" and out[2].Source == "nosuch"


def test_nested_leftovers_dropped(spark, wide_rows):
    cols = flatten_availability(records(spark, wide_rows)).columns
    assert cols == S.AVAILABILITY_COLUMNS
    assert "AvailabilityTrips" not in cols and "Route" not in cols


def test_empty_input_keeps_schema(spark):
    out = flatten_availability(records(spark, []))
    assert out.count() == 0 and out.columns == S.AVAILABILITY_COLUMNS


def test_missing_route_gives_nulls(spark, wide_rows):
    row = dict(wide_rows[0], Route=None, YMileageCost=None, YAirlines=None)
    r = flatten_availability(records(spark, [row])).collect()[0]
    assert r.OriginAirport is None and r.Distance is None and r.YMileageCost is None


def test_frame_without_route_column(spark):
    df = spark.createDataFrame([("a1", "r1")], "ID string, RouteID string")
    r = flatten_availability(df).collect()[0]
    assert r.ID == "a1" and r.OriginAirport is None and r.YAvailable is None


def test_partial_routes_give_nulls_for_what_is_absent(spark, wide_rows):
    fields = list(wide_rows[0]["Route"])
    rows = [dict(wide_rows[0], ID=f, Route={g: wide_rows[0]["Route"][g] if g == f else None for g in fields}) for f in fields]
    out = {r.ID: r for r in flatten_availability(records(spark, rows)).collect()}
    lifted = [f for f in fields if f not in ("ID", "Source")]
    for f in fields:
        assert [g for g in lifted if out[f][g] is not None] == [g for g in lifted if g == f]


def test_all_null_column_keeps_declared_type(spark):
    df = spark.createDataFrame([("a",), ("b",)], "ID string")
    out = enforce_schema(df, S.HOTELS)
    assert out.schema["num_rooms"].dataType.simpleString() == "int"
    assert [r.num_rooms for r in out.collect()] == [None, None]


def test_malformed_date_becomes_null(spark, wide_rows):
    row = dict(wide_rows[0], Date="2025-13-45")
    assert flatten_availability(records(spark, [row])).collect()[0].Date is None
