import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lakefold.session import local_session

    s = local_session(cores=4, shuffle_partitions=8, app="lakefold-tests")
    yield s


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)


def sample_record(n: int, **changed) -> dict:
    """A complete availability record whose values follow from ``n``."""
    from lakefold import schemas as S

    when = f"2031-07-{1 + n:02d}"
    r = {f.name: None for f in S.AVAILABILITY_RECORD.fields}
    r |= {"ID": f"rec{n}", "RouteID": f"leg{n % 2}", "Date": when, "ParsedDate": f"{when}T06:00:00Z", "TaxesCurrency": "NOK",
          "Source": S.PROGRAMS[n % 2], "CreatedAt": f"{when}T07:00:00.5Z", "UpdatedAt": f"{when}T08:00:00.25Z"}
    r["Route"] = {"ID": f"leg{n % 2}", "OriginAirport": "OSL", "OriginRegion": "Nordics", "DestinationAirport": f"X{n:02d}",
                  "DestinationRegion": "Oceania", "NumDaysOut": 10 + n, "Distance": 700 * (n + 1), "Source": r["Source"]}
    for k, c in enumerate(S.CABINS):
        miles = 1000 * (n + 1) + k
        r |= {f"{c}Available": (n + k) % 2 == 0, f"{c}AvailableRaw": True, f"{c}MileageCost": str(miles), f"{c}MileageCostRaw": miles,
              f"{c}Airlines": ", ".join(["SK", "DY", "WF"][: n % 4]), f"{c}Direct": k == 0, f"{c}DirectRaw": k < 2,
              f"{c}RemainingSeats": n + k}
    return r | changed


@pytest.fixture
def wide_rows():
    """Three complete records; the last one's program is unknown."""
    return [sample_record(0), sample_record(1), sample_record(2, Source="nosuch")]
