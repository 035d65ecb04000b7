import pytest
from conftest import at
from pyspark.sql import types as T

from vantrail.operators import validate as v
from vantrail.schema import EVENT_REQUEST
from vantrail.sources.payloads import parse_bodies

NOW = at("2025-06-01T00:00:00")
LOOSE = T.StructType([T.StructField(f.name, f.dataType) for f in EVENT_REQUEST.fields])
GOOD = dict(
    event_id="e1",
    icao24="abc123",
    origin_country="GB",
    observed_at="2025-01-01T10:00:00Z",
    position_source="ADSB",
    lat=1.0,
    lon=1.0,
)


def request(spark, *changes):
    rows = [tuple({**GOOD, **c}.get(n) for n in LOOSE.fieldNames()) for c in changes]
    return spark.createDataFrame(rows, LOOSE)


BAD = [
    ({"event_id": ""}, "event_id is required"),
    ({"icao24": None}, "icao24 is required"),
    ({"icao24": "ABC123"}, 'icao24 must be 6 lowercase hex chars: "ABC123"'),
    ({"icao24": "xyz"}, 'icao24 must be 6 lowercase hex chars: "xyz"'),
    ({"icao24": "abc12g"}, 'icao24 must be 6 lowercase hex chars: "abc12g"'),
    ({"icao24": "abc123\n"}, 'icao24 must be 6 lowercase hex chars: "abc123\\n"'),
    ({"icao24": "\x1b\x00é\U0001f600\\"}, 'icao24 must be 6 lowercase hex chars: "\\x1b\\x00é\U0001f600\\\\"'),
    ({"origin_country": ""}, "origin_country is required"),
    ({"observed_at": ""}, "observed_at is required"),
    ({"position_source": ""}, "position_source is required"),
    ({"position_source": "GPS"}, 'position_source "GPS" is not one of ADSB, ASTERIX, MLAT, FLARM, UNKNOWN'),
    ({"observed_at": "not-a-date"}, "observed_at is not valid RFC3339"),
    ({"observed_at": "2025-01-01"}, "observed_at is not valid RFC3339"),
    ({"observed_at": "2025-01-01T10:00:00"}, "observed_at is not valid RFC3339"),
    ({"observed_at": "2025-13-01T10:00:00Z"}, "observed_at is not valid RFC3339"),
    ({"observed_at": "2025-06-02T00:00:00.000001Z"}, "observed_at is too far in the future (>24h)"),
    ({"lat": 91.0}, "lat out of range [-90, 90]: 91.000000"),
    ({"lat": -91.0}, "lat out of range [-90, 90]: -91.000000"),
    ({"lon": 181.0}, "lon out of range [-180, 180]: 181.000000"),
    ({"velocity_ms": -1.0}, "velocity_ms must be >= 0: -1.000000"),
    ({"true_track_deg": 360.0}, "true_track_deg must be in [0, 360): 360.000000"),
    ({"true_track_deg": -0.5}, "true_track_deg must be in [0, 360): -0.500000"),
    ({"squawk": "9999"}, 'squawk must be 4 octal digits (0-7): "9999"'),
    ({"squawk": "123"}, 'squawk must be 4 octal digits (0-7): "123"'),
    ({"category": 21}, "category out of OpenSky range [0, 20]: 21"),
    ({"category": -1}, "category out of OpenSky range [0, 20]: -1"),
    ({"category": 2**40}, f"category out of OpenSky range [0, 20]: {2**40}"),
    # The first rule in order wins.
    ({"squawk": "9999", "lat": 200.0, "icao24": ""}, "icao24 is required"),
]
FINE = [
    {},
    {"observed_at": "2025-06-02T00:00:00Z"},
    {"observed_at": "1970-01-01T00:00:00.123456789+05:30"},
    {"lat": 90.0, "lon": -180.0},
    {"lat": None, "lon": None},
    {"velocity_ms": 0.0, "true_track_deg": 359.9},
    {"squawk": ""},
    {"squawk": "7700", "category": 20},
    {"category": 0},
]


def test_rejected(spark):
    # One row at a time would be one job each; ids keep the pairs apart.
    for chunk in (BAD,):
        df = request(spark, *[c for c, _ in chunk])
        got = [r["error"] for r in v.check(df.coalesce(1), NOW).collect()]
        assert got == [e for _, e in chunk]


def test_accepted(spark):
    good, bad = v.validate(request(spark, *FINE), NOW)
    assert good.count() == len(FINE) and bad.count() == 0
    rows = v.to_telemetry(good).collect()
    assert all(r["lat"] is not None and r["on_ground"] is False for r in rows)


def report(spark, body):
    bodies = spark.createDataFrame([("r", body)], "request_id string, body string")
    return v.ingest_report(parse_bodies(bodies), NOW).first()


def item(**changes):
    import json

    return json.dumps({**GOOD, **changes})


def test_report(spark):
    row = report(spark, f"[{item(event_id='a')},{item(event_id='b', lat=200)},{item(event_id='c')}]")
    assert (row["accepted"], row["rejected"], row["outcome"]) == (2, 1, 202)
    assert [(e["index"], e["event_id"]) for e in row["errors"]] == [(1, "b")]


@pytest.mark.parametrize("body, outcome", [('{"events":[]}', 202), ("", 400), (item(icao24=""), 400), (item(), 202)])
def test_outcomes(spark, body, outcome):
    assert report(spark, body)["outcome"] == outcome


def test_quarantine_counts(spark):
    df = request(spark, {}, {"lat": 91.0}, {"icao24": ""})
    checked, counts = v.quarantine(df, NOW, "three")
    assert [r["error"] is None for r in checked.collect()].count(True) == 1
    assert counts.get == {"accepted": 1, "rejected": 2}
