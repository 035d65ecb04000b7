import json

import pytest

from vantrail.sources.payloads import explode_payloads

EVENT = {
    "event_id": "a",
    "icao24": "abc123",
    "origin_country": "GB",
    "observed_at": "2025-01-01T10:00:00Z",
    "position_source": "ADSB",
    "lat": 1.5,
    "lon": 2,
    "on_ground": False,
}
ONE = json.dumps(EVENT)


def parse(spark, body):
    events, refused = explode_payloads(spark.createDataFrame([("r", body)], "request_id string, body string"))
    return events.orderBy("index").collect(), [r["body_error"] for r in refused.collect()]


@pytest.mark.parametrize(
    "body, count",
    [
        (ONE, 1),
        (f'{{"events":[{ONE},{ONE}]}}', 2),
        ('{"events":[]}', 0),
        ('{"events":null}', 0),
        (f"[{ONE},{ONE},{ONE}]", 3),
        ("[]", 0),
        (f" \n\t{ONE}", 1),
        ("{}", 1),
        ("[null]", 1),
        (ONE[:-1] + ',"unknown":{"x":[1]}}', 1),
    ],
)
def test_shapes(spark, body, count):
    events, errors = parse(spark, body)
    assert len(events) == count and errors == []
    assert [e["index"] for e in events] == list(range(count))


@pytest.mark.parametrize(
    "body, error",
    [
        (None, "empty body"),
        ("", "empty body"),
        ("  \n", "empty body"),
        ("hello", "expected JSON object or array"),
        ("17", "expected JSON object or array"),
        (ONE[:40], "invalid JSON object"),
        (ONE + " x", "invalid JSON object"),
        (ONE + "," + ONE, "invalid JSON object"),
        (f"[{ONE}", "invalid JSON array"),
        ('[{"event_id":5}]', "invalid JSON array"),
        ('[{"lat":"5"}]', "invalid JSON array"),
        ('[{"on_ground":1}]', "invalid JSON array"),
        ('[{"category":1.5}]', "invalid JSON array"),
        ("[1]", "invalid JSON array"),
        ('{"events":5}', "invalid JSON in events array"),
        (f'{{"events":{ONE}}}', "invalid JSON in events array"),
        ('{"events":[{"spi":"no"}]}', "invalid JSON in events array"),
        ('{"event_id":{}}', "invalid JSON object"),
    ],
)
def test_refused(spark, body, error):
    assert parse(spark, body) == ([], [error])


def test_values(spark):
    full = EVENT | {"callsign": "BAW1", "velocity_ms": 12, "category": 3, "squawk": None, "lat": 1e1}
    row = parse(spark, json.dumps(full))[0][0]
    assert (row["lat"], row["lon"], row["velocity_ms"], row["category"]) == (10.0, 2.0, 12.0, 3)
    assert row["squawk"] is None and row["callsign"] == "BAW1" and row["spi"] is None


def test_known_names_inside_unknown_objects(spark):
    """Only the event's own fields are typed, not what an unknown object holds."""
    inner = json.dumps(EVENT | {"extra": {"event_id": 5, "lat": "x"}, "more": [{"spi": 1}]})
    events, errors = parse(spark, inner)
    assert errors == [] and events[0]["event_id"] == "a"
    assert parse(spark, json.dumps(EVENT | {"extra": {"lat": 1}, "lat": "x"}))[1] == ["invalid JSON object"]


def test_body_size_limit(spark):
    from vantrail.schema import MAX_BODY_BYTES

    room = MAX_BODY_BYTES - len(ONE)
    assert parse(spark, ONE + " " * room)[1] == []
    assert parse(spark, ONE + " " * (room + 1))[1] == [f"request body exceeds {MAX_BODY_BYTES} bytes"]
