import base64

import pytest
from conftest import at
from pyspark.sql import functions as F

from vantrail.functions import cursor_token
from vantrail.operators import reads, state
from vantrail.operators.invariants import check_pages_cover_once


def token_of(text):
    return base64.urlsafe_b64encode(text.encode()).decode().rstrip("=")


@pytest.mark.parametrize(
    "bad", ["%%%", token_of("no separator"), token_of("|id"), token_of("2025-01-01T00:00:00Z|"), token_of("yesterday|id"), "ab+/",
            token_of("2024-01-20T10:00Z|x"), token_of("20240120T100000Z|x"), token_of("2024-01-20T10:00:00+0000|x"), token_of("2024-13-20T10:00:00Z|x")]
)
def test_bad_cursor(bad):
    with pytest.raises(ValueError):
        reads.decode_cursor(bad)


def test_cursor_round_trip(spark, observations):
    assert reads.decode_cursor("") is None
    df = observations({"observed_at": at("2025-01-01T10:00:00.120000")}, {"observed_at": at("10:00:00")})
    tokens = [r[0] for r in df.orderBy("seq").select(cursor_token(F.col("observed_at"), F.col("event_id"))).collect()]
    assert [reads.decode_cursor(t).at for t in tokens] == ["2025-01-01T10:00:00.12Z", "2025-01-01T10:00:00Z"]
    assert all("=" not in t and "+" not in t and "/" not in t for t in tokens)


def test_long_token_is_one_line(observations):
    row_id = "00000000-0000-0000-0000-000000000001"
    df = observations({"event_id": row_id, "observed_at": at("2025-01-01T10:00:00.123456")})
    token = df.select(cursor_token(F.col("observed_at"), F.col("event_id"))).first()[0]
    assert token == token_of(f"2025-01-01T10:00:00.123456Z|{row_id}")
    assert reads.decode_cursor(token).row_id == row_id


def test_limits():
    assert reads.check_limit(None) == 100 and reads.check_limit(1000) == 1000
    for bad in (0, -1, 1001):
        with pytest.raises(ValueError):
            reads.check_limit(bad)
    assert (reads.clamp_limit(0), reads.clamp_limit(5000), reads.clamp_limit(7)) == (100, 1000, 7)


def track(observations):
    """25 rows, many of them at the same microsecond."""
    return observations(*[{"event_id": f"{i:03d}", "observed_at": at(f"10:00:0{i // 10}")} for i in range(25)])


def test_walk_equals_paginate(observations):
    raw = track(observations)
    walked, cursor = [], None
    while True:
        rows = reads.track_page(raw, "abc123", cursor, 10).orderBy(F.desc("observed_at"), F.desc("event_id")).collect()
        walked.append([r["event_id"] for r in rows])
        cursor = next((r["next_cursor"] for r in rows if r["next_cursor"]), None)
        if cursor is None:
            break
    assert [len(p) for p in walked] == [10, 10, 5]
    for seconds in (86_400, 1):
        pages = reads.paginate(raw, 10, slice_seconds=seconds)
        by_page = {p: [r["event_id"] for r in pages.filter(F.col("page") == p).orderBy("rank").collect()] for p in range(3)}
        assert [by_page[p] for p in range(3)] == walked
        assert pages.filter("next_cursor is not null").count() == 2
        once = check_pages_cover_once(pages, raw).first()
        assert tuple(once) == (25, 0, 0, 0)


def test_exact_page_has_no_cursor(observations):
    rows = reads.track_page(track(observations), "abc123", limit=25).collect()
    assert len(rows) == 25 and all(r["next_cursor"] is None for r in rows)


def test_active_window_is_inclusive(observations):
    df = observations({"icao24": "a", "observed_at": at("09:55:00")}, {"icao24": "b", "observed_at": at("09:54:59")})
    s = state.project_state(state.latest_state(df))
    assert [r["icao24"] for r in reads.active_page(s, at("10:00:00")).collect()] == ["a"]
    assert reads.active_page(s, at("10:00:00"), country="FR").count() == 0


def test_lookup(spark, observations):
    s = state.project_state(state.latest_state(observations({})))
    keys = spark.createDataFrame([("abc123",), ("abc123",), ("ffffff",)], "icao24 string")
    found, missing = reads.lookup_state(s, keys)
    assert [r["icao24"] for r in found.collect()] == ["abc123"]
    assert [r["icao24"] for r in missing.collect()] == ["ffffff"]
