from conftest import at
from pyspark.sql import functions as F

from vantrail.operators import dedupe, state


def held(df):
    return {r["icao24"]: (r["observed_at"].strftime("%H:%M"), r["event_id"]) for r in df.collect()}


def test_duplicate(observations):
    feed = observations({"event_id": "x"}, {"event_id": "x"})
    assert dedupe.dedupe_first(feed).count() == 1
    flags = state.apply_outcomes(feed).orderBy("seq").collect()
    assert [(f["raw_inserted"], f["state_updated"]) for f in flags] == [(True, True), (False, False)]


def test_out_of_order(observations):
    feed = observations(
        {"event_id": "10", "observed_at": at("10:00:00")},
        {"event_id": "11", "observed_at": at("10:05:00")},
        {"event_id": "12", "observed_at": at("10:03:00")},
    )
    assert dedupe.dedupe_first(feed).count() == 3
    assert held(state.latest_state(feed)) == {"abc123": ("10:05", "11")}
    assert [f["state_updated"] for f in state.apply_outcomes(feed).orderBy("seq").collect()] == [True, True, False]


def test_tie_keeps_earliest_arrival(observations):
    feed = observations({"event_id": "z"}, {"event_id": "a"})
    assert held(state.latest_state(feed)) == {"abc123": ("10:00", "z")}
    early, late = feed.filter("seq = 0"), feed.filter("seq = 1")
    assert held(state.merge_state(early, late)) == {"abc123": ("10:00", "z")}
    # A held row stays on a tie even if the other's number is smaller.
    assert held(state.merge_state(late, early)) == {"abc123": ("10:00", "a")}


def test_many_aircraft(observations):
    feed = observations(*[{"icao24": f"00000{i}", "squawk": "7700" if i == 1 else None} for i in range(3)])
    rows = state.project_state(state.latest_state(feed)).orderBy("icao24").collect()
    assert [r["last_squawk"] for r in rows] == [None, "7700", None]
    assert "event_id" not in rows[0].asDict() and len(rows[0]) == 11


def test_mixed_disorder(observations):
    def o(aircraft, event, time):
        return {"icao24": aircraft, "event_id": event, "observed_at": at(time)}

    feed = observations(
        o("a", "a1", "10:00:00"),
        o("c", "c2", "10:09:00"),
        o("a", "a2", "10:01:00"),
        o("a", "a2", "10:01:00"),
        o("b", "b1", "10:02:00"),
        o("c", "c1", "10:01:00"),
        o("a", "a3", "10:04:00"),
    )
    assert dedupe.dedupe_first(feed).count() == 6
    assert {k: e for k, (_, e) in held(state.latest_state(feed)).items()} == {"a": "a3", "b": "b1", "c": "c2"}


def test_contracts_differ(observations):
    """The same id at two times: one row by id, two rows by the full sorting key."""
    feed = observations(
        {"event_id": "x", "velocity_ms": 1.0},
        {"event_id": "x", "velocity_ms": 2.0},
        {"event_id": "x", "observed_at": at("09:00:00")},
    )
    assert [r["velocity_ms"] for r in dedupe.dedupe_first(feed).collect()] == [1.0]
    kept = {r["velocity_ms"] for r in dedupe.collapse_versions(feed).collect()}
    assert kept == {2.0, None}
    flushed = feed.withColumn("flush", (F.col("seq") == 2).cast("int"))
    assert dedupe.dedupe_in_batch(flushed, "flush").count() == 2


def test_state_reads_undeduped_stream(observations):
    """A repeat with a newer time moves the state though its raw row is dropped."""
    feed = observations({"event_id": "x"}, {"event_id": "x", "observed_at": at("11:00:00")})
    assert held(state.latest_state(feed)) == {"abc123": ("11:00", "x")}
    flags = state.apply_outcomes(feed).orderBy("seq").collect()
    assert (flags[1]["raw_inserted"], flags[1]["state_updated"]) == (False, True)
