from conftest import at
from pyspark.sql import functions as F

from vantrail.functions import cell_origin, flight_phase, grid_cell, rounded_mean
from vantrail.operators import rollups as r


def test_phase_limits(spark):
    rates = [2.5, -2.5, 2.5000001, -2.5000001, 0.0, float("nan"), None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rates)], "i int, x double")
    got = [row["p"] for row in df.select("i", flight_phase(F.col("x")).alias("p")).orderBy("i").collect()]
    assert got == ["cruising", "cruising", "climbing", "descending", "cruising", None, None]


def test_cells(spark):
    df = spark.createDataFrame([(x,) for x in (-0.01, 0.0, 0.2499, 0.25, -90.0, 180.0)], "x double")
    cell = grid_cell(F.col("x"))
    got = [tuple(x) for x in df.select(cell, cell_origin(cell)).collect()]
    assert got == [(-1, -0.25), (0, 0.0), (0, 0.0), (1, 0.25), (-360, -90.0), (720, 180.0)]


def test_means_are_of_airborne_known_values(observations):
    feed = observations(
        {"icao24": "a", "velocity_ms": 100.0, "baro_altitude_m": None},
        {"icao24": "a", "velocity_ms": 50.0, "on_ground": True},
        {"icao24": "b", "velocity_ms": None},
    )
    row = r.country_hour_final(r.country_hour_state(feed)).first()
    assert (row["active_aircraft"], row["avg_velocity_ms"], row["avg_baro_altitude_m"], row["on_ground_count"]) == (2, 100.0, None, 1)


def test_replay_changes_only_the_open_mode(observations):
    feed = observations({"event_id": "x", "squawk": "7700"}, {"event_id": "x", "squawk": "7700"})
    counts = lambda d: r.country_hour_final(r.country_hour_state(feed, d)).first()["emergency_squawks_count"]
    assert (counts(True), counts(False)) == (1, 2)
    assert r.country_hour_final(r.country_hour_state(feed, False)).first()["active_aircraft"] == 1


def test_merge_is_associative(observations):
    feed = observations(*[{"icao24": f"a{i % 3}", "velocity_ms": float(i), "vertical_rate_ms": i - 5.0} for i in range(12)])
    a, b, c = (r.country_hour_state(feed.filter(F.col("seq") % 3 == k), False) for k in range(3))
    left, right = r.merge_states(r.merge_states(a, b), c), r.merge_states(a, r.merge_states(b, c))
    whole = r.country_hour_state(feed, False)
    key = ["icao24"]
    assert left.orderBy(key).collect() == right.orderBy(key).select(left.columns).collect()
    assert left.orderBy(key).collect() == whole.orderBy(key).select(left.columns).collect()


def test_airline_null_callsign_counts_once(observations):
    feed = observations({"icao24": "a"}, {"icao24": "b"}, {"icao24": "c", "callsign": ""}, {"icao24": "d", "callsign": "N1"})
    rows = {x["callsign_prefix"]: x for x in r.airline_hour_final(r.airline_hour_state(feed)).collect()}
    assert (rows[""]["active_aircraft"], rows[""]["distinct_callsigns"]) == (3, 1)
    assert rows["N1"]["active_aircraft"] == 1


def test_grid_leaves_out_the_ground(observations):
    feed = observations({"icao24": "a"}, {"icao24": "a", "observed_at": at("10:04:59")}, {"icao24": "b", "on_ground": True}, {"icao24": "a", "observed_at": at("10:05:00")})
    rows = r.grid_final(r.grid_state(feed)).orderBy("bucket").collect()
    assert [x["aircraft_count"] for x in rows] == [1, 1]


def test_rounded_mean(spark):
    df = spark.createDataFrame([(2.0,), (3.0,)], "x double")
    assert df.select(rounded_mean(F.col("x"))).first()[0] == 3
    assert df.select(rounded_mean(-F.col("x"))).first()[0] == -3
    assert df.filter("x > 9").select(rounded_mean(F.col("x"))).first()[0] is None


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_distinct_count_needs_no_sets_and_reads_few_columns(spark):
    from conftest import SF

    from vantrail.plans import adapter

    plan = plan_of(r.country_hour_final(r.country_hour_state(adapter.feed(spark, SF), dedupe=False)))
    assert "collect_set" not in plan and "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    assert "event_type" not in plan and "props" not in plan
    # one shuffle by (country, hour, aircraft), one by (country, hour)
    assert plan.count("Exchange hashpartitioning") == 2
