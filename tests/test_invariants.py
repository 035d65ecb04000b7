from conftest import at
from pyspark.sql import functions as F

from vantrail.operators import dashboards, invariants as i, state


def test_unique(observations):
    assert tuple(i.check_unique(observations({"event_id": "a"}, {"event_id": "a"}, {})).first()) == (3, 2, False)
    assert i.check_unique(observations({}, {})).first()["ok"]


def test_state_is_max(observations):
    raw = observations({"observed_at": at("10:00:00")}, {"observed_at": at("11:00:00")})
    good = state.project_state(state.latest_state(raw))
    assert i.check_state_is_max(raw, good).first()["ok"]
    assert not i.check_state_is_max(raw, state.project_state(raw.filter("seq = 0"))).first()["ok"]


def test_difference(observations):
    a = observations({}, {}, {"event_id": "x"})
    assert tuple(i.table_difference(a, a.orderBy(F.desc("seq"))).first()) == (0, 0)
    assert tuple(i.table_difference(a, a.filter("seq > 0").unionByName(a.filter("seq = 2"))).first()) == (1, 1)


def test_key_order(spark):
    rows = [("a", 1, 1), ("a", 2, 2), ("b", 3, 9), ("b", 4, 8), ("b", 5, 10), ("a", 6, 1)]
    df = spark.createDataFrame(rows, "icao24 string, position bigint, seq bigint")
    assert sorted(tuple(r) for r in i.check_key_order(df).collect()) == [("a", 6, 1, 2), ("b", 4, 8, 9)]


def test_pages_missing_and_repeated(spark, observations):
    table = observations({}, {}, {})
    pages = spark.createDataFrame([("e0",), ("e0",), ("zz",)], "event_id string")
    assert tuple(i.check_pages_cover_once(pages, table).first()) == (2, 2, 1, 1)


def test_short_callsigns_stay_out_of_the_filter(observations):
    df = observations(*[{"icao24": f"a{k}", "callsign": c} for k, c in enumerate([None, "", "N1", "N1 ", " AB", "BAW7", " BAW"])])
    s = state.project_state(state.latest_state(df))
    assert [r["prefix"] for r in dashboards.filter_airlines(s, at("10:00:00")).collect()] == [" BA", "BAW"]


def test_top_countries_orders_ties_by_name(observations):
    df = observations(*[{"icao24": f"a{k}", "origin_country": c} for k, c in enumerate("CABBA")])
    s = state.project_state(state.latest_state(df))
    rows = dashboards.top_countries(s, at("10:00:00"), n=2).collect()
    assert [tuple(r) for r in rows] == [("A", 2), ("B", 2)]
