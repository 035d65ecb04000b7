import json

from vantrail.sources.snapshots import explode_snapshots

FULL = ["ABC123", " BAW1 ", "United Kingdom", 100, 101, 1.0, 2.0, 3.0, False, 5, 6.0, 7.0, None, 8.0, "7700", True, 2, 4]


def run(spark, *states, time=1000):
    body = json.dumps({"time": time, "states": list(states)})
    df = spark.createDataFrame([(body,)], "body string")
    return explode_snapshots(df).orderBy("icao24").collect()


def test_full_and_short_vectors(spark):
    seventeen = ["b"] + FULL[1:17]
    eight = ["c", None, None, None, 101, 1, 2, None]
    a, b, c = run(spark, FULL, seventeen, eight)
    assert (a["icao24"], a["callsign"], a["position_source"], a["category"], a["velocity_ms"]) == ("abc123", "BAW1", "MLAT", 4, 5.0)
    assert a["observed_at"].timestamp() == 100 and a["spi"] is True and a["squawk"] == "7700"
    assert b["category"] is None and b["spi"] is True
    assert (c["origin_country"], c["on_ground"], c["position_source"], c["velocity_ms"]) == ("Unknown", False, "UNKNOWN", None)
    assert c["observed_at"].timestamp() == 1000


def test_rows_without_place_or_id_are_skipped(spark):
    no_lat = FULL[:6] + [None] + FULL[7:]
    no_lon = FULL[:5] + [None] + FULL[6:]
    assert run(spark, no_lat, no_lon, [None] + FULL[1:], [""] + FULL[1:], ["x"]) == []


def test_empty_snapshots(spark):
    df = spark.createDataFrame([('{"time":1,"states":null}',), ('{"time":1}',), ('{"time":1,"states":[]}',)], "body string")
    assert explode_snapshots(df).count() == 0


def test_ids_are_stable_and_differ(spark):
    first = [r["event_id"] for r in run(spark, FULL, FULL)]
    assert first == [r["event_id"] for r in run(spark, FULL, FULL)]
    assert len(set(first)) == 2
    assert set(first).isdisjoint(r["event_id"] for r in run(spark, FULL, FULL, time=1001))


def test_codes(spark):
    for code, name in ((0, "ADSB"), (1, "ASTERIX"), (2, "MLAT"), (3, "FLARM"), (4, "UNKNOWN"), (None, "UNKNOWN")):
        assert run(spark, FULL[:16] + [code])[0]["position_source"] == name
