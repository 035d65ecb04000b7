import pytest
from conftest import at
from pyspark.sql import functions as F

from vantrail.schema import TELEMETRY_COLUMNS
from vantrail.sources import topic, wire

POISON = [
    (b"\x00\x00", wire.TOO_SHORT),
    (b"\x00\x00\x00\x00\x01", wire.TOO_SHORT),
    (b"\x01\x00\x00\x00\x01\xff", wire.BAD_MAGIC),
    (b"\x00\x00\x00\x00\x01\xff", wire.BAD_RECORD),
    (b"\x00\x00\x00\x00\x01" + b"\x80" * 20, wire.BAD_RECORD),
    (None, wire.TOO_SHORT),
]


def test_poison(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(POISON)], "i int, value binary")
    good, dead = wire.split_decoded(wire.decode_topic(df))
    assert good.count() == 0
    assert [r["error"] for r in dead.orderBy("i").collect()] == [e for _, e in POISON]
    assert {r["i"]: r["dead_letter"] and bytes(r["dead_letter"]) for r in dead.collect()} == {i: v for i, (v, _) in enumerate(POISON)}


def test_known_bytes(observations):
    """Against bytes worked out by hand from the Avro rules."""
    df = observations({"event_id": "e", "icao24": "a", "origin_country": "é", "observed_at": at("1970-01-01T00:00:00.000064"), "lat": 0.0, "lon": 1.0})
    value = bytes(wire.encode_topic(df, 258).first()["value"])
    expected = b"\x00" + b"\x00\x00\x01\x02"
    expected += b"\x02e" + b"\x02a" + b"\x00" + b"\x04\xc3\xa9" + b"\x80\x01" + b"\x00"
    expected += b"\x00" * 8 + b"\x00\x00\x00\x00\x00\x00\xf0\x3f" + b"\x00" * 5 + b"\x00" + b"\x00" + b"\x00" + b"\x00"
    assert value == expected


def test_round_trip(observations):
    df = observations(
        {"callsign": "BAW✈" * 40, "category": -3, "squawk": "", "spi": True, "on_ground": True},
        {"observed_at": at("1969-12-31T23:59:59.999999"), "velocity_ms": float("inf"), "category": 2**31 - 1},
        {"position_source": "UNKNOWN", "baro_altitude_m": -0.0, "geo_altitude_m": 1e-300, "vertical_rate_ms": -2.5, "true_track_deg": 0.1},
    )
    back, dead = wire.split_decoded(wire.decode_topic(wire.encode_topic(df, 1, "seq").drop("key")))
    columns = ["seq", *TELEMETRY_COLUMNS]
    assert dead.count() == 0
    assert back.select(columns).orderBy("seq").collect() == df.select(columns).orderBy("seq").collect()


def test_every_cut_is_found(observations, spark):
    value = bytes(wire.encode_topic(observations({"callsign": "BAW1", "category": 5}), 1).first()["value"])
    cuts = spark.createDataFrame([(i, value[:i]) for i in range(len(value))], "i int, value binary")
    assert wire.decode_topic(cuts).filter(F.col("error").isNull()).count() == 0


def test_text_that_is_no_utf8(observations, spark):
    value = bytes(wire.encode_topic(observations({"callsign": "BAW1"}), 1).first()["value"])
    rows = [(0, value.replace(b"BAW1", b"\xff\xfe\xfd\xfc")), (1, value)]
    got = wire.decode_topic(spark.createDataFrame(rows, "i int, value binary")).orderBy("i").collect()
    assert [(r["error"], r["callsign"], r["event_id"]) for r in got] == [(wire.BAD_RECORD, None, None), (None, "BAW1", "e0")]


def test_topic_options():
    reader = topic.topic_options("broker:9092", "telemetry", max_offsets=5000)
    assert reader["startingOffsets"] == "earliest" and reader["maxOffsetsPerTrigger"] == "5000"
    assert "maxOffsetsPerTrigger" not in topic.topic_options("b", "t")
    assert topic.topic_writer_options("b", "t")["kafka.acks"] == "1"


def test_missing_kafka_module_is_reported(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        topic.read_topic(spark, topic.topic_options("b:1", "t"))
