"""Keyed stream state: latest observation, and dedupe that stays exact beyond the horizon."""

from datetime import timedelta

from conftest import OBSERVED, at
from pyspark.sql import functions as F

from vantrail.operators.state import latest_state
from vantrail.plans.staging import replay
from vantrail.session import shared_folder
from vantrail.sources import tables
from vantrail.streaming import jobs, stateful


def test_changes_of_the_state_over_restarts(spark, observations, tmp_path):
    """Older rows and equal times change nothing; every row that moves the state is given out once."""
    rows = observations(
        {"icao24": "a", "observed_at": at("10:00:00")},
        {"icao24": "a", "observed_at": at("10:00:00"), "velocity_ms": 5.0},
        {"icao24": "b", "observed_at": at("10:03:00.123456"), "category": 7},
        {"icao24": "a", "observed_at": at("09:59:00")},
        {"icao24": "b", "observed_at": at("10:03:00.123456")},
        {"icao24": "a", "observed_at": at("10:00:00.000001"), "callsign": "LAST"},
    )
    jobs.use_rocksdb(spark)
    root, marks = str(tmp_path / "changes"), shared_folder(spark, "marks")

    def begin(stream):
        changes = stateful.stream_latest_state(stream)
        return [changes.writeStream.option("checkpointLocation", marks).trigger(availableNow=True).format("parquet").start(root)]

    replay(spark, rows, begin, rounds=3)
    changes = spark.read.schema(OBSERVED).parquet(root)
    assert sorted(r["seq"] for r in changes.collect()) == [0, 2, 5]
    assert sorted(map(str, latest_state(changes).collect())) == sorted(map(str, latest_state(rows).collect()))


def feed_of(observations, *rows):
    """(id, observed hour, arrived hour) from the first day on."""
    start = at("2025-01-01T00:00:00")
    made = observations(*[{"event_id": e, "observed_at": start + timedelta(hours=o)} for e, o, _ in rows])
    arrived = F.element_at(F.array(*[F.lit(start + timedelta(hours=a)) for _, _, a in rows]), (F.col("seq") + 1).cast("int"))
    return made.withColumn("ingested_at", arrived)


def run(spark, feed, root, marks):
    jobs.use_rocksdb(spark)

    def begin(stream):
        deduped = stateful.exact_dedupe(stream)
        return [deduped.writeStream.foreachBatch(stateful.exact_dedupe_sink(root)).option("checkpointLocation", marks).trigger(availableNow=True).start()]

    replay(spark, feed, begin, rounds=4)


def test_repeats_after_the_horizon_are_refused(spark, observations, tmp_path):
    feed = feed_of(
        observations,
        ("a", 0, 1), ("b", 24, 1), ("a", 0, 20), ("c", 30, 31),
        ("a", 0, 75), ("b", 24, 75), ("d", 10, 76), ("e", 76, 76),
        ("d", 10, 140), ("c", 30, 141), ("f", 141, 141), ("e", 76, 142),
    )
    root, marks = str(tmp_path), shared_folder(spark, "marks")
    run(spark, feed, root, marks)
    stored = tables.read_batches(spark, f"{root}/raw", feed.schema)
    found = {r["event_id"]: r["seq"] for r in stored.collect()}
    # Two rows of "a" came in one micro-batch, and two of "d": either may stay.
    assert stored.count() == 6 and found | {"a": 0, "d": 6} == {"a": 0, "b": 1, "c": 3, "d": 6, "e": 7, "f": 10}
    assert found["a"] in (0, 2) and found["d"] in (6, 8)
    run(spark, feed, root, shared_folder(spark, "marks"))  # a new checkpoint, whose state knows no ids
    assert tables.read_batches(spark, f"{root}/raw", feed.schema).count() == 6


def test_new_events_open_no_table(spark, observations, tmp_path, monkeypatch):
    monkeypatch.setattr(stateful, "append_raw", lambda *a: (_ for _ in ()).throw(AssertionError("the table was asked")))
    feed = feed_of(observations, *[(f"e{k % 9}", k % 9, k % 9 + k // 9) for k in range(18)])
    run(spark, feed, str(tmp_path), shared_folder(spark, "marks"))
    assert tables.read_batches(spark, f"{tmp_path}/raw", feed.schema).count() == 9
