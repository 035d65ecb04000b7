import time

import pytest
from conftest import OBSERVED, at
from pyspark.sql import functions as F

from vantrail.operators import rollups as r
from vantrail.plans.staging import replay
from vantrail.session import shared_folder
from vantrail.sources import tables
from vantrail.streaming import jobs, metrics, sinks


def test_state_gate_over_batches(spark, observations, tmp_path):
    """An older observation of a later batch leaves the state alone, a newer one wins."""
    root = str(tmp_path)
    sink = sinks.operational_sink(root)
    day = observations(
        {"event_id": "a", "observed_at": at("10:00:00")},
        {"event_id": "b", "observed_at": at("10:05:00")},
        {"event_id": "c", "observed_at": at("10:03:00")},
        {"event_id": "d", "observed_at": at("10:05:00")},
        {"event_id": "e", "observed_at": at("10:06:00")},
    )
    held = []
    for i in range(5):
        sink(day.filter(F.col("seq") == i), i)
        held.append(tables.read_state(spark, f"{root}/state", OBSERVED).first()["event_id"])
    assert held == ["a", "b", "b", "b", "e"]
    assert tables.read_batches(spark, f"{root}/raw", OBSERVED).count() == 5


def test_running_a_batch_again_changes_nothing(spark, observations, tmp_path):
    root = str(tmp_path)
    sink = sinks.operational_sink(root, rollups=("country",))
    feed = observations(*[{"event_id": f"e{i % 4}", "icao24": f"a{i % 3}", "velocity_ms": 10.0} for i in range(9)])
    look = lambda: (
        sorted(map(tuple, tables.read_batches(spark, f"{root}/raw", OBSERVED).collect()), key=str),
        sorted(map(tuple, tables.read_state(spark, f"{root}/state", OBSERVED).collect()), key=str),
        r.country_hour_final(spark.read.parquet(f"{root}/rollup_country").drop(*tables.BATCH_KEYS)).collect(),
    )
    sink(feed.filter("seq < 5"), 0)
    sink(feed.filter("seq >= 5"), 1)
    before = look()
    sink(feed.filter("seq >= 5"), 1)
    assert look() == before and len(before[0]) == 4


def test_new_group_does_not_overwrite(spark, observations, tmp_path):
    root = str(tmp_path)
    feed = observations({"event_id": "a"}, {"event_id": "b", "observed_at": at("11:00:00")})
    sinks.operational_sink(root)(feed, 0)
    sinks.operational_sink(root, group="again")(feed.filter("seq = 0"), 0)
    raw = tables.read_batches(spark, f"{root}/raw", OBSERVED)
    assert sorted(x["event_id"] for x in raw.collect()) == ["a", "b"]
    assert tables.read_state(spark, f"{root}/state", OBSERVED).first()["event_id"] == "b"


def test_new_checkpoint_repeats_and_loses_nothing(spark, observations, tmp_path):
    """A group that starts again with other batch borders, as with a new checkpoint."""
    root, marks, landing = str(tmp_path / "t"), tmp_path / "marks", str(tmp_path / "in")
    rows = [{"event_id": f"e{i}", "observed_at": at(f"10:{i:02d}:00")} for i in range(12)]
    observations(*rows).write.parquet(landing)
    feed = lambda: spark.readStream.schema(OBSERVED).parquet(landing)
    seen = []
    for k in range(3):
        for sink, name in ((sinks.operational_sink(root), "operational"), (sinks.columnar_sink(root, rollups=()), "columnar")):
            jobs.start(feed(), name, sink, str(marks / str(k)), drain=True).awaitTermination()
        seen.append(tables.read_state(spark, f"{root}/state", OBSERVED).first()["event_id"])
    assert seen == ["e11"] * 3
    assert tables.read_batches(spark, f"{root}/raw", OBSERVED).count() == 12
    assert spark.read.parquet(f"{root}/columnar").count() == 36
    old = observations({"event_id": "z", "observed_at": at("09:00:00")})
    tables.upsert_state(old, f"{root}/state", 0, "operational")
    assert tables.read_state(spark, f"{root}/state", OBSERVED).first()["event_id"] == "e11"


def test_state_write_cut_off_before_its_record(spark, observations, tmp_path):
    """Data without a commit record is not the state."""
    path = str(tmp_path)
    tables.upsert_state(observations({"event_id": "a"}, {"event_id": "b", "icao24": "b00002"}), path, 0)
    observations({"event_id": "c", "observed_at": at("12:00:00")}).write.parquet(f"{path}/slots/group=main/slot=1")
    assert {x["event_id"] for x in tables.read_state(spark, path, OBSERVED).collect()} == {"a", "b"}
    tables.upsert_state(observations({"event_id": "d", "observed_at": at("13:00:00")}), path, 0)
    assert {x["event_id"] for x in tables.read_state(spark, path, OBSERVED).collect()} == {"b", "d"}


def test_late_rows_and_future_rows_survive_dedupe(spark, tmp_path):
    """The watermark is on arrival: a row 10 days late is kept after one a day ahead."""
    out, marks = str(tmp_path / "out"), str(tmp_path / "marks")
    rows = [("a", "2025-01-02T10:00:00", 0), ("b", "2024-12-22T10:00:00", 1), ("a", "2025-01-02T10:00:00", 2), ("c", "2025-01-01T10:00:00", 3)]
    df = spark.createDataFrame([(i, at(t), s) for i, t, s in rows], "event_id string, observed_at timestamp, seq bigint")
    df = df.withColumn("ingested_at", F.timestamp_seconds(F.lit(1735725600) + F.col("seq") * 60))
    replay(
        spark,
        df,
        lambda s: [jobs.stream_dedupe(s).writeStream.format("parquet").option("path", out).option("checkpointLocation", marks).trigger(availableNow=True).start()],
        rounds=4,
    )
    assert sorted(x["event_id"] for x in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_metrics_and_shutdown(spark, observations, tmp_path):
    landing = str(tmp_path / "in")
    feed = observations(*[{"event_id": f"e{i}"} for i in range(6)]).withColumn("error", F.when(F.col("seq") == 0, "bad"))
    feed.write.parquet(landing)
    listener = metrics.ConsumerMetrics()
    spark.streams.addListener(listener)
    try:
        stream = metrics.count_decoded(spark.readStream.schema(feed.schema).parquet(landing))
        seen = []
        query = jobs.start(stream, "metered", lambda b, i: seen.append(b.count()), str(tmp_path / "marks"), jobs.Pace(0.1))
        jobs.finish([query])
        assert not query.isActive and sum(seen) == 6
        for _ in range(50):
            if listener.totals.get("metered", {}).get("messages", 0) >= 6:
                break
            time.sleep(0.1)
        own = listener.totals["metered"]
        assert own["messages"] >= 6 and own["decoded"] >= 5 and own["decode_failures"] >= 1
    finally:
        spark.streams.removeListener(listener)


def test_lag():
    assert metrics._lag('{"t":{"0":5,"1":7}}', '{"t":{"0":9,"1":7}}') == 4
    assert metrics._lag(None, None) == 0 and metrics._lag("{}", '{"logOffset":3}') == 0


def test_fixed_paces():
    assert {name: pace.seconds for name, pace in jobs.PACES.items()} == {"operational": 0, "columnar": 2, "lake": 30}


def test_shared_folder_is_the_named_one(spark):
    first = shared_folder(spark, "x")
    assert first != shared_folder(spark, "x")
    before = spark.conf.get("spark.checkpoint.dir", None)
    if before is None:
        assert first.startswith(spark.sparkContext.getCheckpointDir())


def test_failed_sink_is_not_committed(spark, observations, tmp_path):
    landing, marks, root = (str(tmp_path / p) for p in ("in", "marks", "out"))
    feed = observations({"event_id": "a"}, {"event_id": "b"})
    feed.write.parquet(landing)
    real, calls = sinks.operational_sink(root), []

    def sink(batch, batch_id):
        real(batch, batch_id)
        calls.append(batch_id)
        if len(calls) == 1:
            raise RuntimeError("lost before the commit")

    stream = spark.readStream.schema(feed.schema).parquet(landing)
    with pytest.raises(Exception):
        jobs.start(stream, "frail", sink, marks, drain=True).awaitTermination()
    jobs.start(stream, "frail", sink, marks, drain=True).awaitTermination()
    assert calls == [0, 0]
    assert tables.read_batches(spark, f"{root}/raw", OBSERVED).count() == 2
