"""Streaming queries: independent consumers of one topic."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from vantrail.schema import REPLAY_HOURS
from vantrail.streaming.sinks import BatchSink

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@dataclass(frozen=True)
class Pace:
    """How often a consumer runs. Rows per batch are bounded only by ``topic_options(max_offsets=...)``."""

    seconds: float


# Seconds after which each consumer flushes at the latest.
PACES = {"operational": Pace(0), "columnar": Pace(2), "lake": Pace(30)}


def start(
    stream: DataFrame, name: str, sink: BatchSink, checkpoint_root: str, pace: Pace | None = None, drain: bool = False
) -> StreamingQuery:
    """Start one consumer with its own checkpoint. ``drain`` stops at the end of the input.

    No event-time watermark is set: any lateness is accepted, and only the state
    gate discards old rows. A new checkpoint folder reads from the start.
    """
    writer = (
        stream.writeStream.queryName(name)
        .foreachBatch(sink)
        .option("checkpointLocation", f"{checkpoint_root}/{name}")
        .outputMode("append")
    )
    if drain:
        return writer.trigger(availableNow=True).start()
    seconds = (pace or PACES.get(name, Pace(0))).seconds
    return writer.trigger(processingTime=f"{seconds} seconds").start()


def start_fanout(
    stream: DataFrame | dict[str, DataFrame], sinks: dict[str, BatchSink], checkpoint_root: str, drain: bool = False
) -> list[StreamingQuery]:
    """One query per sink, each with its own offsets; a slow one holds up no other.

    ``stream`` may give each sink its own reader, so that each has its own limit
    of offsets per batch (``topic_options(max_offsets=...)``); without one a batch is all there is.
    """
    return [
        start(stream[name] if isinstance(stream, dict) else stream, name, sink, checkpoint_root, drain=drain)
        for name, sink in sinks.items()
    ]


def finish(queries: list[StreamingQuery], drain: bool = True) -> None:
    """Shut down: process what has arrived, then stop. A batch cut off is run
    again at the next start, which its sink absorbs."""
    for query in queries:
        if drain and query.isActive:
            query.processAllAvailable()
        query.stop()


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """``use_rocksdb`` for the queries that are started inside; the session's own settings come back afterwards."""
    before = {name: spark.conf.get(name, None) for name in ROCKSDB}
    use_rocksdb(spark)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def use_rocksdb(spark: SparkSession) -> None:
    """Keep streaming state on local disk with changelog checkpoints."""
    for name, value in ROCKSDB.items():
        spark.conf.set(name, value)


def stream_dedupe(stream: DataFrame, id: str = "event_id", arrived: str = "ingested_at", hours: int = REPLAY_HOURS) -> DataFrame:
    """Absorb replays for as long as the topic keeps its log. Its ids are kept on disk (RocksDB).

    The watermark is on arrival, never on the observation time: a valid
    observation may be a day in the future or many days late, and would then
    move the watermark for, or be dropped by, everyone else.
    """
    use_rocksdb(stream.sparkSession)
    return stream.withWatermark(arrived, f"{hours} hours").dropDuplicatesWithinWatermark([id])
