"""Consumer metrics: messages, bytes, decode failures and lag."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from vantrail.sources.wire import decode_topic


def topic_metrics(topic: DataFrame) -> DataFrame:
    """Per partition of topic rows: messages, bytes and decode failures, in one pass."""
    decoded = decode_topic(topic.withColumn("_bytes", F.coalesce(F.length("value"), F.lit(0))))
    return decoded.groupBy("partition").agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum("_bytes").alias("bytes"),
        F.count_if(F.col("error").isNotNull()).alias("decode_failures"),
    )


def partition_progress(batch: DataFrame) -> DataFrame:
    """The last offset of each topic and partition in a batch, for ``partition_lag``; one row a partition."""
    return batch.groupBy("topic", "partition").agg(F.max("offset").alias("offset"))


def partition_lag(topic: DataFrame, progress: DataFrame) -> DataFrame:
    """Per partition: the last offset there is, the last one consumed (null: none), and how many messages wait.

    ``progress`` are the rows of ``partition_progress`` of any batches, in any order. Offsets are counted, not subtracted, since
    a topic may have gaps. Both sides come down to a row a partition before and after they meet.
    """
    done = progress.groupBy("topic", "partition").agg(F.max("offset").alias("consumed"))
    waits = F.col("consumed").isNull() | (F.col("offset") > F.col("consumed"))
    return topic.join(done, ["topic", "partition"], "left").groupBy("topic", "partition").agg(
        F.max("offset").alias("latest"), F.max("consumed").alias("consumed"), F.count_if(waits).alias("lag")
    )


def count_decoded(decoded: DataFrame, name: str = "decode") -> DataFrame:
    """Let the query count good and bad rows as it runs; read by the listener."""
    return decoded.observe(
        name,
        F.count_if(F.col("error").isNull()).alias("decoded"),
        F.count_if(F.col("error").isNotNull()).alias("decode_failures"),
    )


class ConsumerMetrics(StreamingQueryListener):
    """Running totals per query, from the progress reports."""

    def __init__(self) -> None:
        self.totals: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        self.totals.setdefault(event.name or str(event.id), {"batches": 0, "messages": 0, "lag": 0})

    def onQueryProgress(self, event) -> None:
        report = event.progress
        own = self.totals.setdefault(report.name or str(report.id), {"batches": 0, "messages": 0, "lag": 0})
        own["batches"] += 1
        own["messages"] += report.numInputRows
        own["lag"] = sum(_lag(s.endOffset, s.latestOffset) for s in report.sources)
        for observed in report.observedMetrics.values():
            for key, value in observed.asDict().items():
                own[key] = own.get(key, 0) + (value or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def _lag(end: str | None, latest: str | None) -> int:
    """Offsets not yet read, over all topics and partitions of a Kafka source."""
    try:
        done, there = json.loads(end or "{}"), json.loads(latest or "{}")
        return sum(
            offset - done.get(topic, {}).get(part, 0) for topic, parts in there.items() for part, offset in parts.items()
        )
    except (AttributeError, TypeError, ValueError):
        return 0
