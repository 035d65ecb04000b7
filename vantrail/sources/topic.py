"""The event topic as a stream source and sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from vantrail.schema import TOPIC


def topic_options(servers: str, topic: str, max_offsets: int | None = None, starting: str = "earliest") -> dict[str, str]:
    """Reader options. A new checkpoint starts at the earliest offset."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "true",
        "kafka.fetch.max.bytes": str(10 * 1024 * 1024),
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_topic(spark: SparkSession, options: dict[str, str], format: str = "kafka", path: str | None = None) -> DataFrame:
    """Topic rows as a stream. ``format='parquet'`` reads a folder of topic rows instead."""
    reader = spark.readStream.format(format).options(**options)
    return reader.load() if format == "kafka" else reader.schema(TOPIC).load(path)


def topic_writer_options(servers: str, topic: str) -> dict[str, str]:
    """Writer options: small batches, leader acknowledgement, three attempts."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.linger.ms": "10",
        "kafka.acks": "1",
        "kafka.retries": "2",
    }


def write_topic(
    df: DataFrame, options: dict[str, str], checkpoint: str, format: str = "kafka", path: str | None = None
) -> DataStreamWriter:
    """Keyed write of (key, value) rows, so that the order per aircraft is kept."""
    writer = df.writeStream.format(format).options(**options).option("checkpointLocation", checkpoint)
    return writer if path is None else writer.option("path", path)
