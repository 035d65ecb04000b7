"""Latest state per aircraft when observations arrive out of order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vantrail.operators.ranking import first_per_key, running_max_before
from vantrail.schema import STATE_FROM


def latest_state(df: DataFrame, key: str = "icao24", ts: str = "observed_at", seq: str = "seq") -> DataFrame:
    """Newest observation per key; on equal times the earliest arrival stays."""
    return first_per_key(df, [key], [F.col(ts).desc(), F.col(seq).asc()])


def merge_state(
    state: DataFrame, batch: DataFrame, key: str = "icao24", ts: str = "observed_at", seq: str = "seq"
) -> DataFrame:
    """State after a batch: a held row is replaced only by a strictly newer one.

    Held rows and the batch go through one limit per key, so the merge is a
    single shuffle of at most one row per key and task, without a join.
    """
    both = state.withColumn("_held", F.lit(0)).unionByName(batch.withColumn("_held", F.lit(1)))
    order = [F.col(ts).desc(), F.col("_held").asc(), F.col(seq).asc()]
    return first_per_key(both, [key], order).drop("_held")


def apply_outcomes(
    batch: DataFrame,
    raw: DataFrame | None = None,
    state: DataFrame | None = None,
    slice_width: int = 1_000_000,
) -> DataFrame:
    """Per arriving event: was it new, and did it move the state?

    ``raw`` holds the ids stored before, ``state`` the latest times held before.
    An event moves the state when it is newer than every earlier arrival of its
    aircraft and than the held row. The raw repeat does not matter for that.
    """
    firsts = batch.groupBy("event_id").agg(F.min("seq").alias("_first_seq"))
    if raw is not None:
        firsts = firsts.join(raw.select("event_id"), "event_id", "left_anti")
    marked = (
        running_max_before(batch, "icao24", "seq", "observed_at", "_newest", slice_width, state)
        # An id and its first arrival are unique together, so a repeated id adds
        # no matches here.
        .join(firsts.withColumnRenamed("event_id", "_id"), (F.col("event_id") == F.col("_id")) & (F.col("seq") == F.col("_first_seq")), "left")
        .withColumn("raw_inserted", F.col("_id").isNotNull())
    )
    bar = F.col("_newest")
    return marked.withColumn("state_updated", bar.isNull() | (F.col("observed_at") > bar)).select(
        "event_id", "icao24", "observed_at", "seq", "raw_inserted", "state_updated"
    )


def project_state(df: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """State layout: renamed and narrowed, with the time of the write if given."""
    columns = [F.col(source).alias(name) for name, source in STATE_FROM.items()]
    if updated_at is not None:
        columns.append(updated_at.alias("updated_at"))
    return df.select(*columns)
