"""The dedupe contracts. They differ on purpose and are not merged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from vantrail.operators.ranking import first_per_key


def dedupe_first(df: DataFrame, id: str = "event_id", seq: str = "seq") -> DataFrame:
    """One row per id; the first arrival wins."""
    return first_per_key(df, [id], [F.col(seq).asc()])


def dedupe_in_batch(df: DataFrame, batch: str, id: str = "event_id", seq: str = "seq") -> DataFrame:
    """First arrival wins inside one flush; repeats in other flushes stay."""
    return first_per_key(df, [batch, id], [F.col(seq).asc()])


def collapse_versions(
    df: DataFrame, key: Sequence[str] = ("icao24", "observed_at", "event_id"), seq: str = "seq"
) -> DataFrame:
    """One row per full sorting key; the last insert wins."""
    return first_per_key(df, list(key), [F.col(seq).desc()])


def read_time_distinct(df: DataFrame, id: str = "event_id", order: str | None = None) -> DataFrame:
    """One row per id when reading a lake that keeps repeats of other flushes: the first to arrive.

    ``order`` names the column of arrival: ``ingested_at`` where the lake has it, else ``seq``.
    """
    order = order or ("ingested_at" if "ingested_at" in df.columns else "seq")
    return first_per_key(df, [id], [F.col(order).asc(), F.col("observed_at").desc()])
