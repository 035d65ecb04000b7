"""Retention by age. Each rule keeps rows at the exact limit."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from vantrail.schema import COLUMNAR_RAW_DAYS, GRID_DAYS, HOT_RAW_DAYS, ROLLUP_DAYS


def days_of(text: str | int) -> int:
    """Number of days; only digits are accepted."""
    if not re.fullmatch(r"[0-9]+", str(text)):
        raise ValueError(f"retention days must be digits, got: {text}")
    return int(text)


def retain(df: DataFrame, ts: str, days: str | int, as_of: datetime, day: str | None = None) -> DataFrame:
    """Rows not older than ``days``. ``day`` names a date partition column to prune by."""
    limit = as_of - timedelta(days=days_of(days))
    kept = df.filter(F.col(ts) >= F.lit(limit))
    return kept.filter(F.col(day) >= F.lit(limit.date())) if day else kept


def retain_hot_raw(df, as_of, days: str | int = HOT_RAW_DAYS) -> DataFrame:
    return retain(df, "observed_at", days, as_of)


def retain_columnar_raw(df, as_of, days: str | int = COLUMNAR_RAW_DAYS) -> DataFrame:
    """Age at second resolution: the fraction of a second of a row is not looked at."""
    limit = as_of - timedelta(days=days_of(days))
    if limit.microsecond:  # a whole second not below the limit is one not below the next second; this form reaches the scan
        limit = limit.replace(microsecond=0) + timedelta(seconds=1)
    return df.filter(F.col("observed_at") >= F.lit(limit))


def retain_rollup(df, as_of, days: str | int = ROLLUP_DAYS, bucket: str = "hour") -> DataFrame:
    return retain(df, bucket, days, as_of)


def retain_grid(df, as_of, days: str | int = GRID_DAYS) -> DataFrame:
    return retain(df, "bucket", days, as_of)


def retain_forever(df, as_of=None) -> DataFrame:
    """State table and lake: never pruned."""
    return df
