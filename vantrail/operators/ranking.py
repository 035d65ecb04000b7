"""Row choices and running values per key that hold when one key is very large."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key.

    Spark turns this shape into a WindowGroupLimit on both sides of the shuffle,
    so a key with a third of all rows sends at most ``n`` rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def running_max_before(
    df: DataFrame, key: str, seq: str, value: str, out: str, slice_width: int = 1_000_000, start: DataFrame | None = None
) -> DataFrame:
    """Largest ``value`` of the same key among the rows with a smaller ``seq``, and in ``start``, a table of (key, value).

    ``seq`` is a unique whole number per key (an arrival offset). Rows are cut
    into slices of ``slice_width`` offsets, so no sort sees more rows of a key
    than that. The slice maxima are aggregated map-side, made cumulative over
    the few slices of a key and joined back. ``start`` meets these few rows of a key only, never the rows of a large one.
    """
    sliced = df.withColumn("_slice", F.floor(F.col(seq) / slice_width))
    tops = sliced.groupBy(key, "_slice").agg(F.max(value).alias("_top"))
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select(key, "_slice", F.max("_top").over(earlier).alias("_before"))
    if start is not None:
        tops = tops.join(start.select(key, F.col(value).alias("_start")), key, "left").select(key, "_slice", F.greatest("_before", "_start").alias("_before"))
    inside = Window.partitionBy(key, "_slice").orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    return (
        sliced.join(tops, [key, "_slice"])
        .withColumn(out, F.greatest(F.col("_before"), F.max(value).over(inside)))
        .drop("_slice", "_before")
    )


def ranked(df: DataFrame, key: str, order: Sequence[Column], slice_of: Column) -> DataFrame:
    """Adds ``rank`` (from 1, in ``order``) and ``total`` per key.

    ``slice_of`` is a whole number that never rises along ``order``, such as the day of
    a descending time. Rows are numbered inside (key, slice), and the counts of a key's
    earlier slices, which are aggregated map-side, are added. A large key is thereby split
    over its slices; nothing is read or written while the plan is built.
    """
    sliced = df.withColumn("_slice", F.coalesce(slice_of.cast("bigint"), F.lit(-(1 << 62))))
    per_key = Window.partitionBy(key)
    earlier = per_key.orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    parts = sliced.groupBy(key, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    parts = parts.select(
        F.col(key).alias("_key"),
        F.col("_slice").alias("_part"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(per_key).alias("total"),
    )
    inside = F.row_number().over(Window.partitionBy(key, "_slice").orderBy(*order))
    return (
        sliced.withColumn("_rn", inside)
        .join(parts, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_slice") == F.col("_part")))
        .withColumn("rank", F.col("_before") + F.col("_rn"))
        .drop("_slice", "_rn", "_key", "_part", "_before")
    )
