"""Checks that the stores agree. Each returns a DataFrame, most of them one row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vantrail.operators.ranking import running_max_before


def check_unique(raw: DataFrame) -> DataFrame:
    """total = distinct_ids when every observation is stored once.

    Counted over one row per id, so an id with very many copies is folded
    map-side.
    """
    per_id = raw.groupBy("event_id").agg(F.count(F.lit(1)).alias("_n"))
    return per_id.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("distinct_ids")
    ).withColumn("ok", F.col("total") == F.col("distinct_ids"))


def check_state_is_max(raw: DataFrame, state: DataFrame) -> DataFrame:
    """Per aircraft: does the state hold the largest time of the raw rows?"""
    newest = raw.groupBy("icao24").agg(F.max("observed_at").alias("max_raw"))
    held = state.select("icao24", F.col("observed_at").alias("state_at"))
    return newest.join(held, "icao24").withColumn("ok", F.col("max_raw") == F.col("state_at"))


def table_difference(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows lost and rows gained between two versions, as one row of counts."""
    columns = before.columns
    both = before.select(*columns, F.lit(1).alias("_d")).unionByName(after.select(*columns, F.lit(-1).alias("_d")))
    net = both.groupBy(*columns).agg(F.sum("_d").alias("_d"))
    return net.agg(
        F.coalesce(F.sum(F.greatest("_d", F.lit(0))), F.lit(0)).alias("lost"),
        F.coalesce(F.sum(F.greatest(-F.col("_d"), F.lit(0))), F.lit(0)).alias("gained"),
    )


def check_rollup_parity(raw: DataFrame, final: DataFrame) -> DataFrame:
    """Distinct aircraft per country hour: rollup against the raw rows."""
    direct = raw.groupBy("origin_country", F.date_trunc("hour", "observed_at").alias("hour")).agg(
        F.count_distinct("icao24").alias("raw_aircraft")
    )
    rolled = final.select("origin_country", "hour", F.col("active_aircraft").alias("rollup_aircraft"))
    return direct.join(rolled, ["origin_country", "hour"], "full").withColumn(
        "ok", F.col("raw_aircraft").eqNullSafe(F.col("rollup_aircraft"))
    )


def check_final_count(table: DataFrame, final: DataFrame, id: str = "event_id") -> DataFrame:
    """Distinct ids of a table with repeats against the rows of its collapsed view."""
    ids = table.agg(F.count_distinct(id).alias("ids"))
    rows = final.agg(F.count(F.lit(1)).alias("final_rows"), F.count_distinct(id).alias("final_ids"))
    both = ids.unionByName(rows, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in ("ids", "final_rows", "final_ids")])
    return both.withColumn("ok", (F.col("ids") == F.col("final_rows")) & (F.col("ids") == F.col("final_ids")))


def check_pages_cover_once(pages: DataFrame, table: DataFrame) -> DataFrame:
    """Counts of ids served, missed and served more than once."""
    served = pages.groupBy("event_id").agg(F.count(F.lit(1)).alias("_served"))
    stored = table.groupBy("event_id").agg(F.count(F.lit(1)).alias("_stored"))
    return served.join(stored, "event_id", "full").agg(
        F.count("_served").alias("served"),
        F.count_if(F.col("_served").isNull()).alias("missed"),
        F.count_if(F.col("_served") > 1).alias("repeated"),
        F.count_if(F.col("_stored").isNull()).alias("unknown"),
    )


def check_key_order(df: DataFrame, key: str = "icao24", position: str = "position", seq: str = "seq") -> DataFrame:
    """Rows that a sink holds after a later arrival of the same key.

    None means the arrival order of each key was kept. ``position`` is the
    row's whole-number place in the sink.
    """
    marked = running_max_before(df.select(key, position, seq), key, position, seq, "_latest")
    return marked.filter(F.col(seq) < F.col("_latest")).withColumnRenamed("_latest", "after_seq")


def find_duplicates(raw: DataFrame, id: str = "event_id") -> DataFrame:
    return raw.groupBy(id).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
