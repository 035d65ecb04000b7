"""The long-term lake: Parquet by day and country, ordered by time inside."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

LAKE_PLACE = ("observed_day", "origin_country", "observed_at", "event_id")


def write_lake(df: DataFrame, path: str, mode: str = "append", files: int | None = None) -> None:
    """Partition by (observed_day, origin_country), sorted by observed_at.

    Rows are range-partitioned on the whole sort order. A day and country with a
    third of all rows is thereby spread over many tasks, while each file still
    holds one narrow time range that row-group statistics can prune. ``files``
    is the number of writing tasks, the session's shuffle partitions by default;
    a day and country is cut only where one of them ends, so more tasks do not
    mean many small files.
    """
    tasks = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    day = df.withColumn("observed_day", F.to_date("observed_at"))
    (
        day.repartitionByRange(tasks, *LAKE_PLACE)
        .sortWithinPartitions(*LAKE_PLACE[:2], F.asc_nulls_last("observed_at"))
        .write.mode(mode)
        .partitionBy("observed_day", "origin_country")
        .parquet(path)
    )


def read_lake(
    spark: SparkSession,
    path: str,
    since: datetime | None = None,
    until: datetime | None = None,
    countries: list[str] | None = None,
) -> DataFrame:
    """Lake rows observed in [since, until).

    A filter on observed_at alone does not prune day partitions of plain
    Parquet, so the matching filter on observed_day is added here.
    """
    # The session's default infers number-like countries as numbers.
    lake = spark.read.parquet(path).withColumn("origin_country", F.col("origin_country").cast("string"))
    if since is not None:
        lake = lake.filter((F.col("observed_day") >= F.lit(since.date())) & (F.col("observed_at") >= F.lit(since)))
    if until is not None:
        lake = lake.filter((F.col("observed_day") <= F.lit(until.date())) & (F.col("observed_at") < F.lit(until)))
    if countries:
        lake = lake.filter(F.col("origin_country").isin(*countries))
    return lake


def lake_sql(spark: SparkSession, lake: DataFrame, sql: str, limit: int | None = None, name: str = "telemetry") -> DataFrame:
    """Run SQL on the lake under a short name; ``limit`` caps the result only when it is given."""
    lake.createOrReplaceTempView(name)
    result = spark.sql(sql)
    return result if limit is None else result.limit(limit)


def write_events_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One compact JSON object per line; null fields are left out, times keep microseconds."""
    df.write.mode(mode).json(path, ignoreNullFields=True, timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def evolve_to(df: DataFrame, schema: StructType, defaults: dict | None = None) -> DataFrame:
    """Older records under a newer schema: added nullable fields get their default.

    A new field without default, or a removed required one, is refused, as the
    compatibility rule does.
    """
    defaults = defaults or {}
    columns = []
    for field in schema.fields:
        if field.name in df.columns:
            columns.append(F.col(field.name).cast(field.dataType).alias(field.name))
        elif field.nullable or field.name in defaults:
            columns.append(F.lit(defaults.get(field.name)).cast(field.dataType).alias(field.name))
        else:
            raise ValueError(f"new field {field.name} needs to be nullable or have a default")
    return df.select(*columns)
