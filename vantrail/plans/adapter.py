"""The given ``events`` table seen as aircraft telemetry, with disorder added.

Everything is arithmetic on the event's own columns, so the same rows can be
written in SQL (``oracle.py``) and their number grows with the table.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vantrail.schema import POSITION_SOURCES, TELEMETRY_COLUMNS

AIRLINES = ("BAW", "DLH", "AFR", "UAL", "KLM")


def _every(n: Column, k: int, rest: int = 0) -> Column:
    return n % k == rest


def _pick(names, i: Column) -> Column:
    return F.get(F.array(*[F.lit(x) for x in names]), i.cast("int"))


def padded(n: Column) -> Column:
    return F.lpad(n.cast("string"), 12, "0")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry columns plus ``n`` (event number) and ``seq`` (arrival order)."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    n, u = F.col("event_id"), F.col("user_id")
    ground = _every(n, 20)
    baro = F.when(~ground & ~_every(n, 17), (n % 12000).cast("double"))
    fields = {
        "event_id": F.concat(F.lit("00000000-0000-0000-0000-"), padded(n)),
        "icao24": F.lpad(F.lower(F.hex(u)), 6, "0"),
        "callsign": F.when(_every(u, 10), None)
        .when(_every(u, 10, 1), "N1")
        .otherwise(F.concat(_pick(AIRLINES, u % 5), u.cast("string"))),
        "origin_country": F.concat(F.lit("NATION_"), (u % 25).cast("string")),
        "observed_at": F.col("ts").cast("timestamp"),
        "position_source": _pick(POSITION_SOURCES, n % 5),
        "lat": F.lit(50.0) + (u % 4) / 2.0 + (n % 3) / 10.0,
        "lon": (u % 8 - 4) / 2.0 + (n % 3) / 10.0,
        "baro_altitude_m": baro,
        "geo_altitude_m": baro + n % 7,
        "velocity_ms": F.when(~ground & ~_every(n, 13), F.col("value")),
        "true_track_deg": (n % 360).cast("double"),
        "vertical_rate_ms": F.when(~_every(n, 11), (n % 31 - 15) / 2.0),
        "on_ground": ground,
        "squawk": F.when(_every(n, 50, 3), None).otherwise(
            F.when(_every(n, 50), "7700").when(_every(n, 50, 1), "7600").when(_every(n, 50, 2), "7500").otherwise("1200")
        ),
        "spi": _every(n, 100),
        "category": F.when(~_every(n, 4), (n % 21).cast("int")),
    }
    seq = F.when(_every(n, 10, 3), (n + 500) * 10 + 1).otherwise(n * 10)
    return events.select(*[fields[c].alias(c) for c in TELEMETRY_COLUMNS], n.alias("n"), seq.alias("seq"))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals with exact replays, ties and changed repeats, from one scan."""
    base = telemetry(spark, sf_dir)
    n = F.col("n")
    kinds = F.array_compact(
        F.array(
            F.lit("base"),
            F.when(_every(n, 20, 7), F.lit("replay")),
            F.when(_every(n, 30, 11), F.lit("tie")),
            F.when(_every(n, 40, 9), F.lit("changed")),
        )
    )
    rows = base.select("*", F.explode(kinds).alias("_kind"))
    tie, changed = F.col("_kind") == "tie", F.col("_kind") == "changed"
    return (
        rows.withColumn(
            "event_id",
            F.when(tie, F.concat(F.lit("00000001"), F.substring("event_id", 9, 28))).otherwise(F.col("event_id")),
        )
        .withColumn("velocity_ms", F.when(tie, F.col("velocity_ms") + 1).otherwise(F.col("velocity_ms")))
        .withColumn(
            "observed_at",
            F.when(changed, F.col("observed_at") - F.expr("interval 1 hour")).otherwise(F.col("observed_at")),
        )
        .withColumn(
            "seq",
            F.when(F.col("_kind") == "replay", (n + 100) * 10 + 2)
            .when(tie, (n + 50) * 10 + 3)
            .when(changed, (n + 200) * 10 + 4)
            .otherwise(F.col("seq")),
        )
        .drop("n", "_kind")
    )


def as_of(spark: SparkSession, sf_dir: str) -> datetime:
    """Latest observation of the feed, the moment all queries look back from."""
    ts = spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.max("ts")).first()[0]
    return ts.replace(tzinfo=timezone.utc)


# Faults by n % 200, in rule order: (field, JSON value).
FAULTS = {
    1: ("event_id", ""),
    2: ("icao24", ""),
    3: ("icao24", "ABC123"),
    4: ("origin_country", ""),
    5: ("observed_at", ""),
    6: ("position_source", ""),
    7: ("position_source", "GPS"),
    8: ("observed_at", "2024-01-01"),
    9: ("observed_at", "2099-01-01T00:00:00Z"),
    10: ("lat", 90.5),
    11: ("lon", -180.5),
    12: ("velocity_ms", -1.5),
    13: ("true_track_deg", 360.0),
    14: ("squawk", "1289"),
    15: ("category", 21),
}


def _request(rows: DataFrame) -> DataFrame:
    """Rows as JSON objects, one fault injected where n % 200 names a rule."""
    text = rows.withColumn("observed_at", F.date_format("observed_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    for k, (field, value) in FAULTS.items():
        text = text.withColumn(field, F.when(F.col("n") % 200 == k, F.lit(value)).otherwise(F.col(field)))
    return text.select("n", F.to_json(F.struct(*TELEMETRY_COLUMNS)).alias("json"))


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request bodies (request_id, body): ten events each as a wrapper or an
    array, or one body per event, and bodies that cannot be read."""
    rows = _request(telemetry(spark, sf_dir))
    block = F.floor(F.col("n") / 10)
    shape = block % 3
    single = rows.filter(shape == 0).select(F.concat(F.lit("s"), F.col("n").cast("string")).alias("request_id"), F.col("json").alias("body"))
    # Ten consecutive events at most share a block.
    lists = (
        rows.filter(shape != 0)
        .groupBy(block.alias("block"))
        .agg(F.array_sort(F.collect_list(F.struct("n", "json"))).alias("_rows"))
        .select("block", F.concat(F.lit("["), F.array_join("_rows.json", ","), F.lit("]")).alias("list"))
    )
    wrapped = lists.select(
        F.concat(F.when(F.col("block") % 3 == 1, "w").otherwise("a"), F.col("block").cast("string")).alias("request_id"),
        F.when(F.col("block") % 3 == 1, F.concat(F.lit('{"events":'), F.col("list"), F.lit("}")))
        .otherwise(F.col("list"))
        .alias("body"),
    )
    json = F.col("json")
    odd = {
        60: F.lit(""),
        61: F.lit('{"events":[]}'),
        62: F.concat(F.lit(" \n"), json),
        63: F.lit("hello"),
        64: F.concat(F.lit("["), json, F.lit(',{"event_id":5}]')),
        65: F.substring(json, 1, 60),
        66: F.concat(F.lit('{"events":'), json, F.lit("}")),
        67: F.concat(json, F.lit(" trailing")),
    }
    body = F.lit(None).cast("string")
    for k, text in odd.items():
        body = F.when(F.col("n") % 100 == k, text).otherwise(body)
    strange = rows.filter((F.col("n") % 100).between(60, 67)).select(
        F.concat(F.lit("x"), F.col("n").cast("string")).alias("request_id"), body.alias("body")
    )
    return single.unionByName(wrapped).unionByName(strange)


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One snapshot body per minute and aircraft block: positional vectors of 17
    or 18 values, some without a position, with an upper-case id, a padded
    callsign or cut short."""
    rows = telemetry(spark, sf_dir)
    n = F.col("n")
    text = lambda c: F.col(c).cast("string")
    quoted = lambda c: F.coalesce(F.concat(F.lit('"'), c, F.lit('"')), F.lit("null"))
    number = lambda c: F.coalesce(text(c), F.lit("null"))
    source = F.when(n % 5 == 4, F.lit("9")).otherwise((n % 5).cast("string"))
    values = [
        quoted(F.when(n % 100 == 51, F.upper("icao24")).otherwise(F.col("icao24"))),
        quoted(F.when(n % 100 == 52, F.concat(F.lit("  "), "callsign", F.lit("   "))).when(n % 100 == 53, F.lit("   ")).otherwise(F.col("callsign"))),
        quoted(F.when(n % 100 == 54, F.lit("")).when(n % 100 == 55, None).otherwise(F.col("origin_country"))),
        F.when(n % 100 == 56, "null").otherwise(F.unix_seconds("observed_at").cast("string")),
        F.unix_seconds("observed_at").cast("string"),
        number("lon"),
        F.when(n % 100 == 50, "null").otherwise(number("lat")),
        number("baro_altitude_m"),
        text("on_ground"),
        number("velocity_ms"),
        number("true_track_deg"),
        number("vertical_rate_ms"),
        F.lit("null"),
        number("geo_altitude_m"),
        quoted(F.col("squawk")),
        text("spi"),
        source,
    ]
    short = F.concat_ws(",", *values[:8])
    full = F.concat_ws(",", *values)
    vector = F.when(n % 100 == 57, short).when(n % 2 == 0, full).otherwise(F.concat_ws(",", full, number("category")))
    # Ten consecutive events at most share a snapshot.
    return (
        rows.select("n", F.floor(n / 10).alias("snapshot_id"), F.concat(F.lit("["), vector, F.lit("]")).alias("vector"))
        .groupBy("snapshot_id")
        .agg(F.array_sort(F.collect_list(F.struct("n", "vector"))).alias("_v"))
        .select(
            "snapshot_id",
            F.concat(
                F.lit('{"time":'),
                (F.lit(1704067200) + F.col("snapshot_id") * 60).cast("string"),
                F.lit(',"states":['),
                F.array_join("_v.vector", ","),
                F.lit("]}"),
            ).alias("body"),
        )
    )
