"""Pushed bodies, snapshots, rules, wire format, lake and files."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F, types as T

from vantrail.operators import validate as v
from vantrail.operators.dedupe import dedupe_in_batch
from vantrail.plans import adapter
from vantrail.plans.catalog import Case, add
from vantrail.plans.oracle import FIELDS, REFUSED, REQUESTS, SNAP_ID, VECTORS
from vantrail.schema import TELEMETRY, TELEMETRY_COLUMNS
from vantrail.session import shared_folder
from vantrail.sources import lake, payloads, snapshots, wire

C = F.col


def events(c: Case):
    return payloads.explode_payloads(c.bodies)[0]


def checked(c: Case):
    return v.check(events(c), c.as_of)


add(
    "s1_explode_payloads",
    lambda c: events(c).select("request_id", "index", "event_id", "icao24", "origin_country", "lat", "lon", "category"),
    "SELECT request_id, index::INT AS index, event_id, icao24, origin_country, lat, lon, category::BIGINT AS category FROM told",
    REQUESTS,
)
add(
    "s1_refused_bodies",
    lambda c: payloads.explode_payloads(c.bodies)[1].select("request_id", "body_error"),
    "SELECT request_id, body_error FROM refused",
    REFUSED,
)
add(
    "s2_explode_snapshots",
    lambda c: snapshots.explode_snapshots(adapter.snapshots(c.spark, c.sf_dir), "body", "snapshot_id"),
    f"SELECT snapshot_id, {FIELDS.replace('event_id', SNAP_ID + ' AS event_id')} FROM snap",
    VECTORS,
)


def damaged_topic(c: Case):
    """Encoded telemetry in which some values cannot be read."""
    n = C("n")
    encoded = wire.encode_topic(c.telemetry, 7, "n")
    return encoded.withColumn(
        "value",
        F.when(n % 50 == 0, F.lit(bytearray(b"\x00\x00")))
        .when(n % 50 == 1, F.concat(F.lit(bytearray(b"\x01")), F.expr("substring(value, 2)")))
        .when(n % 50 == 2, F.lit(bytearray(b"\x00\x00\x00\x00\x01\xff")))
        .when(n % 50 == 3, None)
        .when(n % 50 == 4, F.expr("substring(value, 1, length(value) - 3)"))
        .otherwise(C("value")),
    )


add(
    "s3_decode_topic",
    lambda c: wire.split_decoded(wire.decode_topic(damaged_topic(c)))[0].drop("key"),
    f"SELECT n, {FIELDS} FROM tel WHERE n % 50 > 4",
)
add(
    "s3_dead_letters",
    lambda c: wire.split_decoded(wire.decode_topic(damaged_topic(c)))[1].select("n", "error"),
    "SELECT n, CASE WHEN n % 50 IN (0, 3) THEN 'message too short' WHEN n % 50 = 1 THEN 'unexpected magic byte' "
    "ELSE 'avro record cannot be decoded' END AS error FROM tel WHERE n % 50 <= 4",
)
# Bytes of one record: text is a length byte and its bytes, a nullable value has a
# branch byte, a time in microseconds of these years takes eight bytes.
SIZE = (
    "5 + 1 + length(event_id) + 1 + length(icao24) + coalesce(2 + length(callsign), 1) + 1 + length(origin_country) + 8 + 1 + 16 "
    "+ CASE WHEN baro_altitude_m IS NULL THEN 1 ELSE 9 END + CASE WHEN geo_altitude_m IS NULL THEN 1 ELSE 9 END "
    "+ CASE WHEN velocity_ms IS NULL THEN 1 ELSE 9 END + 9 + CASE WHEN vertical_rate_ms IS NULL THEN 1 ELSE 9 END "
    "+ 1 + coalesce(2 + length(squawk), 1) + 1 + CASE WHEN category IS NULL THEN 1 ELSE 2 END"
)
add(
    "s4_encode_topic",
    lambda c: wire.encode_topic(c.telemetry, 7, "n").select(
        "n",
        C("key").cast("string").alias("key"),
        F.hex(F.substring("value", 1, 5)).alias("header"),
        F.length("value").alias("size"),
    ),
    f"SELECT n, icao24 AS key, '0000000007' AS header, ({SIZE})::INT AS size FROM tel",
)

add(
    "p1_to_telemetry",
    lambda c: v.to_telemetry(v.validate(events(c), c.as_of)[0], "request_id"),
    f"SELECT request_id, {FIELDS} FROM req WHERE fault NOT BETWEEN 1 AND 15",
    REQUESTS,
)


def without_optionals(c: Case):
    """Bodies of the required fields only."""
    fields = ["event_id", "icao24", "origin_country", "position_source"]
    at = F.date_format("observed_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("observed_at")
    body = F.to_json(F.struct(*fields, at)).alias("body")
    return payloads.explode_payloads(c.telemetry.select("n", body))[0]


add(
    "p1_to_telemetry_defaults",
    lambda c: v.to_telemetry(without_optionals(c), "n").select("n", "observed_at", "lat", "lon", "on_ground", "spi", "callsign", "category"),
    "SELECT n, observed_at, 0::DOUBLE AS lat, 0::DOUBLE AS lon, false AS on_ground, false AS spi, "
    "NULL::VARCHAR AS callsign, NULL::INT AS category FROM tel",
)

for k in range(1, 16):
    add(
        f"v{k}_rule",
        lambda c, k=k: checked(c).filter(C("rule") == f"v{k}").select("request_id", "index", "event_id", "error"),
        f"SELECT request_id, index::INT AS index, event_id, error FROM told WHERE rule = 'v{k}'",
        REQUESTS,
    )
add(
    "v16_position_check",
    lambda c: events(c).filter(~v.position_in_bounds()).select("request_id", "index", "lat", "lon"),
    "SELECT request_id, index::INT AS index, lat, lon FROM told WHERE lat > 90 OR lon < -180",
    REQUESTS,
)


def reports(c: Case):
    report = v.ingest_report(payloads.parse_bodies(c.bodies), c.as_of)
    lines = F.transform("errors", lambda e: F.concat_ws(" ", e["index"].cast("string"), e["event_id"], e["error"]))
    return report.select("request_id", "accepted", "rejected", "outcome", "body_error", F.array_join(lines, "\n").alias("errors"))


add(
    "v17_ingest_report",
    reports,
    """SELECT request_id, count(*) FILTER (WHERE rule IS NULL)::INT AS accepted, count(rule)::INT AS rejected,
         CASE WHEN count(rule) = count(*) THEN 400 ELSE 202 END AS outcome, NULL AS body_error,
         coalesce(string_agg(index || ' ' || event_id || ' ' || error, chr(10) ORDER BY index) FILTER (WHERE rule IS NOT NULL), '') AS errors
       FROM told GROUP BY 1
       UNION ALL SELECT request_id, 0, 0, 400, body_error, '' FROM refused
       UNION ALL SELECT 'x' || n, 0, 0, 202, NULL, '' FROM tel WHERE n % 100 = 61""",
    REQUESTS + REFUSED,
)


def quarantined(c: Case):
    checked, _ = v.quarantine(events(c), c.as_of)
    flow = F.when(C("error").isNull(), "accepted").otherwise("rejected")
    return checked.groupBy(flow.alias("flow")).agg(F.count(F.lit(1)).alias("events"))


add(
    "v18_quarantine",
    quarantined,
    "SELECT CASE WHEN rule IS NULL THEN 'accepted' ELSE 'rejected' END AS flow, count(*) AS events FROM told GROUP BY 1",
    REQUESTS,
)


def stored_lake(c: Case) -> str:
    """The feed in the lake: one row per id and flush."""
    path = shared_folder(c.spark, "lake")
    rows = dedupe_in_batch(c.feed.withColumn("flush", F.floor(C("seq") / 10_000)), "flush")
    lake.write_lake(rows, path)
    return path


IN_LAKE = (
    f"(SELECT {FIELDS}, seq, seq // 10000 AS flush, observed_at::DATE AS observed_day FROM feed "
    "QUALIFY row_number() OVER (PARTITION BY seq // 10000, event_id ORDER BY seq) = 1)"
)


def counted_lake(c: Case):
    rows = lake.read_lake(c.spark, stored_lake(c))
    return rows.groupBy("observed_day", "origin_country").agg(
        F.count(F.lit(1)).alias("observations"), F.min("observed_at").alias("first_at"), F.max("observed_at").alias("last_at")
    )


add(
    "s10_write_lake",
    counted_lake,
    f"SELECT observed_day, origin_country, count(*) AS observations, min(observed_at) AS first_at, max(observed_at) AS last_at FROM {IN_LAKE} GROUP BY 1, 2",
)
add(
    "s11_read_lake",
    lambda c: lake.read_lake(
        c.spark, stored_lake(c), c.as_of - timedelta(days=7), c.as_of - timedelta(days=2), ["NATION_2", "NATION_5"]
    ).select(*TELEMETRY_COLUMNS, "seq"),
    f"SELECT {FIELDS}, seq FROM {IN_LAKE} WHERE origin_country IN ('NATION_2', 'NATION_5') "
    "AND observed_at >= (SELECT t FROM last_seen) - INTERVAL 7 DAY AND observed_at < (SELECT t FROM last_seen) - INTERVAL 2 DAY",
)
LAKE_QUESTION = "SELECT origin_country, count(*) AS observations, max(baro_altitude_m) AS highest FROM {} GROUP BY 1"
add(
    "s12_lake_sql",
    lambda c: lake.lake_sql(c.spark, lake.read_lake(c.spark, stored_lake(c)), LAKE_QUESTION.format("telemetry")),
    LAKE_QUESTION.format(IN_LAKE),
)


def json_lines(c: Case):
    path = shared_folder(c.spark, "json")
    lake.write_events_json(c.feed.select(*TELEMETRY_COLUMNS), path)
    return c.spark.read.schema(TELEMETRY).json(path)


add("s13_write_events_json", json_lines, f"SELECT {FIELDS} FROM feed")


def older_records(c: Case):
    """Records written before two fields were added, under today's layout."""
    old = c.telemetry.select(*[f for f in TELEMETRY_COLUMNS if f not in ("category", "spi")])
    return lake.evolve_to(old, T.StructType(TELEMETRY.fields), {"spi": False})


add(
    "s14_evolve_to",
    older_records,
    f"SELECT * REPLACE (NULL::INT AS category, false AS spi) FROM (SELECT {FIELDS} FROM tel)",
)
