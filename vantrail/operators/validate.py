"""The ordered rule set for pushed events. The first rule that fails is reported."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, functions as F

from vantrail.functions import computed_once, parse_rfc3339
from vantrail.schema import (
    TOO_LARGE,
    ICAO24_PATTERN,
    MAX_FUTURE_HOURS,
    POSITION_SOURCES,
    SQUAWK_PATTERN,
    TELEMETRY_COLUMNS,
)

Getter = Callable[[str], Column]

# --- Fixed values: the reported messages, in rule order, and the outcomes -----
MESSAGES = {
    "v1": "event_id is required",
    "v2": "icao24 is required",
    "v3": "icao24 must be 6 lowercase hex chars: %s",
    "v4": "origin_country is required",
    "v5": "observed_at is required",
    "v6": "position_source is required",
    "v7": "position_source %s is not one of ADSB, ASTERIX, MLAT, FLARM, UNKNOWN",
    "v8": "observed_at is not valid RFC3339",
    "v9": "observed_at is too far in the future (>24h)",
    "v10": "lat out of range [-90, 90]: %.6f",
    "v11": "lon out of range [-180, 180]: %.6f",
    "v12": "velocity_ms must be >= 0: %.6f",
    "v13": "true_track_deg must be in [0, 360): %.6f",
    "v14": "squawk must be 4 octal digits (0-7): %s",
    "v15": "category out of OpenSky range [0, 20]: %d",
}
# How a quoted value shows characters that would break its line.
QUOTED = {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t", "\x07": "\\a", "\x08": "\\b", "\x0b": "\\v", "\x0c": "\\f", "\x7f": "\\x7f"}
QUOTED |= {chr(c): f"\\x{c:02x}" for c in range(32) if chr(c) not in QUOTED}  # the other control characters by number
ACCEPTED_OUTCOME, REFUSED_OUTCOME, TOO_LARGE_OUTCOME = 202, 400, 413
# -----------------------------------------------------------------------------


def _quoted(text: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in QUOTED.items() for x in pair])
    shown = F.transform(F.split(text, ""), lambda c: F.coalesce(F.try_element_at(table, c), c))
    return F.concat(F.lit('"'), F.array_join(shown, ""), F.lit('"'))


def rules(get: Getter, as_of: datetime) -> dict[str, tuple[Column, Column | None]]:
    """Rule id -> (failure test, shown value), in order. ``get`` gives a field."""

    def blank(name: str) -> Column:
        return get(name).isNull() | (get(name) == "")

    def beyond(name: str, limit: float) -> Column:
        return (get(name) < -limit) | (get(name) > limit)

    observed = parse_rfc3339(get("observed_at"))
    track, squawk = get("true_track_deg"), get("squawk")
    return {
        "v1": (blank("event_id"), None),
        "v2": (blank("icao24"), None),
        "v3": (~get("icao24").rlike(ICAO24_PATTERN), _quoted(get("icao24"))),
        "v4": (blank("origin_country"), None),
        "v5": (blank("observed_at"), None),
        "v6": (blank("position_source"), None),
        "v7": (~get("position_source").isin(*POSITION_SOURCES), _quoted(get("position_source"))),
        "v8": (observed.isNull(), None),
        "v9": (observed > F.lit(as_of + timedelta(hours=MAX_FUTURE_HOURS)), None),
        "v10": (beyond("lat", 90), get("lat")),
        "v11": (beyond("lon", 180), get("lon")),
        "v12": (get("velocity_ms") < 0, get("velocity_ms")),
        "v13": ((track < 0) | (track >= 360), track),
        "v14": ((squawk != "") & ~squawk.rlike(SQUAWK_PATTERN), _quoted(squawk)),
        "v15": (~get("category").between(0, 20), get("category")),
    }


def first_failure(get: Getter, as_of: datetime) -> tuple[Column, Column]:
    """(rule id, message) of the first failing rule, both null for a good event."""
    rule, message = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, (fails, shown) in reversed(rules(get, as_of).items()):
        text = F.lit(MESSAGES[name]) if shown is None else F.format_string(MESSAGES[name], shown)
        rule = F.when(fails, F.lit(name)).otherwise(rule)
        message = F.when(fails, text).otherwise(message)
    return rule, message


def check(df: DataFrame, as_of: datetime) -> DataFrame:
    """Adds ``rule`` and ``error`` to flat event requests."""
    rule, message = first_failure(F.col, as_of)
    return computed_once(df, rule=rule, error=message)


def validate(df: DataFrame, as_of: datetime) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected)."""
    checked = check(df, as_of)
    return checked.filter(F.col("error").isNull()).drop("rule", "error"), checked.filter(F.col("error").isNotNull())


def to_telemetry(df: DataFrame, *keep: str) -> DataFrame:
    """Accepted requests as telemetry records.

    A missing position is 0.0 and a missing flag false, as the push contract has
    no null for them.
    """
    typed = {
        "observed_at": parse_rfc3339(F.col("observed_at")),
        "lat": F.coalesce("lat", F.lit(0.0)),
        "lon": F.coalesce("lon", F.lit(0.0)),
        "on_ground": F.coalesce("on_ground", F.lit(False)),
        "spi": F.coalesce("spi", F.lit(False)),
        "category": F.col("category").try_cast("int"),
    }
    return df.select(*keep, *[typed.get(c, F.col(c)).alias(c) for c in TELEMETRY_COLUMNS])


def position_in_bounds() -> Column:
    """The table's own check on coordinates, behind the rules."""
    return F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180)


def ingest_report(bodies: DataFrame, as_of: datetime, events: str = "events", body_error: str = "body_error") -> DataFrame:
    """One report row per request body, computed inside the row.

    ``events`` is the array of parsed requests. A body is bounded by the push
    contract, so its events are checked with array functions and nothing is
    shuffled. Adds accepted, rejected, errors and outcome.
    """

    def one(event: Column, index: Column) -> Column:
        _, message = first_failure(lambda name: event[name], as_of)
        return F.struct(
            index.cast("int").alias("index"), event["event_id"].alias("event_id"), message.alias("error")
        )

    checked = computed_once(bodies, _checked=F.transform(events, one))
    bad = F.filter("_checked", lambda e: e["error"].isNotNull())
    none = F.array().cast("array<struct<index:int,event_id:string,error:string>>")
    counted = (
        computed_once(checked, errors=F.coalesce(bad, none))
        .withColumn("rejected", F.size("errors"))
        .withColumn("accepted", F.coalesce(F.size("_checked"), F.lit(0)) - F.col("rejected"))
        .drop("_checked")
    )
    refused = F.col(body_error).isNotNull() | ((F.col("accepted") == 0) & (F.col("rejected") > 0))
    too_large = F.col(body_error) == TOO_LARGE
    outcome = F.when(too_large, TOO_LARGE_OUTCOME).when(refused, REFUSED_OUTCOME).otherwise(ACCEPTED_OUTCOME)
    return counted.withColumn("outcome", outcome)


def quarantine(df: DataFrame, as_of: datetime, name: str = "ingest") -> tuple[DataFrame, Observation]:
    """Events with their ``rule`` and ``error``, and the counts of both flows.

    One frame, so that the checks run once: rows with an error go to the
    quarantine table, the others on. The observation fills when an action runs.
    """
    counts = Observation(name)
    checked = check(df, as_of).observe(
        counts,
        F.count_if(F.col("error").isNull()).alias("accepted"),
        F.count_if(F.col("error").isNotNull()).alias("rejected"),
    )
    return checked, counts
