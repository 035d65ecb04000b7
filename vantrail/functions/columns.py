"""Scalar expressions. All are built-in Spark functions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vantrail.schema import CELLS_PER_DEGREE, EMERGENCY_SQUAWKS, POSITION_SOURCES, VERTICAL_RATE_LIMIT_MS

_BLANKS = " \t\n\r\f\x0b"
_RFC3339 = r"^\d{4}-\d{2}-\d{2}T\d{1,2}:\d{2}:\d{2}([.,]\d+)?(Z|[+-]\d{2}:\d{2})\z"


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that later steps refer to instead of repeating them.

    Spark merges projections, so a costly expression that is used in many places
    is copied into each and plans grow without bound when this nests. A generator
    over one row is not merged.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def parse_rfc3339(text: Column) -> Column:
    """Timestamp of an RFC 3339 text with an offset; null when it is not one.

    The pattern comes first because Spark alone accepts ``2025-01-01`` too.
    Digits after the microsecond are cut.
    """
    return F.when(text.rlike(_RFC3339), F.replace(text, F.lit(","), F.lit(".")).try_cast("timestamp"))


def normalise_icao24(text: Column) -> Column:
    return F.lower(F.trim(text, F.lit(_BLANKS)))


def normalise_callsign(text: Column) -> Column:
    return F.nullif(F.trim(text, F.lit(_BLANKS)), F.lit(""))


def country_or_unknown(text: Column) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("Unknown"))


def position_source_name(code: Column) -> Column:
    """Name of a numeric source code; anything unlisted is the last name."""
    known, unknown = POSITION_SOURCES[:-1], POSITION_SOURCES[-1]
    number = code.try_cast("double")
    named = F.lit(unknown)
    for i, name in enumerate(known):
        named = F.when(number == F.lit(float(i)), F.lit(name)).otherwise(named)
    return named


def observed_or_poll_time(position_seconds: Column, poll_seconds: Column) -> Column:
    return F.coalesce(
        F.timestamp_seconds(position_seconds.try_cast("double")),
        F.timestamp_seconds(poll_seconds),
    )


def item(values: Column, index: int) -> Column:
    """Array item by position; null when the array is short."""
    return F.get(values, F.lit(index))


def number_at(values: Column, index: int) -> Column:
    return item(values, index).try_cast("double")


def flag_at(values: Column, index: int) -> Column:
    """Truth of an item: null or missing is false, any non-zero number is true."""
    text = item(values, index)
    return F.coalesce(text.try_cast("boolean"), text.try_cast("double") != 0, F.lit(False))


def stable_event_id(*parts: Column) -> Column:
    """Id in UUID form made from its parts, the same on every retry of a task.

    A random id would change when a lost stage is computed again, and dedupe
    could then not recognise the row.
    """
    h = F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)
    cut = lambda start, n: F.substring(h, start, n)
    return F.concat_ws("-", cut(1, 8), cut(9, 4), cut(13, 4), cut(17, 4), cut(21, 12))


def callsign_prefix(callsign: Column) -> Column:
    """First three characters; no callsign gives an empty prefix."""
    return F.coalesce(F.substring(callsign, 1, 3), F.lit(""))


def hour_bucket(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def minute_bucket(ts: Column) -> Column:
    return F.date_trunc("minute", ts)


def time_bucket(ts: Column, minutes: int = 5) -> Column:
    """Start of the epoch-aligned bucket of the given width."""
    seconds = F.unix_seconds(ts)
    return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(minutes * 60)))


def grid_cell(degrees: Column, cells_per_degree: int = CELLS_PER_DEGREE) -> Column:
    return F.floor(degrees * cells_per_degree).cast("smallint")


def cell_origin(cell: Column, cells_per_degree: int = CELLS_PER_DEGREE) -> Column:
    """South-west corner of a cell, in degrees."""
    return cell.cast("double") / F.lit(float(cells_per_degree))


def flight_phase(vertical_rate: Column) -> Column:
    """climbing, descending or cruising (limits included); null and NaN have none.

    NaN sorts above every number in Spark, so it is ruled out first.
    """
    limit = VERTICAL_RATE_LIMIT_MS
    return (
        F.when(F.isnan(vertical_rate), None)
        .when(vertical_rate > limit, "climbing")
        .when(vertical_rate < -limit, "descending")
        .when(vertical_rate.isNotNull(), "cruising")
    )


def is_emergency(squawk: Column) -> Column:
    return F.coalesce(squawk.isin(*EMERGENCY_SQUAWKS), F.lit(False))


def flag_text(flag: Column) -> Column:
    return flag.cast("string")


def rounded_mean(values: Column) -> Column:
    """Mean as a whole number, halves away from zero."""
    return F.round(F.avg(values).cast("decimal(38,10)"), 0).cast("bigint")


def to_kmh(ms: Column) -> Column:
    return ms * 3.6


def to_knots(ms: Column) -> Column:
    return ms * 1.943844


def rfc3339_text(ts: Column) -> Column:
    """UTC text of a timestamp; the fraction has no trailing zeros."""
    full = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.regexp_replace(full, r"\.?0+$", ""), F.lit("Z"))


def cursor_token(ts: Column, row_id: Column) -> Column:
    """Page cursor: URL-safe base64 without padding of ``time|id``."""
    raw = F.concat_ws("|", rfc3339_text(ts), row_id)
    # Base64 text comes in lines of 76 characters; translate drops their ends.
    return F.rtrim(F.translate(F.base64(raw.cast("binary")), "+/\r\n", "-_"), F.lit("="))
