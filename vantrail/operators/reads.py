"""Point reads, listings and paged trajectories."""

from __future__ import annotations

import base64
import re
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Window, functions as F

from vantrail.functions import cursor_token, parse_rfc3339
from vantrail.operators.ranking import first_per_key, ranked
from vantrail.schema import ACTIVE_MINUTES, DEFAULT_PAGE, MAX_PAGE


@dataclass(frozen=True)
class Cursor:
    """Position of the last row served: its time text and its id."""

    at: str
    row_id: str


#: The decoded text of a cursor: a time of the form the service writes, and the id after the first bar.
CURSOR_PATTERN = re.compile(r"(?P<at>\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:\d{2}))\|(?P<row_id>.+)", re.DOTALL | re.ASCII)


def decode_cursor(token: str | None) -> Cursor | None:
    """Cursor of a token; an empty token is the start, any other that no page could have given is an error."""
    if not token:
        return None
    try:
        if not re.fullmatch(r"[A-Za-z0-9_-]+", token):
            raise ValueError("not the alphabet of a page token")
        text = base64.urlsafe_b64decode(token + "=" * (-len(token) % 4)).decode()
        parts = CURSOR_PATTERN.fullmatch(text)
        datetime.fromisoformat(parts["at"])
    except (ValueError, TypeError) as e:
        raise ValueError(f"not a page token: {token}") from e
    return Cursor(parts["at"], parts["row_id"])


def check_limit(limit: int | None) -> int:
    """Page size: default when not given, an error outside [1, maximum]."""
    if limit is None:
        return DEFAULT_PAGE
    if not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"limit must be between 1 and {MAX_PAGE}")
    return limit


def clamp_limit(limit: int) -> int:
    """Size of one served page: default when not positive, cut at the maximum."""
    return DEFAULT_PAGE if limit <= 0 else min(limit, MAX_PAGE)


def _at_least_one(n: int) -> int:
    if n < 1:
        raise ValueError("at least 1 is needed")
    return n


def active_since(as_of: datetime, minutes: int = ACTIVE_MINUTES) -> Column:
    """Observed at most ``minutes`` before ``as_of``, the limit included."""
    return F.col("observed_at") >= F.lit(as_of - timedelta(minutes=minutes))


def before_cursor(cursor: Cursor, ts: str, row_id: str) -> Column:
    """Rows after the cursor in descending (time, id) order.

    Written out instead of as a struct comparison, because this form is pushed
    down to the file scan.
    """
    at = parse_rfc3339(F.lit(cursor.at))
    return (F.col(ts) <= at) & ((F.col(ts) < at) | (F.col(row_id) < F.lit(cursor.row_id)))


def lookup_state(state: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """State rows of the wanted aircraft, and the wanted keys that have none.

    The key list is deduplicated by the semi join; whether a side is small
    enough to broadcast is left to Spark's own size check.
    """
    wanted = keys.select("icao24").distinct()
    return state.join(wanted, "icao24", "left_semi"), wanted.join(state, "icao24", "left_anti")


def _page(df: DataFrame, ts: str, row_id: str, limit: int) -> DataFrame:
    """First ``limit`` rows, newest first; the last one has the cursor if more exist.

    One row more is fetched to see that. The window runs over that fetch, which
    the page maximum bounds, not over the table.
    """
    order = [F.desc(ts), F.desc(row_id)]
    fetched = df.orderBy(*order).limit(limit + 1)
    w = Window.orderBy(*order)
    return (
        fetched.withColumn("_rn", F.row_number().over(w))
        .withColumn("_more", F.lead(F.lit(True)).over(w))
        .filter(F.col("_rn") <= limit)
        .withColumn(
            "next_cursor",
            F.when((F.col("_rn") == limit) & F.col("_more"), cursor_token(F.col(ts), F.col(row_id))),
        )
        .drop("_rn", "_more")
    )


def _active(state: DataFrame, as_of: datetime, country: str | None, cursor: str | None, minutes: int) -> DataFrame:
    rows = state.filter(active_since(as_of, minutes))
    if country:
        rows = rows.filter(F.col("origin_country") == country)
    start = decode_cursor(cursor)
    return rows.filter(before_cursor(start, "observed_at", "icao24")) if start else rows


def active_page(
    state: DataFrame,
    as_of: datetime,
    country: str | None = None,
    cursor: str | None = None,
    limit: int = DEFAULT_PAGE,
    minutes: int = ACTIVE_MINUTES,
) -> DataFrame:
    """One page of the aircraft seen lately, newest first."""
    return _page(_active(state, as_of, country, cursor, minutes), "observed_at", "icao24", clamp_limit(limit))


#: Width of the slices of time by which ``active_pages`` numbers the aircraft.
ACTIVE_SLICE = 600


def active_pages(
    state: DataFrame,
    as_of: datetime,
    country: str | None = None,
    cursor: str | None = None,
    limit: int = DEFAULT_PAGE,
    minutes: int = ACTIVE_MINUTES,
) -> DataFrame:
    """All pages after the cursor in one job, as walking on would give them, with their number ``page`` from 0."""
    rows = _active(state, as_of, country, cursor, minutes).withColumn("_all", F.lit(0))
    numbered = ranked(rows, "_all", [F.desc("observed_at"), F.desc("icao24")], F.floor(F.unix_timestamp("observed_at") / ACTIVE_SLICE))
    return numbered.withColumn("page", F.floor((F.col("rank") - 1) / clamp_limit(limit)).cast("int")).drop("_all", "rank", "total")


def track_page(raw: DataFrame, icao24: str, cursor: str | None = None, limit: int = DEFAULT_PAGE) -> DataFrame:
    """One page of an aircraft's observations, newest first."""
    rows = raw.filter(F.col("icao24") == icao24)
    start = decode_cursor(cursor)
    if start:
        rows = rows.filter(before_cursor(start, "observed_at", "event_id"))
    return _page(rows, "observed_at", "event_id", clamp_limit(limit))


def tracks_top_n(raw: DataFrame, n: int = DEFAULT_PAGE) -> DataFrame:
    """The newest ``n`` observations of every aircraft in one job; any n from 1 on."""
    return first_per_key(raw, ["icao24"], [F.desc("observed_at"), F.desc("event_id")], _at_least_one(n))


def paginate(
    df: DataFrame,
    size: int,
    key: str = "icao24",
    ts: str = "observed_at",
    row_id: str = "event_id",
    slice_seconds: int = 86_400,
) -> DataFrame:
    """All pages of all keys at once, as walking the cursors would give them; any size from 1 on.

    A key is numbered in slices of ``slice_seconds``.
    """
    _at_least_one(size)
    rows = ranked(df, key, [F.desc(ts), F.desc(row_id)], F.floor(F.unix_timestamp(ts) / slice_seconds))
    last = (F.col("rank") % size == 0) & (F.col("rank") < F.col("total"))
    return (
        rows.withColumn("page", F.floor((F.col("rank") - 1) / size).cast("bigint"))
        .withColumn("next_cursor", F.when(last, cursor_token(F.col(ts), F.col(row_id))))
        .drop("total")
    )


def utc(text: str) -> datetime:
    """Aware UTC moment of an ISO text, for parameters."""
    moment = datetime.fromisoformat(text)
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
