"""Pages over a table that moves on while a reader goes through them.

The first page takes the newest version of the table and its token names it; all further pages read that version, so
no row is missed or shown twice, however many batches are committed in between. A version can be read until it
is vacuumed; then the token is refused, and the reader starts again.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame

from vantrail.operators.reads import ACTIVE_MINUTES, DEFAULT_PAGE, active_page, active_pages
from vantrail.sources.versions import Table

_TOKEN = re.compile(r"([0-9]+)~(.*)")


def decode_token(token: str | None) -> tuple[int | None, str | None]:
    """(version, cursor) of a token; (None, None) for the first page."""
    if not token:
        return None, None
    found = _TOKEN.fullmatch(token)
    if not found:
        raise ValueError("the page token names no version")
    return int(found[1]), found[2]


def active_page_at(
    table: Table, as_of: datetime, token: str | None = None, country: str | None = None, limit: int = DEFAULT_PAGE, minutes: int = ACTIVE_MINUTES
) -> tuple[DataFrame, str | None]:
    """One page of the aircraft seen lately, newest first, and the token of the next one, or None after the last."""
    version, cursor = decode_token(token)
    snapshot = table.snapshot(version)
    page = active_page(table.read(snapshot), as_of, country, cursor, limit, minutes)
    following = page.where("next_cursor is not null").select("next_cursor").first()  # at most one row has it
    return page.drop("next_cursor"), f"{snapshot.version}~{following[0]}" if following else None


def active_pages_at(
    table: Table, as_of: datetime, token: str | None = None, country: str | None = None, limit: int = DEFAULT_PAGE, minutes: int = ACTIVE_MINUTES
) -> DataFrame:
    """All pages from the token on in one job, numbered from 0: each page of a walk reads the whole version, so a walk to the end reads it as often as there are pages."""
    version, cursor = decode_token(token)
    return active_pages(table.read(version), as_of, country, cursor, limit, minutes)
