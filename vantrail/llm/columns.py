"""Names of helper columns that cannot clash with those of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def hidden(name: str, *tables: DataFrame) -> str:
    """``name``, with underscores in front until none of ``tables`` has such a column, in any letter case."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
