"""Compare a Spark result with DuckDB over the same Parquet files."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    """Floats as text, so that NaN equals NaN and -0.0 differs from 0.0."""
    return repr(v) if isinstance(v, float) else v


def difference(spark_df, con, sql: str) -> str | None:
    """None when columns and the multiset of rows agree, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns: spark {sorted(spark_df.columns)} duckdb {sorted(names)}"
    order = sorted(names)
    got = Counter(tuple(plain(r[c]) for c in order) for r in spark_df.collect())
    at = [names.index(c) for c in order]
    want = Counter(tuple(plain(r[i]) for i in at) for r in expected)
    if got == want:
        return None
    extra, missing = got - want, want - got
    return (
        f"{sum(got.values())} rows against {sum(want.values())}; columns {order}; "
        f"only spark {sum(extra.values())}: {list(extra)[:2]}; only duckdb {sum(missing.values())}: {list(missing)[:2]}"
    )
