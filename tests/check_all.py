"""Run every query against its SQL: ``python tests/check_all.py <sf_dir> [name part ...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import difference, duck  # noqa: E402

from vantrail.plans import catalog  # noqa: E402
from vantrail.session import local_session  # noqa: E402


def main() -> int:
    sf_dir, parts = sys.argv[1], sys.argv[2:]
    catalog.load()
    spark, con, failed = local_session("check", 8), duck(sf_dir), []
    for name, build in catalog.QUERIES.items():
        if parts and not any(name.startswith(p) for p in parts):
            continue
        began = time.time()
        try:
            df = build(spark, sf_dir)
            problem = difference(df, con, catalog.ORACLE[name]) if name in catalog.ORACLE else f"rows only: {df.count()}"
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - began:.1f}s {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
