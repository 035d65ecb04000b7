"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local cores), BENCH_RUNS
(timed runs per query; the median counts, after one warm-up), BENCH_ONLY (name
prefixes, separated by commas, or ``all``).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vantrail.plans import catalog  # noqa: E402
from vantrail.session import local_session  # noqa: E402

HEADLINE = (
    "a1_country_hour_state a2_country_hour_final a2_country_hour_final_all_deliveries a4_airline_hour_final a6_grid_final "
    "a7_merge_states a10_exact_distinct a12_leaderboard a13_top_airlines_climbing a14_density_in_box a15_week_over_week "
    "b3_active_count_day b6_avg_altitude_day b7_top_countries_day b8_aircraft_per_minute_day b9_emergencies_days "
    "d1_dedupe_first d2_dedupe_in_batch d3_collapse_versions u1_latest_state u2_merge_state u3_apply_outcomes "
    "q1_lookup_state q2_active_page q3_track_page q4_tracks_top_n q5_paginate q5_paginate_large_keys "
    "i1_check_unique i2_check_state_is_max i4_check_rollup_parity i6_check_key_order i7_find_duplicates r3_retain_rollup "
    "s1_explode_payloads s2_explode_snapshots s3_decode_topic s4_encode_topic p1_to_telemetry v17_ingest_report v18_quarantine "
    "s10_write_lake s11_read_lake s13_write_events_json s7_append_raw s8_upsert_state t10_stream_rollups d5_stream_dedupe"
).split()


def chosen() -> list[str]:
    only = os.environ.get("BENCH_ONLY", "")
    if only == "all":
        return list(catalog.QUERIES)
    if only:
        return [q for q in catalog.QUERIES if q.startswith(tuple(only.split(",")))]
    return HEADLINE


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    catalog.load()
    spark = local_session("bench", cpus)
    times: dict[str, float] = {}
    for name in chosen():
        measured = []
        # Jobs that write folders cost seconds each, so one timed run is enough.
        writes = name.startswith(("s7", "s8", "s9", "s10", "s11", "s12", "s13", "t", "d5", "a8", "i3"))
        for _ in range(1 + (1 if writes else runs)):
            began = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            measured.append(time.perf_counter() - began)
        times[name] = round(statistics.median(measured[1:]), 4)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
