"""Benchmark: headline sweep queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query runs to completion through the ``noop`` sink (full execution,
nothing collected to the driver).  ``build_log`` times the block-log sink
(an operator: records -> log) and counts in the total.  Writing the other
derived inputs (per-run stdout files, agent snapshots) is test-data
preparation, like generating tables: it is timed under ``fixtures`` and
not added to the total.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "blocklog_roundtrip", "explode_long", "long_parquet", "blocklog_stream", "blocklog_extract",
    "verdict", "run_counts", "duration_stats", "render_edit", "render_json", "config_kv",
    "params_csv", "replicates", "grid", "run_series", "timing_summary", "merge_sims", "location_dim",
    "stream_counts", "day_table_files",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    from sweepframe.plans import derived as D
    from sweepframe.plans import queries as Q
    from sweepframe.session import build_session

    spark = build_session()
    times, fixtures = {}, {}

    def timed(name, fn, into):
        t0 = time.time()
        fn()
        into[name] = round(time.time() - t0, 3)

    timed("build_log", lambda: D.d1_log(spark, sf_dir), times)
    timed("build_stdout", lambda: D.stdout_files(spark, sf_dir), fixtures)
    timed("build_snapshots", lambda: D.snapshots(spark, sf_dir), fixtures)
    timed("build_day_tables", lambda: D.day_table_files(spark, sf_dir), fixtures)
    qs = Q.queries()
    for name in names:
        timed(name, lambda n=name: qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save(), times)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "fixtures": fixtures, "sf": float(m.group(1)) if m else sf_dir}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
