"""Time the incremental job against a full rebuild over the same batch files.

Usage: python tools/incremental_timing.py <sf_dir> [runs]

Prints one JSON line: seconds to write the batch files, of the initial load, of each
incremental run (a replay of the second batch) and of each rebuild, the months touched of all, and
whether the reports are equal.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir, runs = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 3
    from revlens.plans import file_flow
    from revlens.session import build_session

    spark = build_session("local[8]", shuffle_partitions=8)

    def timed(f):
        t0 = time.perf_counter()
        out = f()
        return round(time.perf_counter() - t0, 2), out

    write, _ = timed(lambda: file_flow.batch_rows(spark, sf_dir, whole=True))
    initial, _ = timed(lambda: file_flow.started_job(spark, sf_dir, whole=True))
    incremental, rebuild = [], []
    for _ in range(runs):
        sec, got = timed(lambda: sorted(map(tuple, file_flow.incremental_report(spark, sf_dir).collect())))
        incremental.append(sec)
        sec, want = timed(lambda: sorted(map(tuple, file_flow.full_rebuild(spark, sf_dir).collect())))
        rebuild.append(sec)
    touched = len(file_flow.touched_months(spark, sf_dir, whole=True))
    print(json.dumps({"write_sec": write, "initial_sec": initial, "incremental_sec": incremental, "rebuild_sec": rebuild,
                      "months": len({r[0] for r in got}), "touched": touched, "equal": got == want}))
    spark.stop()


if __name__ == "__main__":
    main()
