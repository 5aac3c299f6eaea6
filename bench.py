"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries": {key: sec}, "sf", ...}.
``mart_build`` is the one-off derivation + write of the landing table, the mart and
the segment cube (the cleaning + feature load); every other key is timed as a full
execution into the ``noop`` sink (no result transfer to the driver). One trivial job runs
untimed first so JVM/session start-up is not charged to the first query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


LATER = ("report_order", "stage_value_counts", "serial_ids", "csv_landing", "engineered_csv")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from ledgerlens.plans import mart
    from ledgerlens.plans.registry import QUERIES
    from ledgerlens.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(2, cpus), app_name="ledgerlens-bench")
    times: dict[str, float] = {}
    spark.range(1).count()  # session/JVM start-up, not query work: untimed

    t0 = time.perf_counter()
    mart.load(spark, sf_dir, "clean").cube  # landing table, mart and segment cube
    times["mart_build"] = time.perf_counter() - t0
    t0 = time.perf_counter()
    mart.load(spark, sf_dir, "dirty")
    times["mart_build_dirty"] = time.perf_counter() - t0

    errors: dict[str, str] = {}
    for key, fn in QUERIES.items():
        t0 = time.perf_counter()
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception as exc:  # noqa: BLE001 - report every key; one failure must not hide the rest
            errors[key] = f"{type(exc).__name__}: {str(exc)[:200]}"
            continue
        times[key] = time.perf_counter() - t0

    m = re.search(r"sf([0-9.]+)", sf_dir)
    total = sum(times.values())
    later = sum(t for k, t in times.items() if k.startswith("stored_") or k in LATER)
    print(json.dumps({
        "metric": "total_sec_all_queries",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "value_of_the_57_keys_of_round_1": round(total - later, 3),
        "n_queries": len(QUERIES),
        "n_failed": len(errors),
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
