"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line. Each query is forced with the ``noop`` sink, so the
whole plan runs on the executors and nothing is collected to the driver."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plenum.plans import QUERIES  # noqa: E402
from plenum.session import get_session  # noqa: E402

HEADLINE = [
    "unit_year_panel", "panel_rollup", "repair_totals", "downballot_shares", "weighted_index",
    "group_weight", "coverage_kde", "star_master", "affordability", "collapse_units",
    "split_blocks", "meeting_header", "item_records", "training_pairs", "salvage_json",
    "link_extract", "page_text", "ensure_and_order", "conversation_pairs", "longest_text_per_key",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or (HEADLINE if os.environ.get("BENCH_ALL") != "1" else list(QUERIES))
    spark = get_session(f"local[{cpus}]", int(cpus) * 2)
    # JVM warm-up (class loading, JIT) on the smallest data set, not timed.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    for name in ("unit_year_panel", "split_blocks"):
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_headline_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
