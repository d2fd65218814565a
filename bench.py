"""Benchmark: the headline query units at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is fully computed through the `noop` sink (every row produced,
nothing collected to the driver), building its DataFrame from scratch each
time. One untimed warm-up run of every headline query on the smallest fixture
compiles their code paths first (session start, JIT and code generation are
not part of a query's time).
Each query runs $BENCH_REPEAT times (default 2); the best run is reported,
the first run of each is listed too. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortflow.queries import QUERIES  # noqa: E402
from cohortflow.session import build_session  # noqa: E402

HEADLINE = [
    "event_dataset",
    "pre_event_profile",
    "post_event_profile",
    "leadership_at_start",
    "leadership_after",
    "attendance_before",
    "mentored_as_of",
    "second_generation",
    "contact_chart_depth",
    "leaders_in_chain",
    "event_attendees",
    "registration_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus)

    if os.path.isdir(warm_dir):
        for name in HEADLINE:  # untimed: JIT and generated-code warm-up for each plan shape
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    times: dict[str, float] = {}
    first: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(min(runs), 3)
        first[name] = round(runs[0], 3)

    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf,
                "cpus": cpus,
                "stat": f"min of {repeat} runs",
                "first_run_total": round(sum(first.values()), 3),
                "first_run": first,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
