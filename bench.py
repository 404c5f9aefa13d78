"""Wall seconds of the headline queries: one JSON line on standard output.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` the timed runs per query
(after one warm-up run, the median counts) and ``BENCH_QUERIES`` the queries, if not the default.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lodestep.catalog import QUERIES  # noqa: E402
from lodestep.session import build_session  # noqa: E402

HEADLINE = [
    "normalise_text", "harmonised_union", "dictionary_forms", "unmatched_skills", "posting_skill_pairs",
    "demand_counts", "survival_ladder", "demand_records", "posting_fingerprints", "near_duplicate_postings",
    "section_lines", "table_topics", "chunk_cascade", "split_topics", "tagged_documents", "topic_evidence",
    "syllabus_rollup", "nearest_with_margin", "top_n_accuracy", "usage_series", "fitted_trends", "ranked_gaps",
    "snapshot_counts",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session(
        f"local[{cpus}]", "bench", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]} s", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_wall_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": folder.rstrip("/").rsplit("/sf", 1)[-1], "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
