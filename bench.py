"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated names, or "all").
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "s05_report", "a02_traffic_summary", "w05_period_change", "g05_bottlenecks", "w03_top_queries",
    "w12_backfill", "s02_history", "a26_rescore_variance", "a27_flip_rate",
    "a28_threshold_sensitivity", "a30_spearman", "a33_majority_vote", "u03_upsert_candidates",
    "u06_attempts", "t12_lint", "t18_claim_count", "g06_heuristic_scores", "a15_mine_terms",
    "j04_best_article", "j07_related_items", "g09_article_search", "j14_case_search",
    "j17_term_documents", "t23_term_links", "r01_stream_dedupe",
)


def main() -> None:
    from sitegauge.plans import QUERIES
    from sitegauge.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = (list(QUERIES) if chosen == "all" else
             [n for n in chosen.split(",") if n] or [n for n in HEADLINE])
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus)

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("s05_report")  # start the JVM's compilers before timing
    times = {n: round(min(run(n) for _ in range(2)), 3) for n in names}
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
