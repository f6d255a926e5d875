"""Time the headline queries: one JSON line on stdout.

Each query runs once on the smallest data first, to start workers and compile, and is then
timed in full: building the plan, planning, and running it into a sink that takes every row.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from campusweave import catalog  # noqa: E402
from campusweave.session import local_session  # noqa: E402

HEADLINE = [
    "host_summary", "visible_text", "article_text", "node_counts", "links", "link_first_seen", "page_title",
    "clean_url", "url_parts", "frontier_expand", "pending", "block_pages", "completeness", "batch_progress", "split_parts",
    "vocabulary_hits", "label_values", "context_window", "capped_lines", "dedup_first_wins", "fallback_chain",
    "preceding_turn", "fee_format", "package_format", "import_listing", "ranking_dedup", "degree_tags", "html_tables",
    "listing_from_pages", "datasets_colleges", "datasets_courses", "datasets_placements", "datasets_rankings",
    "datasets_faculty", "datasets_scholarships", "datasets_hostel", "datasets_reviews", "datasets_admissions", "stream_ingest", "per_entity_export", "bundle", "pending_half", "frontier_half", "stored_tables",
]


def run(spark, name: str, sf: str) -> tuple[float, float]:
    """Seconds in all, and until the plan stood."""
    start = time.perf_counter()
    df = catalog.QUERIES[name](spark, sf)
    built = time.perf_counter() - start
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start, built


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    warm = os.path.join(os.path.dirname(sf.rstrip("/")), "sf0.001")
    spark = local_session("bench", cores)
    names = sys.argv[1:] or HEADLINE
    seconds, build = {}, {}
    for name in names:
        if os.path.isdir(warm):
            run(spark, name, warm)
        seconds[name], build[name] = (round(x, 3) for x in run(spark, name, sf))
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "build": build, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
