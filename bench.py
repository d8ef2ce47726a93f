"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local cores.
Every query is run to its last row into a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from agora.catalog import QUERIES, views  # noqa: E402
from agora.session import local_session  # noqa: E402

HEADLINES = [
    "type_counts",
    "stories_by_month",
    "stories_by_quarter",
    "sibling_rank",
    "siblings_count",
    "nested_level",
    "thread_closure",
    "augmented_comments",
    "preference_pairs",
    "ancestor_chain",
    "comment_prompt_v1",
    "comments_with_story",
    "pair_dataset",
    "clean_text",
    "story_dataset",
    "sample_n",
    "sample_per_split",
    "metrics_by_split",
    "log_histogram",
    "density_grid",
    "leaderboards",
    "distribution_summary",
    "benchmark_summary",
    "rank_titles",
    "score_titles",
    "scraped_dataset",
    "text_rewards",
    "generation_table",
    "chat_length_filter",
    "batch_score",
    "incremental_scoring",
    "score_pairs",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = local_session(cpus, shuffle_partitions=max(8, int(cpus)))
    times: dict[str, float] = {}

    start = time.perf_counter()
    rows = views.items(spark, sf_dir).count()
    times["items_view"] = round(time.perf_counter() - start, 3)
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([\d.]+)$", sf_dir)
    extra = {}
    if "batch_score" in times:
        extra["batch_score_rows_per_sec"] = round(rows / times["batch_score"])
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
                **extra,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
