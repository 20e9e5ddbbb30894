"""Headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs into a no-op sink: twice to warm up, then BENCH_RUNS times, of which the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lantern import build_session
from lantern.plans.registry import QUERIES

HEADLINE = [
    "eval_math_accuracy",
    "eval_choice_accuracy",
    "eval_dispatch",
    "code_jaccard",
    "rouge_full",
    "bleu",
    "eval_summary",
    "example_gpqa",
    "ingest_chunks",
    "rag_answer",
    "knn_top3",
    "knn_blocks",
    "ann_top3",
    "rag_prompt",
    "pref_pairs",
    "rank_completions",
    "group_advantage",
    "buffer_snapshots",
    "tokenise_prompts",
    "reward_pairs",
    "forecast_last5",
    "forecast_rolling",
    "stream_reassemble",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        taken = []
        for _ in range(runs + 2):
            start = time.perf_counter()
            QUERIES[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[2:]), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
