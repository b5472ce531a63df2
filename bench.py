"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES
(comma list, default the headline queries, or ``all``).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from polyspark.queries import QUERIES  # noqa: E402
from polyspark.session import local_session  # noqa: E402

HEADLINE = [
    "fewshot_accuracy",
    "zero_shot_accuracy",
    "tokenize_words",
    "tokenize_vocabulary",
    "count_tokens",
    "pack_blocks",
    "word_counts",
    "char_inventory",
    "extend_vocab",
    "learn_bpe",
    "render",
    "fewshot_context",
    "rolling_windows",
    "length_batches",
    "scatter_back",
    "score_bigram",
    "weighted_perplexity",
    "rouge_n",
    "sari",
    "bleu",
    "chrf",
    "median",
    "bootstrap_f1",
    "macro_by_seen",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [q for q in chosen.split(",") if q] or HEADLINE
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    # starts the JVM's code paths and the Python workers once, outside the timings
    QUERIES["zero_shot_accuracy"][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        began = time.perf_counter()
        QUERIES[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
