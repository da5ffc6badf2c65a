"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Every query runs
whole and writes to Spark's `noop` sink, so no result is cut short or collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks.queries import QUERIES
from shelfmark.session import build_session

HEADLINE = [
    "publish_snapshot",
    "parse_lines",
    "stream_ingest",
    "snapshot_update",
    "latest_snapshot",
    "tokenize",
    "ngrams5",
    "term_counts",
    "doc_freq",
    "vocabulary_topk",
    "tfidf",
    "tfidf_vocabulary",
    "hash_split",
    "describe_by_split",
    "regression_metrics",
    "result_sorted",
    "chart_bins",
    "linreg_fit",
    "predictions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
