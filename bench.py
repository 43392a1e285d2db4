"""Time the headline queries and print one JSON line.

BENCH_SF_DIR: folder of the tables (default /root/testdata/sf0.1). BENCH_CPUS: cores (default 8).
BENCH_RUNS: timed runs after one warm-up (default 3; the median counts). Results go to the noop
sink, so every row is computed and none is collected.
"""

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from bidscope import catalog  # noqa: E402
from bidscope.session import build_session, release  # noqa: E402

HEADLINE = [
    "coverage_30d",
    "closing_soon_buckets",
    "new_this_week",
    "top_category",
    "top_public_buyer",
    "top_public_buyer_all_time",
    "response_window_category",
    "short_response_windows",
    "list_page",
    "has_archive_counts",
    "contract_check",
    "upsert_tenders",
    "status_updates",
    "text_dates_backfill",
    "knn_exact",
    "knn_batch",
    "knn_approximate",
    "chunk_documents",
    "chunk_document_lines",
    "hash_embed",
    "retrieve_text",
    "replace_files",
    "page_text",
    "result_page_rows",
    "zip_expand",
    "index_run",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
            release(spark)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
                "spark": spark.version,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
