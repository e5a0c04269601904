"""Time the headline queries and print one JSON line.

BENCH_SF_DIR: folder of the test tables (default /root/testdata/sf0.1).
BENCH_CPUS: cores of the local session (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time

from docquery.plans import catalog
from docquery.session import get_session

HEADLINE = [
    "search_bm25",
    "msearch_benchmark",
    "explain_terms",
    "count_match",
    "terms_enum_prefix",
    "analyze_tokens",
    "termvectors",
    "rank_eval_precision",
    "scroll_page",
    "number_pages",
    "msearch_template",
    "tile_grid",
    "doc_index",
    "doc_create",
    "doc_exists",
    "doc_update",
    "doc_mget",
    "update_by_query",
    "bulk_apply_state",
    "bulk_apply_items",
    "bulk_ndjson_apply",
    "pit_as_of",
    "cast_date",
    "cast_ip",
    "cast_binary",
    "decode_nested",
    "encode_table",
    "decode_mixed",
    "cast_report",
    "split_counts",
    "routed_counts",
    "rollover_docs",
    "disk_usage",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__driver__memory="20g",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()
    timings = {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {timings[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
