"""Time the headline queries; prints one line of JSON.

BENCH_SF_DIR is the data folder, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from feedlake.plans import catalog
from feedlake.session import build_session

HEADLINE = (
    "rss_entries", "stage_records", "staging_scan", "bronze_dedup", "silver_articles",
    "silver_articles_local", "gold_chunks", "gold_by_region", "upsert_articles", "upsert_chunks",
    "mark_embedded", "embed_hashed", "vector_metadata", "embed_job", "topk_cosine", "topk_scoped",
    "retrieve_text", "topk_keyword", "build_context", "route_parse", "insight_run",
    "stream_bronze", "stream_upsert",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog()
    # The session's first query pays for starting the JVM's and the workers' code.
    queries["gold_by_region"].run(spark, sf_dir).collect()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        # Every row and column is computed, nothing is written or sent to the driver.
        queries[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
            }
        )
    )


if __name__ == "__main__":
    main()
