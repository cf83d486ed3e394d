"""Time the headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINES = (
    "score_articles", "filter_by_country", "top_pass_reasons", "dedup_marks", "dedup_all_titles",
    "feed_availability", "country_availability", "parse_feed_xml", "ingest_insert_ignore", "registry_sync_feeds",
    "triage_decisions", "rank_fields", "briefing_inputs", "export_countries", "clean_text_docs", "strip_html_pages",
    "stream_score",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from newsmart.plans.registered import QUERIES

    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINES
    # One small text job first, so that no query is charged for starting the JVM and Python workers.
    QUERIES["clean_text_pages"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
