"""Time the headline queries and print one JSON line.

Every query is planned and run to the end, all columns written to a sink that discards them.
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parley.registry import QUERIES  # noqa: E402

HEADLINE = (
    "scored_buckets", "alerts", "alert_events", "emerging_report",
    "build_conversations", "pair_completeness", "value_counts", "text_length_stats",
    "focus_text", "extract_issues_fallback", "token_budget", "explode_lines",
    "ngrams", "chunks", "tfidf_weights", "descriptive_terms", "encode_long_texts",
    "nearest_centroid", "silhouette_cosine", "rep_cosine", "pool_chunks", "kmeans_assign",
    "stratified_split", "eval_per_class", "confusion_matrix", "live_hourly_counts",
    "schema_summary", "subword_chunks", "emerging_issue_report", "live_late_events", "centroid_terms_given",
    "domain_predict", "domain_eval", "analyze",
)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("parley-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINE
    spark.read.parquet(os.path.join(sf_dir, "events.parquet")).groupBy("event_type").count().collect()
    seconds = {}
    for name in chosen:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
