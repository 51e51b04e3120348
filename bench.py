"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS, BENCH_QUERIES (comma-separated, `all` for every query) and
BENCH_RUNS (default 2; the best run of each query counts) may be set in the environment.
"""

import importlib
import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

HEADLINE = (
    "source_list load_content parse_pages parse_nested_pages embed_text points_distinct "
    "batch_plan upsert_latest collection_info scroll_page scroll_all search_vector "
    "search_text search_batch search_all_vectors search_approx answer_searches decode_requests "
    "ingest_job ingest_stream search_codes answer_pages op1_mixing op3_simhash op8_quality op9_packing "
    "op11_conversations op13_bpe"
).split()


def main() -> None:
    from pyspark.sql import SparkSession

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    queries = importlib.import_module("__spark_entry__").queries()
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(queries) if chosen == "all" else chosen.split(",") if chosen else [
        n for n in HEADLINE if n in queries]
    # The first use of the JVM and of a Python worker is not a query's own time.
    queries["search_vector"](spark, folder).count()
    queries["embed_query"](spark, folder).count()
    times = {}
    for name in names:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - start
            best = spent if best is None else min(best, spent)
        times[name] = round(best, 3)
    print(json.dumps({
        "metric": "total time of the headline queries", "value": round(sum(times.values()), 3),
        "unit": "sec", "runs": runs, "queries": times, "sf": os.path.basename(folder.rstrip("/"))[2:],
        "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
