"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     timed runs per query after one warm-up; the median counts (default 3)
BENCH_QUERIES  comma-separated names instead of the headline queries
"""

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from typerank.catalog import inputs  # noqa: E402
from typerank.catalog.queries import QUERIES  # noqa: E402
from typerank.operators.index import build_index  # noqa: E402
from typerank.sources.stage import clear  # noqa: E402

HEADLINE = [
    "type_documents",
    "index_build",
    "bm25_top10",
    "ltr_features",
    "tfidf_l2",
    "nb_predict",
    "evaluation_summary",
    "end_to_end_index",
    "end_to_end_baseline",
]


def index_build(spark, sf):
    """Tokenize all documents and write the tables of their index."""
    return build_index(inputs.corpus(spark, sf), unique=True).field_stats


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("typerank-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {**QUERIES, "index_build": index_build}
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, sf).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    clear(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
