"""Time the metric queries on the test tables; prints one JSON line."""

import json
import os
import time
from pathlib import Path

from pyspark.sql import SparkSession

from plateful import queries

HEADLINE = [
    queries.customer_lifetime_value, queries.customer_segments, queries.sales_trends,
    queries.loyalty_impact, queries.location_performance, queries.discount_effectiveness,
    queries.clv_percent_rank, queries.rfm_scores, queries.order_gaps, queries.view_revenue_timeline,
    queries.ingest_order_items,
]


def run(query, spark, sf_dir):
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("plateful-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g")
             .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
             .config("spark.sql.shuffle.partitions", cpus)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    for query in HEADLINE:
        run(query, spark, sf_dir)
    seconds = {q.__name__: round(run(q, spark, sf_dir), 3) for q in HEADLINE}
    spark.stop()
    print(json.dumps({"metric": "metric_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
