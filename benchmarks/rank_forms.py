"""Percent-rank tiers: the bucketed form against one global window, as customers grow.

Values follow a long-tailed spend with a third of all customers on one value. Prints one
JSON line per size. Usage: python benchmarks/rank_forms.py 100000 1000000
"""

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession, Window, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from plateful import schemas  # noqa: E402
from plateful.plans.customers import with_clv_segment  # noqa: E402
from plateful.plans.staging import checkpointed  # noqa: E402


def spread(spark, n):
    share = F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 1_000_000
    spend = F.when(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3)) == 0, 20).otherwise(50 / (share + 0.001))
    return spark.range(n).select(F.col("id").cast("string").alias("user_id"),
                                 spend.cast("decimal(33,2)").alias("customer_lifetime_value"))


def global_window(values):
    rank = F.percent_rank().over(Window.orderBy(F.col("customer_lifetime_value").desc()))
    (high, high_label), (medium, medium_label) = schemas.CLV_TIERS
    return values.withColumn("rank", rank).select(
        "user_id", "customer_lifetime_value",
        F.when(F.col("rank") <= high, high_label).when(F.col("rank") <= medium, medium_label)
        .otherwise(schemas.CLV_LAST_TIER).alias("clv_segment"))


def seconds(df):
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 2)


def main():
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", cpus).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    for n in map(int, sys.argv[1:] or ["100000", "1000000"]):
        values = checkpointed(spread(spark, n))
        seconds(with_clv_segment(values))
        print(json.dumps({"customers": n, "bucketed": seconds(with_clv_segment(values)),
                          "global_window": seconds(global_window(values))}), flush=True)


if __name__ == "__main__":
    main()
