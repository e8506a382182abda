"""Customer metrics in their plain form, with windows over whole tables, beside ours, in one process.

    python benchmarks/plain_forms.py /root/testdata/sf0.1
"""

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession, Window, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from plateful import queries, schemas  # noqa: E402
from plateful.plans import customers  # noqa: E402
from plateful.plans.staging import checkpointed, lazy  # noqa: E402

REVENUE = "item_price * item_quantity"


def plain_value(items, options):
    owners = items.select("lineitem_id", "user_id").distinct()
    spend = items.groupBy("user_id").agg(F.sum(F.expr(REVENUE)).alias("item_spend"))
    extra = (options.join(owners, "lineitem_id").groupBy("user_id")
             .agg(F.sum(F.col("option_price") * F.col("option_quantity")).alias("option_spend")))
    value = (F.col("item_spend") + F.coalesce("option_spend", F.lit(0))).alias("customer_lifetime_value")
    rank = F.percent_rank().over(Window.orderBy(F.desc_nulls_last("customer_lifetime_value")))
    (high, high_label), (medium, medium_label) = schemas.CLV_TIERS
    return (spend.join(extra, "user_id", "left").select("user_id", value).withColumn("rank", rank)
            .withColumn("clv_segment", F.when(F.col("rank") <= high, high_label)
                        .when(F.col("rank") <= medium, medium_label).otherwise(schemas.CLV_LAST_TIER)))


def plain_segments(items):
    orders = items.groupBy("user_id", "order_id", "creation_time_utc").agg(F.sum(F.expr(REVENUE)).alias("revenue"))
    before = F.lag("creation_time_utc").over(Window.partitionBy("user_id").orderBy("creation_time_utc"))
    per_user = (orders.withColumn("gap", F.datediff("creation_time_utc", before)).groupBy("user_id").agg(
        F.max("creation_time_utc").alias("last"), F.countDistinct("order_id").alias("frequency"),
        F.sum("revenue").alias("money"), F.round(F.avg("gap"), 1).alias("average_gap")))
    newest = items.agg(F.max("creation_time_utc")).scalar()
    ranked = per_user.withColumn("recency", F.datediff(newest, "last"))
    for name, order in (("r", F.col("recency").asc()), ("f", F.col("frequency").desc()), ("m", F.col("money").desc())):
        ranked = ranked.withColumn(name, F.percent_rank().over(Window.orderBy(order)))
    return ranked


def seconds(query):
    start = time.perf_counter()
    query().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 2)


def main():
    sf, cpus = sys.argv[1], os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", cpus).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    def value():
        return queries.items(spark, sf, *queries.SPEND), queries.options(spark, sf)

    def order():
        return queries.items(spark, sf, *queries.ORDER)

    forms = {
        "customer_lifetime_value": (lambda: plain_value(*value()), lambda stage: customers.customer_lifetime_value(*value(), stage=stage)),
        "customer_segments": (lambda: plain_segments(order()), lambda stage: customers.customer_segments(order(), stage=stage)),
    }
    for name, (plain, ours) in forms.items():
        took = {"plain": [], "lazy": [], "checkpointed": []}
        for _ in range(4):
            took["plain"].append(seconds(plain))
            for stage in (lazy, checkpointed):
                took[stage.__name__].append(seconds(lambda: ours(stage)))
        print(json.dumps({"metric": name, **{form: min(t[1:]) for form, t in took.items()}}), flush=True)


if __name__ == "__main__":
    main()
