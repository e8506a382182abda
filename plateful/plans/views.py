"""Dashboard-ready views over the metric tables. An empty table gives an empty view."""

from pyspark.sql import DataFrame, functions as F

from plateful import schemas

OTHER_CATEGORIES = "other categories"


def segment_counts(segments: DataFrame) -> DataFrame:
    return _frequencies(segments, "rfm_segment", "Segment", "Total Customers")


def churn_counts(segments: DataFrame) -> DataFrame:
    return _frequencies(segments, "churn_indicator", "Status", "Volume")


def customer_roster(segments: DataFrame, rows: int = schemas.ROSTER_ROWS) -> DataFrame:
    """Customers who stayed away longest."""
    return segments.orderBy(F.col("recency_days").desc_nulls_last(), F.col("user_id")).limit(rows)


def revenue_timeline(trends: DataFrame, categories: list | None = None) -> DataFrame:
    """One row per date, one column per category, 0 where a category sold nothing.

    Spark looks the categories up first; their number is bounded by ``spark.sql.pivotMaxValues``,
    beyond which it raises. Pass ``categories`` to fix the columns: what falls outside them
    goes to one more column, ``OTHER_CATEGORIES``.
    """
    known = trends.filter(F.col("sales_date").isNotNull() & F.col("item_category").isNotNull())
    if categories is not None:
        listed = F.col("item_category").isin(categories)
        known = known.withColumn("item_category", F.when(listed, F.col("item_category")).otherwise(OTHER_CATEGORIES))
        categories = [*categories, OTHER_CATEGORIES]
    wide = known.groupBy("sales_date").pivot("item_category", categories).agg(F.sum("total_revenue"))
    cells = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(c) for c in wide.columns[1:]]
    return wide.orderBy("sales_date").select(F.col("sales_date").cast("string").alias("sales_date"), *cells)


def revenue_cells(trends: DataFrame) -> DataFrame:
    """Long form of the timeline: one row per date and category, 0 where a category sold nothing.

    The cells of a date are one map, and every date is asked for every category, so the columns are
    fixed and nothing is looked up while the plan is built. The names of all categories meet in one
    task, once each; the sums per date and category are computed once for both uses.
    """
    known = trends.filter(F.col("sales_date").isNotNull() & F.col("item_category").isNotNull())
    cells = known.groupBy("sales_date", "item_category").agg(F.sum("total_revenue").alias("revenue"))
    dates = cells.groupBy("sales_date").agg(
        F.map_from_entries(F.collect_list(F.struct("item_category", "revenue"))).alias("cells"))
    names = dates.select(F.explode(F.map_keys("cells")).alias("name")).agg(F.array_sort(F.collect_set("name"))).scalar()
    return (dates.select("sales_date", "cells", F.explode(names).alias("item_category"))
            .select(F.col("sales_date").cast("string").alias("sales_date"), "item_category",
                    F.coalesce(F.col("cells")[F.col("item_category")].cast("double"), F.lit(0.0)).alias("total_revenue"))
            .orderBy("sales_date", "item_category"))


def hourly_demand(trends: DataFrame) -> DataFrame:
    """Orders per hour of day; an order with two categories counts once for each."""
    return (trends.filter(F.col("sales_hour").isNotNull())
            .groupBy("sales_hour").agg(F.sum("total_orders").alias("total_orders"))
            .orderBy("sales_hour"))


def loyalty_comparison(loyalty: DataFrame) -> DataFrame:
    return _labelled(loyalty, "is_loyalty", schemas.LOYALTY_LABELS)


def location_league(locations: DataFrame) -> DataFrame:
    return locations.orderBy(F.col("total_revenue").desc_nulls_last(), F.col("restaurant_id"))


def discount_comparison(discounts: DataFrame) -> DataFrame:
    return _labelled(discounts, "is_discounted", schemas.DISCOUNT_LABELS)


def _frequencies(table, column, label, amount):
    return (table.filter(F.col(column).isNotNull())
            .groupBy(F.col(column).alias(label)).agg(F.count(F.lit(1)).alias(amount))
            .orderBy(F.col(amount).desc(), F.col(label)))


def _labelled(table, flag, labels):
    if_true, if_false = labels
    return table.withColumn(flag, F.when(F.col(flag), if_true).when(~F.col(flag), if_false))
