"""Sales, loyalty, location and discount metrics, from item lines or ``item_facts``."""

from pyspark.sql import Column, DataFrame, functions as F

from plateful.functions.calendar import with_calendar
from plateful.operators.facts import order_summary, priced_lines, revenue_sum, with_discount_flag


def average(total: Column, count: Column) -> Column:
    """Half-up mean in cents by way of six digits, as the built-in decimal average gives it."""
    return F.round(F.try_divide(total.cast("decimal(38,2)"), count), 2)


def sales_trends(lines: DataFrame) -> DataFrame:
    """Revenue and orders per date, hour and category. Orders do not add up over categories.

    Year, month and week follow from the date, so they are added to the aggregated rows.
    """
    time = F.col("creation_time_utc")
    cells = (lines.groupBy(F.to_date(time).alias("sales_date"), F.hour(time).alias("sales_hour"), "item_category")
             .agg(F.round(revenue_sum(lines), 2).alias("total_revenue"),
                  F.countDistinct("order_id").alias("total_orders")))
    return with_calendar(cells).select(
        "sales_date", "sales_year", "sales_month", "sales_week", "sales_hour", "item_category",
        "total_revenue", "total_orders")


def loyalty_impact(lines: DataFrame) -> DataFrame:
    """Loyalty members against guests. ``avg_order_spend`` is an average over item lines.

    Lines are summed per order and user first, so only those rows are spread for the two
    distinct counts.
    """
    orders = lines.groupBy("is_loyalty", "order_id", "user_id").agg(
        revenue_sum(lines).alias("revenue"), priced_lines(lines).alias("priced"))
    total, customers = F.sum("revenue"), F.countDistinct("user_id")
    return orders.groupBy("is_loyalty").agg(
        average(total, F.sum("priced")).cast("decimal(22,2)").alias("avg_order_spend"),
        F.countDistinct("order_id").alias("total_orders_placed"),
        customers.alias("unique_customers"),
        F.round(F.try_divide(total.cast("decimal(31,2)"), customers), 2).cast("decimal(32,2)")
        .alias("avg_lifetime_value_spend"))


def location_performance(lines: DataFrame) -> DataFrame:
    """Revenue and orders per restaurant. ``average_order_value`` is an average over item lines."""
    return lines.groupBy("restaurant_id").agg(
        F.round(revenue_sum(lines), 2).alias("total_revenue"),
        F.countDistinct("order_id").alias("total_orders"),
        average(revenue_sum(lines), priced_lines(lines)).cast("decimal(22,2)").alias("average_order_value"))


def discount_effectiveness(lines: DataFrame, options: DataFrame, *,
                           orders: DataFrame | None = None) -> DataFrame:
    """Discounted against full-price orders, on item revenue before discounts."""
    if orders is None:
        orders = order_summary(lines)
    # One row per order id before the join, so no order id is hot in it. Sums and counts of
    # these rows give the average over the order summary.
    per_order = orders.groupBy("order_id").agg(
        F.count("order_id").alias("n_orders"),
        F.sum("order_total_revenue").alias("revenue"),
        F.count("order_total_revenue").alias("n_revenues"))
    revenue = F.sum("revenue").cast("decimal(38,2)")
    return with_discount_flag(per_order, options).groupBy("is_discounted").agg(
        F.sum("n_orders").alias("total_orders"),
        F.round(revenue, 2).cast("decimal(38,2)").alias("total_revenue_generated"),
        average(revenue, F.sum("n_revenues")).cast("decimal(32,2)").alias("average_basket_value"))
