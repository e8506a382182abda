"""Line, order and customer level facts built from the raw tables."""

from pyspark.sql import Column, DataFrame, functions as F

from plateful.functions.money import is_discount_line, item_revenue, option_revenue

ORDER_KEYS = ("user_id", "order_id", "creation_time_utc")
FACT_KEYS = (*ORDER_KEYS, "is_loyalty", "restaurant_id", "item_category")
SPEND_TYPE = "decimal(31,2)"


def item_facts(items: DataFrame) -> DataFrame:
    """Item lines summed to what the metrics but lifetime value need: revenue and priced lines.

    Functions that take ``lines`` accept the items or these facts and give the same rows.
    """
    return items.groupBy(*FACT_KEYS).agg(F.sum(item_revenue()).alias("item_revenue"),
                                         F.count(item_revenue()).alias("priced_lines"))


def revenue_sum(lines: DataFrame) -> Column:
    return F.sum("item_revenue" if "item_revenue" in lines.columns else item_revenue()).cast(SPEND_TYPE)


def priced_lines(lines: DataFrame) -> Column:
    """Lines with a revenue, over which line averages go."""
    return F.sum("priced_lines") if "priced_lines" in lines.columns else F.count(item_revenue())


def with_item_revenue(items: DataFrame) -> DataFrame:
    return items.withColumn("item_line_revenue", item_revenue())


def with_option_revenue(options: DataFrame) -> DataFrame:
    return options.withColumn("option_line_revenue", option_revenue())


def item_user_map(items: DataFrame) -> DataFrame:
    return items.select("lineitem_id", "user_id").distinct()


def options_with_user(items: DataFrame, options: DataFrame) -> DataFrame:
    """Each option line with the user of its item line; options without an item line drop out.

    The items are hashed by line once, which serves both the distinct and the join. A line id
    is a primary key, so no line is hot.
    """
    owners = item_user_map(items.select("lineitem_id", "user_id").repartition("lineitem_id"))
    return with_option_revenue(options).join(owners, "lineitem_id")


def customer_item_spend(items: DataFrame) -> DataFrame:
    return items.groupBy("user_id").agg(F.sum(item_revenue()).alias("total_item_spend"))


def customer_option_spend(items: DataFrame, options: DataFrame, *, unique: bool = False) -> DataFrame:
    """Option spend per user. Options are summed per line before the join, so that those of a repeated line count once.

    Where ``unique`` says that no line repeats in ``items``, they are joined as they are and summed per user alone.
    """
    if unique:
        lines = items.select("lineitem_id", "user_id").join(
            options.select("lineitem_id", option_revenue().alias("option_spend")), "lineitem_id")
    else:
        lines = (items.select("lineitem_id", "user_id").join(_option_spend_per_line(options), "lineitem_id")
                 .groupBy("lineitem_id", "user_id").agg(F.max("option_spend").alias("option_spend")))
    return lines.groupBy("user_id").agg(F.sum("option_spend").cast(SPEND_TYPE).alias("total_option_spend"))


def customer_spend(items: DataFrame, options: DataFrame) -> DataFrame:
    """Item and option spend per user in one pass over the items.

    Items meet the options, summed per line, by line; the sum per line and user that follows
    needs no further shuffle, and counts the options of a repeated line once per user. What is
    shuffled by user is one row per user and task. Option spend without a known user is not
    credited to anyone.
    """
    lines = (items.select("lineitem_id", "user_id", item_revenue().alias("revenue"))
             .join(_option_spend_per_line(options), "lineitem_id", "left")
             .groupBy("lineitem_id", "user_id")
             .agg(F.sum("revenue").alias("item_spend"), F.max("option_spend").alias("option_spend")))
    credited = F.when(F.col("user_id").isNotNull(), F.col("option_spend"))
    return lines.groupBy("user_id").agg(
        F.sum("item_spend").cast(SPEND_TYPE).alias("total_item_spend"),
        F.coalesce(F.sum(credited).cast(SPEND_TYPE), F.lit(0).cast(SPEND_TYPE)).alias("total_option_spend"))


def order_summary(lines: DataFrame) -> DataFrame:
    """One row per user, order and time with its item revenue."""
    return lines.groupBy(*ORDER_KEYS).agg(revenue_sum(lines).alias("order_total_revenue"))


def discount_lines(options: DataFrame) -> DataFrame:
    return options.filter(is_discount_line())


def discounted_orders(options: DataFrame) -> DataFrame:
    return discount_lines(options).select("order_id").distinct()


def with_discount_flag(orders: DataFrame, options: DataFrame) -> DataFrame:
    """Orders with ``is_discounted``: true if any option line of the order is a discount."""
    flagged = discounted_orders(options).withColumn("is_discounted", F.lit(True))
    return orders.join(flagged, "order_id", "left").na.fill(False, ["is_discounted"])


def newest_order_time(items: DataFrame) -> DataFrame:
    return items.agg(F.max("creation_time_utc").alias("baseline"))


def _option_spend_per_line(options):
    return options.groupBy("lineitem_id").agg(F.sum(option_revenue()).alias("option_spend"))
