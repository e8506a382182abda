"""Stated business goals that go beyond the six metric tables."""

from pyspark.sql import DataFrame, Window, functions as F

from plateful.functions.money import is_discount_line, item_revenue, option_revenue
from plateful.operators.facts import SPEND_TYPE, customer_option_spend
from plateful.plans.customers import customer_lifetime_value, values_of, with_clv_segment
from plateful.plans.staging import checkpointed, lazy

UNKNOWN = "unknown"


def clv_as_of(items: DataFrame, options: DataFrame, day: str, *, stage=lazy) -> DataFrame:
    """Lifetime value as it stood at the end of ``day``. The date filter reaches the scan."""
    until = items.filter(F.col("creation_time_utc") < F.date_add(F.lit(day).cast("date"), 1).cast("timestamp_ntz"))
    return (customer_lifetime_value(until, options, stage=stage)
            .withColumn("as_of_date", F.lit(day).cast("date")))


def update_spend(previous: DataFrame, new_items: DataFrame, new_options: DataFrame, owners: DataFrame, *,
                 unique_owners: bool = False) -> DataFrame:
    """``customer_spend`` after a day, from that of the day before and only what arrived since.

    Options are credited to the owner of their line in ``owners`` (lineitem_id, user_id of all
    landed lines), also when the line is older. Options whose line has not landed are not
    credited; ``unowned_options`` gives them, to be passed again the next day. Only one row
    per user and source is shuffled. ``unique_owners`` says that ``owners`` has each line once.
    """
    none = F.lit(None).cast(SPEND_TYPE)
    bought = (new_items.groupBy("user_id").agg(F.sum(item_revenue()).cast(SPEND_TYPE).alias("total_item_spend"))
              .withColumn("total_option_spend", none))
    added = (customer_option_spend(owners, new_options, unique=unique_owners).filter(F.col("user_id").isNotNull())
             .select("user_id", none.alias("total_item_spend"), "total_option_spend"))
    return (previous.unionByName(bought).unionByName(added).groupBy("user_id")
            .agg(F.sum("total_item_spend").cast(SPEND_TYPE).alias("total_item_spend"),
                 F.coalesce(F.sum("total_option_spend").cast(SPEND_TYPE), F.lit(0).cast(SPEND_TYPE))
                 .alias("total_option_spend")))


def unowned_options(options: DataFrame, owners: DataFrame) -> DataFrame:
    """Options whose line has not landed yet."""
    return options.join(owners.select("lineitem_id"), "lineitem_id", "left_anti").select(*options.columns)


def clv_of_spend(spend: DataFrame, day: str) -> DataFrame:
    """The daily table of lifetime values from the spend kept by ``update_spend``."""
    return with_clv_segment(values_of(spend)).withColumn("as_of_date", F.lit(day).cast("date"))


def seasonal_sales(items: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Daily revenue by weekend, holiday, month and weekday. Days without a sale do not count.

    Sales of a day that the date dimension lacks, and sales without a time (as one more day),
    are under the season "unknown", so each kind adds up to all revenue.
    """
    daily = (items.groupBy(F.to_date("creation_time_utc").alias("date_key"))
             .agg(F.sum(item_revenue()).alias("revenue")))
    parts = {"weekend": "is_weekend", "holiday": "is_holiday", "month": "month", "weekday": "day_of_week"}
    seasons = F.array(*[F.struct(F.lit(kind).alias("season_kind"),
                                 F.coalesce(F.col(column).cast("string"), F.lit(UNKNOWN)).alias("season_value"))
                        for kind, column in parts.items()])
    return (daily.join(date_dim, "date_key", "left").select("revenue", F.inline(seasons))
            .groupBy("season_kind", "season_value")
            .agg(F.count(F.lit(1)).alias("sales_days"),
                 F.sum("revenue").alias("total_revenue"),
                 F.round(F.avg("revenue"), 2).alias("avg_daily_revenue")))


def location_extremes(locations: DataFrame, rows: int = 10) -> DataFrame:
    """The best and the worst locations by revenue, ``rows`` of each."""
    def ranked(label, *order):
        return locations.orderBy(*order).limit(rows).withColumn("placing", F.lit(label))

    revenue, key = F.col("total_revenue"), F.col("restaurant_id")
    return (ranked("best", revenue.desc_nulls_last(), key)
            .unionByName(ranked("worst", revenue.asc_nulls_last(), key)))


def discount_net_revenue(items: DataFrame, options: DataFrame) -> DataFrame:
    """Gross, add-on, discount and net revenue of discounted and full-price orders.

    Profit needs cost data, which the tables do not have. Options whose order has no items
    belong to no order and are left out.
    """
    amount = option_revenue()
    per_order = options.groupBy("order_id").agg(
        F.sum(F.when(~is_discount_line(), amount)).alias("addons"),
        F.sum(F.when(is_discount_line(), amount)).alias("discounts"),
        F.max(is_discount_line()).alias("is_discounted"))
    orders = items.groupBy("order_id").agg(F.sum(item_revenue()).alias("gross"))
    zero = F.lit(0).cast("decimal(31,2)")
    return (orders.join(per_order, "order_id", "left").na.fill(False, ["is_discounted"])
            .groupBy("is_discounted").agg(
                F.count(F.lit(1)).alias("total_orders"),
                F.coalesce(F.sum("gross"), zero).alias("gross_revenue"),
                F.coalesce(F.sum("addons"), zero).alias("addon_revenue"),
                F.coalesce(F.sum("discounts"), zero).alias("discount_amount"))
            .withColumn("net_revenue", F.col("gross_revenue") + F.col("addon_revenue") + F.col("discount_amount")))


def period_change(items: DataFrame) -> DataFrame:
    """Revenue per week and month with the change from the period before that had sales.

    Sales without a time are one more row of each kind, without a start and a change, so each
    kind adds up to all revenue. One row per calendar period remains when the window runs.
    """
    t = F.col("creation_time_utc")
    day = F.to_date(t)
    daily = items.groupBy(day.alias("day")).agg(F.sum(item_revenue()).alias("revenue"))
    starts = F.array(*[F.struct(F.lit(kind).alias("period_kind"),
                                F.trunc("day", kind).alias("period_start")) for kind in ("week", "month")])
    timed = F.col("period_start").isNotNull()
    previous = F.lag("total_revenue").over(Window.partitionBy("period_kind", timed).orderBy("period_start"))
    return (daily.select("revenue", F.inline(starts).alias("period_kind", "period_start"))
            .groupBy("period_kind", "period_start").agg(F.sum("revenue").alias("total_revenue"))
            .withColumn("previous_revenue", previous)
            .withColumn("revenue_change", F.col("total_revenue") - F.col("previous_revenue")))


# Shares of the discounted lines, as whole fractions, whose depth is reported.
DEPTHS = {"median_depth": (1, 2), "depth_90": (9, 10)}


def discount_depth(items: DataFrame, options: DataFrame) -> DataFrame:
    """Per restaurant: how many lines were discounted, and by how many percent of their revenue.

    A quantile is the smallest depth that its share of the lines does not exceed, exact to 0.01 percent. It
    follows from the number of lines per depth, so a restaurant with a third of all lines is
    some thousand rows by then. Lines without a positive revenue are counted, but have no depth.
    """
    discounts = (options.filter(is_discount_line()).groupBy("lineitem_id")
                 .agg((-F.sum(option_revenue())).alias("discount")))
    lines = (items.select("lineitem_id", "restaurant_id", item_revenue().alias("revenue")).join(discounts, "lineitem_id")
             .selectExpr("restaurant_id", "CAST(discount * 100 AS decimal(30,0)) AS d", "CAST(revenue * 100 AS decimal(30,0)) AS r"))
    # Whole numbers all through: percent times 100, halves up.
    depth = F.when(F.col("r") > 0, F.expr("(20000 * d + r) div (2 * r)"))
    counts = lines.groupBy("restaurant_id", depth.alias("depth")).agg(F.count(F.lit(1)).alias("n"))
    known = F.when(F.col("depth").isNotNull(), F.col("n")).otherwise(0)
    restaurant = Window.partitionBy("restaurant_id")
    counts = (counts.withColumn("upto", F.sum(known).over(restaurant.orderBy(F.col("depth").asc_nulls_first())))
              .withColumn("of", F.sum(known).over(restaurant)))
    return counts.groupBy("restaurant_id").agg(F.sum("n").alias("discounted_lines"), *[
        (F.min(F.when(F.col("upto") * below >= F.col("of") * part, F.col("depth"))) / 100).cast("decimal(20,2)").alias(name)
        for name, (part, below) in DEPTHS.items()])


def daily_calendar(items: DataFrame) -> DataFrame:
    """day and revenue of every day from the first to the last with a sale; 0 on days without one."""
    daily = items.groupBy(F.to_date("creation_time_utc").alias("day")).agg(F.sum(item_revenue()).alias("revenue"))
    daily = daily.filter(F.col("day").isNotNull())
    return _every("day", daily, F.expr("INTERVAL 1 DAY"))


def period_calendar(items: DataFrame) -> DataFrame:
    """``period_change`` over all weeks and months between the first and the last sale.

    A period without sales counts as 0 and is the one before the next, so a change is always that from
    the calendar period before. Sales without a time have no place in a calendar and are left out.
    """
    found = None
    for kind, step in (("week", "INTERVAL 7 DAYS"), ("month", "INTERVAL 1 MONTH")):
        each = (items.groupBy(F.to_date(F.date_trunc(kind, "creation_time_utc")).alias("period_start"))
                .agg(F.sum(item_revenue()).alias("revenue")).filter(F.col("period_start").isNotNull()))
        each = _every("period_start", each, F.expr(step)).withColumn("period_kind", F.lit(kind))
        found = each if found is None else found.unionByName(each)
    previous = F.lag("revenue").over(Window.partitionBy("period_kind").orderBy("period_start"))
    return found.select("period_kind", "period_start", F.col("revenue").alias("total_revenue"), previous.alias("previous_revenue"),
                        (F.col("revenue") - previous).alias("revenue_change"))


def seasonal_index(items: DataFrame, *, stage=checkpointed) -> DataFrame:
    """How much more or less sells on a weekday or in a month than around it.

    The revenue of the season's days over their share of the seven days around each; for months over that of
    the twelve months around (half of the two ends). 1 is as much as usual. Only days and months whose
    surroundings lie in the calendar count, days without sales as 0. The revenue per day serves both, so it is
    written once.
    """
    days = stage(daily_calendar(items))
    months = days.groupBy(F.to_date(F.date_trunc("month", "day")).alias("day")).agg(F.sum("revenue").alias("revenue"))
    periods = days.withColumn("season_kind", F.lit("weekday")).unionByName(months.withColumn("season_kind", F.lit("month")))
    by_day, weekday = Window.partitionBy("season_kind").orderBy("day"), F.col("season_kind") == "weekday"

    def over(value, first, last):
        return value.over(by_day.rowsBetween(first, last))

    revenue, rows = F.sum("revenue"), F.count(F.lit(1))
    periods = periods.select(
        "season_kind", "revenue",
        F.when(weekday, F.date_format("day", "EEEE")).otherwise(F.month("day").cast("string")).alias("season_value"),
        F.when(weekday, over(revenue, -3, 3)).otherwise(over(revenue, -6, 5) + over(revenue, -5, 6)).alias("around"),
        F.when(weekday, over(rows, -3, 3) == 7).otherwise(over(rows, -6, 6) == 13).alias("whole"),
        F.when(weekday, 7).otherwise(24).alias("periods"))
    sums = (periods.filter("whole").groupBy("season_kind", "season_value", "periods")
            .agg(F.count(F.lit(1)).alias("n_periods"), F.sum("revenue").alias("revenue"), F.sum("around").alias("around")))
    index = F.try_divide((F.col("revenue") * F.col("periods")).cast("double"), F.col("around").cast("double"))
    return sums.select("season_kind", "season_value", "n_periods", F.col("revenue").alias("total_revenue"), index.alias("season_index"))


def _every(column, each, step):
    """``each`` (date and revenue) with a row of revenue 0 for every date that is missing between its first and last."""
    span = each.agg(F.min(column).alias("first"), F.max(column).alias("last")).filter(F.col("first").isNotNull())
    dates = span.select(F.explode(F.sequence("first", "last", step)).alias(column))
    return dates.join(each, column, "left").select(column, F.coalesce("revenue", F.lit(0).cast("decimal(31,2)")).alias("revenue"))
