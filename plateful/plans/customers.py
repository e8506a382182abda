"""Customer metrics: lifetime value with tiers, and recency-frequency-monetary segments."""

from pyspark.sql import Column, DataFrame, functions as F

from plateful import schemas
from plateful.operators.facts import customer_spend, order_summary
from plateful.operators.gaps import average_gap
from plateful.operators.ranking import Tier, with_tiers
from plateful.plans.staging import checkpointed, lazy


def drop_anonymous(table: DataFrame) -> DataFrame:
    """Leave out rows with a blank or missing user; by default they count as customers."""
    return table.filter(F.col("user_id") != "")


def customer_values(items: DataFrame, options: DataFrame) -> DataFrame:
    """Lifetime value per user: item spend plus option spend, so discounts reduce it."""
    return values_of(customer_spend(items, options))


def values_of(spend: DataFrame) -> DataFrame:
    """Lifetime value per user from item and option spend per user."""
    value = F.round(F.col("total_item_spend") + F.col("total_option_spend"), 2)
    return (spend.select("user_id", value.cast("decimal(33,2)").alias("customer_lifetime_value")))


def with_clv_segment(values: DataFrame) -> DataFrame:
    return with_tiers(values, {"clv_segment": Tier(
        "customer_lifetime_value", True, schemas.CLV_TIERS, schemas.CLV_LAST_TIER)})


def customer_lifetime_value(items: DataFrame, options: DataFrame, *, exclude_anonymous=False,
                            stage=lazy) -> DataFrame:
    if exclude_anonymous:
        items = drop_anonymous(items)
    return with_clv_segment(stage(customer_values(items, options)))


def customer_activity(orders: DataFrame) -> DataFrame:
    """Per user from the order summary: last order time, orders, revenue, average day gap."""
    time = F.col("creation_time_utc")
    gap = average_gap(F.min(time), F.max(time), F.count(time))
    return orders.groupBy("user_id").agg(
        F.max(time).alias("last_order_time"),
        F.countDistinct("order_id").alias("frequency_total"),
        F.sum("order_total_revenue").alias("monetary_total"),
        F.coalesce(F.round(gap, 1), F.lit(0.0)).alias("avg_days_between_orders"))


def with_recency(activity: DataFrame, as_of: Column | None = None) -> DataFrame:
    """``recency_days`` up to ``as_of``, by default the newest order time in the data."""
    if as_of is None:
        as_of = activity.agg(F.max("last_order_time")).scalar()
    return activity.withColumn("recency_days", F.datediff(as_of, "last_order_time"))


def with_rfm_scores(rfm: DataFrame) -> DataFrame:
    """Scores 5 (best fifth) to 1. A missing recency ranks first, missing money last."""
    steps, last = schemas.RFM_SCORES, schemas.RFM_LAST_SCORE
    return with_tiers(rfm, {
        "r_score": Tier("recency_days", False, steps, last),
        "f_score": Tier("frequency_total", True, steps, last),
        "m_score": Tier("monetary_total", True, steps, last)})


def rfm_segment() -> Column:
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return (F.when((r >= 4) & (f >= 4) & (m >= 4), schemas.VIP)
            .when((r >= 4) & (f <= 2), schemas.NEW_CUSTOMER)
            .when((r <= 2) & (f <= 2), schemas.CHURN_RISK)
            .otherwise(schemas.REGULAR_CUSTOMER))


def churn_indicator() -> Column:
    late = F.col("recency_days") > schemas.CHURN_AFTER_DAYS
    return F.when(late, schemas.AT_RISK).otherwise(schemas.ACTIVE)


def rfm_scores(items: DataFrame, *, orders: DataFrame | None = None, as_of: Column | None = None,
               exclude_anonymous=False, stage=checkpointed) -> DataFrame:
    """Scored customers. ``orders`` is an order summary that already exists, if there is one.

    The rows per user serve three times, with different columns, so they are written once;
    ``stage=lazy`` computes them for each use instead and writes nothing.
    """
    if orders is None:
        orders = order_summary(items)
    if exclude_anonymous:
        orders = drop_anonymous(orders)
    activity = stage(customer_activity(orders))
    return with_rfm_scores(with_recency(activity, as_of))


def customer_segments(items: DataFrame, **how) -> DataFrame:
    """RFM segment and churn indicator per user; takes the options of :func:`rfm_scores`."""
    return rfm_scores(items, **how).select(
        "user_id", "recency_days", "frequency_total",
        F.round("monetary_total", 2).cast("decimal(38,2)").alias("monetary_total"),
        "avg_days_between_orders",
        rfm_segment().alias("rfm_segment"), churn_indicator().alias("churn_indicator"))
