"""Metrics brought up to date by the days that arrived: loyalty and locations from merged states, trends by day."""

from datetime import date
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from plateful.operators.distinct import distinct_counts, distinct_state, merged_states
from plateful.operators.facts import priced_lines, revenue_sum
from plateful.plans.sales import average, sales_trends
from plateful.plans.staging import checkpointed
from plateful.sinks.tables import FOLDERS
from plateful.sources.tables import read_metric, read_raw

LOYALTY, LOCATION = "is_loyalty", "restaurant_id"


class GroupState(NamedTuple):
    """``sums`` (group, revenue, priced) and the sets of order and, where they count, of user ids per group."""

    group: str
    sums: DataFrame
    orders: DataFrame
    users: DataFrame | None = None


def group_state(lines: DataFrame, group: str, order_ids: DataFrame, user_ids: DataFrame | None = None) -> GroupState:
    """The state of some days' lines. Ids (:func:`plateful.operators.distinct.extended_ids`) must cover them."""
    sums = lines.groupBy(group).agg(revenue_sum(lines).alias("revenue"), priced_lines(lines).alias("priced"))
    users = None if user_ids is None else distinct_state(lines, [group], "user_id", user_ids)
    return GroupState(group, sums, distinct_state(lines, [group], "order_id", order_ids), users)


def merged(states: list[GroupState]) -> GroupState:
    """The state of all days of ``states``. Sums add up, so each day's lines may be in one of them only."""
    group = states[0].group
    sums = (reduce(DataFrame.unionByName, [s.sums for s in states]).groupBy(group)
            .agg(F.sum("revenue").cast("decimal(31,2)").alias("revenue"), F.sum("priced").alias("priced")))
    users = None if states[0].users is None else merged_states([s.users for s in states], [group])
    return GroupState(group, sums, merged_states([s.orders for s in states], [group]), users)


def loyalty_impact_of(state: GroupState) -> DataFrame:
    """``loyalty_impact`` of everything in ``state``."""
    customers = F.col("unique_customers")
    return _counted(state).select(
        LOYALTY, average(F.col("revenue"), F.col("priced")).cast("decimal(22,2)").alias("avg_order_spend"),
        F.col("orders").alias("total_orders_placed"), "unique_customers",
        F.round(F.try_divide(F.col("revenue").cast("decimal(31,2)"), customers), 2).cast("decimal(32,2)")
        .alias("avg_lifetime_value_spend"))


def location_performance_of(state: GroupState) -> DataFrame:
    """``location_performance`` of everything in ``state``."""
    return _counted(state).select(
        LOCATION, F.round("revenue", 2).alias("total_revenue"), F.col("orders").alias("total_orders"),
        average(F.col("revenue"), F.col("priced")).cast("decimal(22,2)").alias("average_order_value"))


def refresh_trends(spark: SparkSession, raw_base: str, metrics_base: str, days: list[str]) -> None:
    """Bring the stored ``sales_trends`` up to date for ``days`` on which sales arrived, also late ones.

    Every row belongs to one day, so only the items landed for these days are read again, and only the
    month folders they lie in are replaced.
    """
    days = sorted({date.fromisoformat(str(d)) for d in days})
    items = read_raw(spark, raw_base, "order_items_raw", days=[str(d) for d in days])
    months = F.make_date("sales_year", "sales_month", F.lit(1)).isin([d.replace(day=1) for d in days])
    kept = read_metric(spark, metrics_base, "sales_trends").filter(months & ~F.col("sales_date").isin(days))
    rows = checkpointed(kept.unionByName(sales_trends(items)))
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*FOLDERS["sales_trends"])
     .parquet(f"{metrics_base.rstrip('/')}/sales_trends"))


def _counted(state):
    """One row per group; groups without an order or a user count 0. All inputs have one row per group."""
    found = state.sums.withColumnRenamed(state.group, "_group")
    for name, ids in (("orders", state.orders), ("unique_customers", state.users)):
        if ids is not None:
            counts = distinct_counts(ids, [state.group], name)
            found = (found.join(counts, F.col("_group").eqNullSafe(F.col(state.group)), "left").drop(state.group)
                     .na.fill(0, [name]))
    return found.withColumnRenamed("_group", state.group)
