"""Days between consecutive orders of a user."""

from pyspark.sql import DataFrame, Window, functions as F

# A missing user is a customer of its own, so users are matched by text and by absence.
USER = ["user_text", "no_user"]


def average_gap(first_time, last_time, n_times):
    """Mean day gap from the ends of the series: consecutive day differences add up to the span."""
    return F.when(n_times > 1, F.datediff(last_time, first_time) / (n_times - 1))


def order_gaps(orders: DataFrame) -> DataFrame:
    """Order summary rows with ``prev_order_time`` and ``days_between_orders``.

    Orders of one user at the same instant follow each other by order id. A user may own a
    large part of all orders, so no window spans all rows of a user: instants are linked
    inside one hour (at most 3600 rows, as raw times are whole seconds; finer times are linked
    rightly too, but then nothing splits an hour with very many of them), and the first instant of an hour is linked to the
    last one of the user's preceding active hour (one row per hour). ``orders`` is read
    several times and is best a written table.
    """
    keyed = orders.withColumns({"user_text": F.coalesce("user_id", F.lit("")),
                                "no_user": F.isnull("user_id"), "instant": F.col("creation_time_utc")})
    instants = (keyed.filter(F.col("instant").isNotNull()).groupBy(*USER, "instant")
                .agg(F.min(F.struct("order_id")).alias("first_order"))
                .withColumn("active_hour", F.struct(F.to_date("instant").alias("day"),
                                                    F.hour("instant").alias("hour"))))
    in_hour = Window.partitionBy(*USER, "active_hour").orderBy("instant")
    by_hour = Window.partitionBy(*USER).orderBy("active_hour")
    hours = (instants.groupBy(*USER, "active_hour").agg(F.max("instant").alias("last_in_hour"))
             .select(*USER, "active_hour", F.lag("last_in_hour").over(by_hour).alias("before_hour")))
    linked = (instants.withColumn("before", F.lag("instant").over(in_hour))
              .join(hours, [*USER, "active_hour"])
              .select(*USER, "instant", "first_order", F.coalesce("before", "before_hour").alias("prev_instant")))

    is_first = F.struct("order_id").eqNullSafe(F.col("first_order"))
    return (keyed.join(linked, [*USER, "instant"], "left")
            .withColumn("prev_order_time", F.when(is_first, F.col("prev_instant")).otherwise(F.col("instant")))
            .select(*orders.columns, "prev_order_time",
                    F.datediff("creation_time_utc", "prev_order_time").alias("days_between_orders")))
