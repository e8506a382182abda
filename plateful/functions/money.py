"""Revenue expressions. All money is decimal, so sums do not depend on row order."""

from pyspark.sql import Column, functions as F


def item_revenue() -> Column:
    return F.col("item_price") * F.col("item_quantity")


def option_revenue() -> Column:
    """Revenue of an option line; negative for discounts."""
    return F.col("option_price") * F.col("option_quantity")


def is_discount_line() -> Column:
    return F.col("option_price") < 0
