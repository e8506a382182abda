"""Calendar parts of the order time."""

from pyspark.sql import DataFrame, functions as F


def with_calendar(df: DataFrame, day: str = "sales_date") -> DataFrame:
    """Add calendar year and month, and ISO week, of a date column."""
    return df.withColumns({
        "sales_year": F.year(day),
        "sales_month": F.month(day),
        "sales_week": F.weekofyear(day),
    })
