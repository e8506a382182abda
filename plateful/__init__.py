"""Customer, sales and promotion analytics for restaurant orders, on Spark DataFrames."""
