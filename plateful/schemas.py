"""Table schemas and the fixed values every module shares."""

from pyspark.sql import types as T

PRICE = T.DecimalType(10, 2)

# Names, order and types of the raw tables.

DATE_DIM = T.StructType([
    T.StructField("date_key", T.DateType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("week", T.IntegerType()),
    T.StructField("day_of_week", T.StringType()),
    T.StructField("is_weekend", T.BooleanType()),
    T.StructField("is_holiday", T.BooleanType()),
    T.StructField("holiday_name", T.StringType()),
])

# Times carry no zone, so hours and dates never move with the session zone.
ORDER_ITEMS = T.StructType([
    T.StructField("app_name", T.StringType()),
    T.StructField("restaurant_id", T.StringType()),
    T.StructField("creation_time_utc", T.TimestampNTZType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("printed_card_number", T.StringType()),
    T.StructField("is_loyalty", T.BooleanType()),
    T.StructField("currency", T.StringType()),
    T.StructField("lineitem_id", T.StringType()),
    T.StructField("item_category", T.StringType()),
    T.StructField("item_name", T.StringType()),
    T.StructField("item_price", PRICE),
    T.StructField("item_quantity", T.IntegerType()),
])

ORDER_ITEM_OPTIONS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("lineitem_id", T.StringType()),
    T.StructField("option_group_name", T.StringType()),
    T.StructField("option_name", T.StringType()),
    T.StructField("option_price", PRICE),
    T.StructField("option_quantity", T.IntegerType()),
    T.StructField("id", T.LongType()),
])

RAW_TABLES = {
    "date_dim_raw": DATE_DIM,
    "order_items_raw": ORDER_ITEMS,
    "order_item_options_raw": ORDER_ITEM_OPTIONS,
}

# Raw tables landed in one folder per day: the folder column and the time it is the day of.
DAY_FOLDERS = {"order_items_raw": ("creation_day", "creation_time_utc")}

# Names, order and types of the metric tables.
METRICS = {
    "customer_lifetime_value":
        "user_id string, customer_lifetime_value decimal(33,2), clv_segment string",
    "customer_segments":
        "user_id string, recency_days int, frequency_total bigint, monetary_total decimal(38,2),"
        " avg_days_between_orders double, rfm_segment string, churn_indicator string",
    "sales_trends":
        "sales_date date, sales_year int, sales_month int, sales_week int, sales_hour int,"
        " item_category string, total_revenue decimal(32,2), total_orders bigint",
    "loyalty_impact":
        "is_loyalty boolean, avg_order_spend decimal(22,2), total_orders_placed bigint,"
        " unique_customers bigint, avg_lifetime_value_spend decimal(32,2)",
    "location_performance":
        "restaurant_id string, total_revenue decimal(32,2), total_orders bigint,"
        " average_order_value decimal(22,2)",
    "discount_effectiveness":
        "is_discounted boolean, total_orders bigint, total_revenue_generated decimal(38,2),"
        " average_basket_value decimal(32,2)",
}

# Texts that count as true, source date and time formats.
TRUE_WORDS = ("true", "1", "yes")
DATE_FORMAT = "d-M-yyyy"
TIME_TEXT = r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}$"
TIME_LENGTH = 19

# Rank limits with their tier or score, first match wins.
CLV_TIERS = ((0.2, "High CLV"), (0.8, "Medium CLV"))
CLV_LAST_TIER = "Low CLV"
RFM_SCORES = ((0.2, 5), (0.4, 4), (0.6, 3), (0.8, 2))
RFM_LAST_SCORE = 1

# Segment and churn labels.
VIP = "VIP"
NEW_CUSTOMER = "New Customer"
CHURN_RISK = "Churn Risk"
REGULAR_CUSTOMER = "Regular Customer"
CHURN_AFTER_DAYS = 45
AT_RISK = "At Risk"
ACTIVE = "Active"

# Labels shown on the dashboard views.
LOYALTY_LABELS = ("Loyalty Member", "Standard Guest")
DISCOUNT_LABELS = ("Promo Applied", "Full Price Purchase")
ROSTER_ROWS = 100
PREVIEW_ROWS = 5
