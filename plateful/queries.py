"""Every operator and metric as a query over the test tables."""

from uuid import uuid4

from pyspark.sql import DataFrame, functions as F, types as T

from plateful import schemas
from plateful.functions import cleansing
from plateful.operators import audit, distinct, facts, gaps, keys, rank_store, ranking
from plateful.plans import customers, extensions, increments, sales, views
from plateful.plans.staging import checkpointed, remove_folder, shared_folder, written
from plateful.sources import testdata, text
from plateful.streaming import spend
from plateful.streaming.keytable import KeyTable

SPEND = ("user_id", "lineitem_id", "item_price", "item_quantity")
ORDER = ("user_id", "order_id", "creation_time_utc", "item_price", "item_quantity")
TREND = ("creation_time_utc", "order_id", "item_category", "item_price", "item_quantity")
LOYALTY = ("is_loyalty", "order_id", "user_id", "item_price", "item_quantity")
LOCATION = ("restaurant_id", "order_id", "item_price", "item_quantity")

items = testdata.order_items
options = testdata.order_item_options


def comparable(df: DataFrame) -> DataFrame:
    """Result columns in types that every SQL engine shares: bigint, double, text, boolean."""
    shared = {T.DecimalType: "double", T.IntegerType: "bigint", T.DateType: "string",
              T.TimestampNTZType: "string"}
    return df.select(*[
        F.col(f"`{f.name}`").cast(shared[type(f.dataType)]).alias(f.name)
        if type(f.dataType) in shared else F.col(f"`{f.name}`") for f in df.schema.fields])


# Sources and cleansing

def scan_order_items(spark, sf):
    return items(spark, sf)


def scan_order_item_options(spark, sf):
    return options(spark, sf)


def ingest_date_dim(spark, sf):
    clean = text.clean_date_dim(testdata.date_dim_text(spark, sf))
    return keys.first_by_key(clean, "date_key", ["position"]).drop("position")


def ingest_order_items(spark, sf):
    clean = text.clean_order_items(testdata.order_items_text(spark, sf))
    return (keys.first_by_key(clean, "lineitem_id", testdata.LINE_ORDER)
            .select(*text.schemas.ORDER_ITEMS.names))


def ingest_order_item_options(spark, sf):
    return text.clean_order_item_options(testdata.order_item_options_text(spark, sf))


def dedup_date_dim(spark, sf):
    return keys.first_by_key(testdata.date_dim_text(spark, sf), "date_key", ["position"])


def dedup_order_items(spark, sf):
    lines = testdata.order_items_text(spark, sf, ("l_orderkey", "l_linenumber"))
    return (keys.first_by_key(lines, "lineitem_id", testdata.LINE_ORDER)
            .select("lineitem_id", "restaurant_id", "item_name", "item_price", "item_quantity"))


def load_audit(spark, sf):
    return audit.load_audit(testdata.date_dim_text(spark, sf), testdata.order_items_text(spark, sf),
                            testdata.order_item_options_text(spark, sf))


def preview(spark, sf):
    return audit.preview(items(spark, sf), order_by=["lineitem_id"])


def option_surrogate_id(spark, sf):
    ids = keys.with_dense_id(options(spark, sf))
    return ids.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("id").alias("n_ids"), F.count("id").alias("n_not_null"),
                   F.min("id").alias("first_id"), F.max("id").alias("last_id"))


def parse_boolean(spark, sf):
    flags = testdata.order_items_text(spark, sf).select("lineitem_id", "is_loyalty")
    return flags.withColumn("parsed", cleansing.parse_boolean(F.col("is_loyalty")))


def parse_date(spark, sf):
    days = testdata.date_dim_text(spark, sf).select("position", "date_key")
    return days.withColumn("parsed", cleansing.parse_date(F.col("date_key")))


def parse_timestamp(spark, sf):
    times = testdata.order_items_text(spark, sf).select("lineitem_id", "creation_time_utc")
    return times.withColumn("parsed", cleansing.parse_timestamp(F.col("creation_time_utc")))


def blank_to_null(spark, sf):
    days = testdata.date_dim_text(spark, sf)
    return days.select("position", cleansing.blank_to_null(F.col("week")).alias("week"),
                       cleansing.blank_to_null(F.col("holiday_name"), trim=True).alias("holiday_name"))


# Lines, joins and aggregations

def item_line_revenue(spark, sf):
    return (facts.with_item_revenue(items(spark, sf, "lineitem_id", "item_price", "item_quantity"))
            .select("lineitem_id", "item_line_revenue"))


def option_line_revenue(spark, sf):
    return facts.with_option_revenue(options(spark, sf)).select(
        "lineitem_id", "option_group_name", "option_line_revenue")


def discount_lines(spark, sf):
    return facts.discount_lines(options(spark, sf))


def item_user_map(spark, sf):
    return facts.item_user_map(items(spark, sf, "lineitem_id", "user_id"))


def options_with_user(spark, sf):
    return facts.options_with_user(items(spark, sf, "lineitem_id", "user_id"), options(spark, sf))


def customer_item_spend(spark, sf):
    return facts.customer_item_spend(items(spark, sf, "user_id", "item_price", "item_quantity"))


def customer_option_spend(spark, sf):
    return facts.customer_option_spend(items(spark, sf, "lineitem_id", "user_id"), options(spark, sf))


def customer_spend(spark, sf):
    return facts.customer_spend(items(spark, sf, *SPEND), options(spark, sf))


def order_summary(spark, sf):
    return facts.order_summary(items(spark, sf, *ORDER))


def discounted_orders(spark, sf):
    return facts.discounted_orders(options(spark, sf))


def order_discount_flag(spark, sf):
    return facts.with_discount_flag(order_summary(spark, sf), options(spark, sf))


def recency_baseline(spark, sf):
    return facts.newest_order_time(items(spark, sf, "creation_time_utc"))


def order_gaps(spark, sf):
    return gaps.order_gaps(order_summary(spark, sf))


def customer_rfm(spark, sf):
    return customers.with_recency(customers.customer_activity(order_summary(spark, sf)))


def clv_percent_rank(spark, sf):
    values = checkpointed(customers.customer_values(items(spark, sf, *SPEND), options(spark, sf)))
    return ranking.with_percent_rank(values, "customer_lifetime_value", descending=True)


def rfm_scores(spark, sf):
    return customers.rfm_scores(items(spark, sf, *ORDER))


# Metrics

def customer_lifetime_value(spark, sf):
    return customers.customer_lifetime_value(items(spark, sf, *SPEND), options(spark, sf))


def customer_segments(spark, sf):
    return customers.customer_segments(items(spark, sf, *ORDER))


def sales_trends(spark, sf):
    return sales.sales_trends(items(spark, sf, *TREND))


def loyalty_impact(spark, sf):
    return sales.loyalty_impact(items(spark, sf, *LOYALTY))


def location_performance(spark, sf):
    return sales.location_performance(items(spark, sf, *LOCATION))


def discount_effectiveness(spark, sf):
    return sales.discount_effectiveness(items(spark, sf, *ORDER), options(spark, sf))


# Dashboard views

def view_segment_counts(spark, sf):
    return views.segment_counts(customer_segments(spark, sf))


def view_churn_counts(spark, sf):
    return views.churn_counts(customer_segments(spark, sf))


def view_customer_roster(spark, sf):
    return views.customer_roster(customer_segments(spark, sf))


def view_revenue_timeline(spark, sf):
    return views.revenue_cells(sales_trends(spark, sf))


def view_hourly_demand(spark, sf):
    return views.hourly_demand(sales_trends(spark, sf))


def view_loyalty(spark, sf):
    return views.loyalty_comparison(loyalty_impact(spark, sf))


def view_location_league(spark, sf):
    return views.location_league(location_performance(spark, sf))


def view_discount(spark, sf):
    return views.discount_comparison(discount_effectiveness(spark, sf))


# Stated goals beyond the six metrics

def clv_as_of(spark, sf):
    return extensions.clv_as_of(items(spark, sf, *SPEND, "creation_time_utc"), options(spark, sf),
                                "1998-06-30")


def clv_daily_merge(spark, sf):
    """The same day as ``clv_as_of``, from the spend kept the day before and what arrived since.

    Discounts on older lines arrive late, with the day's own lines and their options.
    """
    lines = items(spark, sf, *SPEND, "creation_time_utc")
    until = lines.filter(F.col("creation_time_utc") < F.lit("1998-07-01").cast("timestamp_ntz"))
    start = F.lit("1998-06-30").cast("timestamp_ntz")
    old, new = until.filter(F.col("creation_time_utc") < start), until.filter(F.col("creation_time_utc") >= start)
    own = options(spark, sf)
    late = F.col("option_group_name") == "promo"
    before = facts.customer_spend(old, own.filter(~late))
    arrived = (own.filter(late).join(old.select("lineitem_id"), "lineitem_id", "left_semi")
               .unionByName(own.join(new.select("lineitem_id"), "lineitem_id", "left_semi")))
    spend = extensions.update_spend(before, new, arrived, until.select("lineitem_id", "user_id"))
    return extensions.clv_of_spend(spend, "1998-06-30")


def clv_merged_batches(spark, sf):
    """The same day as ``clv_as_of``, merged from text in three batches with options before and after their lines."""
    lines = items(spark, sf, *SPEND, "creation_time_utc").filter("creation_time_utc < timestamp_ntz'1998-07-01'")
    batch = F.when(F.col("creation_time_utc") < F.lit("1995-01-01").cast("timestamp_ntz"), 0).when(
        F.col("creation_time_utc") < F.lit("1998-01-01").cast("timestamp_ntz"), 1).otherwise(2)
    lines = checkpointed(as_text(lines.withColumn("_batch", batch), schemas.ORDER_ITEMS))
    # Promotions come first or two batches after most lines, add-ons in the middle one.
    when = F.when(F.col("option_group_name") == "addon", 1).when(F.col("lineitem_id").endswith("1"), 0).otherwise(2)
    extras = checkpointed(as_text(options(spark, sf).withColumn("_batch", when), schemas.ORDER_ITEM_OPTIONS))
    base = f"{shared_folder(spark)}/spend-{uuid4().hex}"
    owners = KeyTable("plateful_keys", f"owners_{uuid4().hex}", f"{base}/owners", "lineitem_id", "lineitem_id string, user_id string", 8)
    owners.create(spark)
    for n in range(3):
        spend.merge_batch(lines.filter(F.col("_batch") == n), extras.filter(F.col("_batch") == n), base, owners, n)
    merged = checkpointed(spend.read_spend(spark, base))
    spark.sql(f"DROP TABLE {owners.table}")
    remove_folder(spark, base)
    return extensions.clv_of_spend(merged, "1998-06-30")


def as_text(rows, schema):
    """Typed rows as a delimited file would hold them: all columns of the raw table, as text, and their place.

    Of lines that repeat the one with the smallest quantity is the first.
    """
    def field(f):
        value = F.col(f.name) if f.name in rows.columns else F.lit(None)
        text_ = value.cast("string")
        return F.replace(text_, F.lit(" "), F.lit("T")) if isinstance(f.dataType, T.TimestampNTZType) else text_

    first = F.lpad(F.col("item_quantity").cast("string"), 10, "0") if "item_quantity" in rows.columns else F.lit("file")
    return rows.select("_batch", first.alias("_file"), F.lit(0).cast("long").alias("_block"),
                       *[field(f).alias(f.name) for f in schema.fields if f.name != "id"])


def clv_percent_rank_merged(spark, sf):
    """The ranks of ``clv_percent_rank`` after a change of the stored ranks of an earlier day."""
    lines, extras = items(spark, sf, *SPEND, "creation_time_utc"), options(spark, sf)
    earlier = lines.filter("creation_time_utc < timestamp_ntz'1997-01-01'")
    before, after = (checkpointed(customers.customer_values(x, extras)) for x in (earlier, lines))
    value = "customer_lifetime_value"
    store = rank_store.RankStore(f"{shared_folder(spark)}/ranks-{uuid4().hex}", after.schema[value].dataType.scale, True)
    nobody = before.limit(0)
    rank_store.apply_changes(spark, store, rank_store.changes(nobody, before, "user_id", value), 0)
    rank_store.apply_changes(spark, store, rank_store.changes(before, after, "user_id", value), 1)
    ranks = checkpointed(rank_store.value_ranks(spark, store, 1))
    remove_folder(spark, store.base)
    same = F.col(value).eqNullSafe(F.col("value").cast(after.schema[value].dataType))
    return after.join(ranks, same).select("user_id", value, "percent_rank")


def _halves(spark, sf, base, *columns):
    """The lines of two spans of days, joined once and written to ``base``."""
    lines, cut = items(spark, sf, "creation_time_utc", *columns), F.lit("1995-01-01").cast("timestamp_ntz")
    half = F.when(F.col("creation_time_utc") < cut, 0).when(F.col("creation_time_utc") >= cut, 1)
    lines = written(lines.select(*columns, half.alias("_half")).filter("_half IS NOT NULL"), base, "_half")
    return [lines.filter(F.col("_half") == n).drop("_half") for n in range(2)]


def _merged_state(halves, group, users=False):
    ids = {"order_id": None, **({"user_id": None} if users else {})}
    states = []
    for lines in halves:
        ids = {key: checkpointed(distinct.extended_ids(lines, key, known, [group])) for key, known in ids.items()}
        states.append(increments.group_state(lines, group, ids["order_id"], ids.get("user_id")))
    return increments.merged(states)


def loyalty_impact_merged(spark, sf):
    """``loyalty_impact`` from the states of two spans of days, whose orders and customers overlap."""
    base = f"{shared_folder(spark)}/lines-{uuid4().hex}"
    state = _merged_state(_halves(spark, sf, base, *LOYALTY), "is_loyalty", users=True)
    impact = checkpointed(increments.loyalty_impact_of(state))
    remove_folder(spark, base)
    return impact


def location_performance_merged(spark, sf):
    base = f"{shared_folder(spark)}/lines-{uuid4().hex}"
    state = _merged_state(_halves(spark, sf, base, *LOCATION), "restaurant_id")
    performance = checkpointed(increments.location_performance_of(state))
    remove_folder(spark, base)
    return performance


def seasonal_sales(spark, sf):
    return extensions.seasonal_sales(
        items(spark, sf, "creation_time_utc", "item_price", "item_quantity"), testdata.date_dim(spark, sf))


def location_extremes(spark, sf):
    return extensions.location_extremes(location_performance(spark, sf))


def discount_net_revenue(spark, sf):
    return extensions.discount_net_revenue(items(spark, sf, *ORDER), options(spark, sf))


def discount_depth(spark, sf):
    return extensions.discount_depth(items(spark, sf, "lineitem_id", "restaurant_id", "item_price", "item_quantity"), options(spark, sf))


def period_calendar(spark, sf):
    return extensions.period_calendar(items(spark, sf, "creation_time_utc", "item_price", "item_quantity"))


def seasonal_index(spark, sf):
    return extensions.seasonal_index(items(spark, sf, "creation_time_utc", "item_price", "item_quantity"))


def period_change(spark, sf):
    return extensions.period_change(
        items(spark, sf, "creation_time_utc", "item_price", "item_quantity"))


QUERIES = [
    scan_order_items, scan_order_item_options, ingest_date_dim, ingest_order_items,
    ingest_order_item_options, dedup_date_dim, dedup_order_items, load_audit, preview,
    option_surrogate_id, parse_boolean, parse_date, parse_timestamp, blank_to_null,
    item_line_revenue, option_line_revenue, discount_lines, item_user_map, options_with_user,
    customer_item_spend, customer_option_spend, customer_spend, order_summary, discounted_orders,
    order_discount_flag, recency_baseline, order_gaps, customer_rfm, clv_percent_rank, rfm_scores,
    customer_lifetime_value, customer_segments, sales_trends, loyalty_impact, location_performance,
    discount_effectiveness, view_segment_counts, view_churn_counts, view_customer_roster,
    view_revenue_timeline, view_hourly_demand, view_loyalty, view_location_league, view_discount,
    clv_as_of, clv_daily_merge, clv_merged_batches, clv_percent_rank_merged, loyalty_impact_merged, location_performance_merged,
    seasonal_sales, location_extremes, discount_net_revenue, period_change, discount_depth,
    period_calendar, seasonal_index,
]
