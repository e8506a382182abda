"""The star-schema test tables seen as restaurant raw tables.

Only the tables that the asked-for columns come from are joined.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from plateful import schemas

TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
                " l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_type string, p_retailprice double",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(TABLES[table]).parquet(f"{sf_dir}/{table}.parquet")


# Raw column: the table it needs and its expression.
ITEM_COLUMNS = {
    "app_name": ("orders", "o_orderpriority"),
    "restaurant_id": ("lineitem", "CAST(l_suppkey AS string)"),
    "creation_time_utc": ("orders", "o_orderdate + make_dt_interval(0, CAST(o_orderkey % 24 AS int))"),
    "order_id": ("lineitem", "CAST(l_orderkey AS string)"),
    "user_id": ("orders", "CAST(o_custkey AS string)"),
    "printed_card_number": ("lineitem", "CAST(NULL AS string)"),
    "is_loyalty": ("customer", "c_mktsegment IN ('BUILDING', 'HOUSEHOLD')"),
    "currency": ("lineitem", "'USD'"),
    "lineitem_id": ("lineitem", "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"),
    "item_category": ("part", "p_type"),
    "item_name": ("part", "p_name"),
    "item_price": ("part", "CAST(p_retailprice AS decimal(10,2))"),
    "item_quantity": ("lineitem", "CAST(l_quantity AS int)"),
}

# An add-on per taxed line, a promotion per line with at least 9 % discount.
OPTION_ROWS = """inline(array_compact(array(
    if(l_tax > 0, struct('addon' AS option_group_name, 'tax' AS option_name,
        CAST(round(price * CAST(l_tax AS decimal(4,2)), 2) AS decimal(10,2)) AS option_price,
        l_linenumber AS option_quantity), NULL),
    if(l_discount >= 0.09D, struct('promo' AS option_group_name, 'discount' AS option_name,
        CAST(-round(price * CAST(l_discount AS decimal(4,2)), 2) AS decimal(10,2)) AS option_price,
        1 AS option_quantity), NULL))))"""


def joined_lines(spark, sf_dir, tables) -> DataFrame:
    """Line items joined with the named tables."""
    lines = read(spark, sf_dir, "lineitem")
    if {"orders", "customer"} & set(tables):
        orders = read(spark, sf_dir, "orders")
        lines = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    if "customer" in tables:
        customer = read(spark, sf_dir, "customer")
        lines = lines.join(customer, F.col("o_custkey") == customer.c_custkey)
    if "part" in tables:
        part = read(spark, sf_dir, "part")
        lines = lines.join(part, F.col("l_partkey") == part.p_partkey)
    return lines


def order_items(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The raw order items, all columns or the named ones."""
    columns = columns or schemas.ORDER_ITEMS.names
    lines = joined_lines(spark, sf_dir, {ITEM_COLUMNS[c][0] for c in columns})
    return lines.selectExpr(*[f"{ITEM_COLUMNS[c][1]} AS {c}" for c in columns])


def order_item_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw options without the generated id."""
    keys = [f"{ITEM_COLUMNS[c][1]} AS {c}" for c in ("order_id", "lineitem_id")]
    priced = joined_lines(spark, sf_dir, {"part"}).selectExpr("*", f"{ITEM_COLUMNS['item_price'][1]} AS price")
    return priced.selectExpr(*keys, OPTION_ROWS)


def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order date; fixed-date holidays only."""
    day = F.col("date_key")
    weekday = F.date_format(day, "EEEE")
    month_day = F.month(day) * 100 + F.dayofmonth(day)
    holiday = (F.when(month_day == 101, "New Year").when(month_day == 704, "Independence Day")
               .when(month_day == 1225, "Christmas"))
    return (read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date_key")).distinct()
            .select("date_key", F.year(day).alias("year"), F.month(day).alias("month"),
                    F.weekofyear(day).alias("week"), weekday.alias("day_of_week"),
                    weekday.isin("Saturday", "Sunday").alias("is_weekend"),
                    holiday.isNotNull().alias("is_holiday"), holiday.alias("holiday_name")))


# Text forms, as a delimited file would hold them, some of them blank or unreadable.

def pick(number, *texts):
    """One of ``texts`` by the remainder of ``number``."""
    return F.element_at(F.array(*[F.lit(t) for t in texts]), (number % len(texts)).cast("int") + 1)


def flag_text(flag, number):
    return F.when(flag, pick(number, "True", "TRUE", "1", "yes")).otherwise(
        pick(number, "False", "0", "no", "", "true "))


def date_dim_text(spark, sf_dir) -> DataFrame:
    """The date dimension once per order, so dates repeat; ``position`` orders the rows."""
    orders, day, key = read(spark, sf_dir, "orders"), F.to_date("o_orderdate"), F.col("o_orderkey")
    weekday = F.date_format(day, "EEEE")
    return orders.select(
        F.when(key % 97 == 0, F.date_format(day, "yyyy/MM/dd")).otherwise(
            F.date_format(day, "dd-MM-yyyy")).alias("date_key"),
        F.when(key % 101 == 0, "20x4").otherwise(F.year(day).cast("string")).alias("year"),
        F.when(key % 11 == 0, "").otherwise(F.month(day).cast("string")).alias("month"),
        F.when(key % 7 == 0, "").when(key % 103 == 0, "wk").otherwise(F.weekofyear(day).cast("string")).alias("week"),
        weekday.alias("day_of_week"),
        flag_text(weekday.isin("Saturday", "Sunday"), key).alias("is_weekend"),
        flag_text(F.col("o_orderpriority") == "1-URGENT", key).alias("is_holiday"),
        F.when(key % 3 == 0, "  ").otherwise(F.concat(F.lit(" "), "o_orderpriority")).alias("holiday_name"),
        key.alias("position"))


def order_items_text(spark, sf_dir, line_parts=("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")):
    """Order items as text; ``line_parts`` form the line id, fewer parts make it repeat."""
    key, part = F.col("l_orderkey"), F.col("l_partkey")
    known = {name: F.expr(text) for name, (_, text) in ITEM_COLUMNS.items()}
    lines = joined_lines(spark, sf_dir, {"orders", "customer", "part"})
    time = F.concat(F.replace(known["creation_time_utc"].cast("string"), F.lit(" "), F.lit("T")),
                    F.lit(".250Z"))
    plain = ["app_name", "restaurant_id", "order_id", "printed_card_number", "currency",
             "item_category", "item_name"]
    return lines.select(
        *[known[c].alias(c) for c in plain],
        F.when(key % 89 == 0, "bad").otherwise(time).alias("creation_time_utc"),
        F.when(F.col("o_custkey") % 20 == 0, None).otherwise(known["user_id"]).alias("user_id"),
        flag_text(known["is_loyalty"], key).alias("is_loyalty"),
        F.concat_ws("-", *line_parts).alias("lineitem_id"),
        F.when(part % 53 == 0, "").otherwise(known["item_price"].cast("string")).alias("item_price"),
        F.when(part % 59 == 0, "x").otherwise(known["item_quantity"].cast("string")).alias("item_quantity"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")


# A total order of the lines, the stand-in for the file order.
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]


def order_item_options_text(spark, sf_dir) -> DataFrame:
    options = order_item_options(spark, sf_dir)
    return options.select(
        "order_id", "lineitem_id", "option_group_name",
        F.when(F.col("option_group_name") == "addon", None).otherwise(F.col("option_name")).alias("option_name"),
        F.when(F.col("option_quantity") == 6, "n/a").otherwise(F.col("option_price").cast("string"))
        .alias("option_price"),
        F.when(F.col("option_quantity") == 7, "").otherwise(F.col("option_quantity").cast("string"))
        .alias("option_quantity"))
