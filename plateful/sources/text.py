"""Delimited text files into typed raw tables."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from plateful import schemas
from plateful.functions.cleansing import (blank_to_null, parse_boolean, parse_date, parse_decimal,
                                          parse_integer, parse_timestamp, plain_text)
from plateful.operators.keys import first_by_key, with_dense_id

# The whole text line of a row with too few or too many fields; NULL in all others.
MALFORMED = "_malformed"

# Where a row stands in its input: file, split of the file, row of the split.
FILE_ORDER = ["_file", "_block", "_row"]


def text_reader(reader, table: str, escape: str = '"', multiline: bool = False, malformed: bool = False):
    """Configure a batch or stream reader for the text form of ``table``, all fields as text.

    Missing fields are NULL and surplus ones are cut off; with ``malformed`` such lines are marked.
    """
    names = [*text_fields(table), *([MALFORMED] if malformed else [])]
    return (reader.schema(T.StructType([T.StructField(name, T.StringType()) for name in names]))
            .option("columnNameOfCorruptRecord", MALFORMED).option("header", True).option("sep", ",").option("quote", '"')
            .option("escape", escape).option("multiLine", multiline))


def text_fields(table: str) -> list[str]:
    """Columns that a file holds, in file order; the option id is generated."""
    return [name for name in schemas.RAW_TABLES[table].names if name != "id"]


def with_file_place(raw: DataFrame) -> DataFrame:
    return raw.select("*", F.col("_metadata.file_path").alias("_file"),
                      F.col("_metadata.file_block_start").alias("_block"))


def read_text(spark: SparkSession, path, table: str, **how) -> DataFrame:
    """All fields as text, by position, without the header row, plus the ``FILE_ORDER`` columns.

    Quoted fields may hold commas. ``multiline=True`` also allows line breaks in them, at the
    price of one task per file.
    """
    raw = with_file_place(text_reader(spark.read, table, **how).csv(path))
    return raw.withColumn("_row", F.monotonically_increasing_id())


def clean_date_dim(text: DataFrame, strict: bool = False) -> DataFrame:
    """Typed date dimension; columns the source does not have pass through."""
    return text.withColumns({
        "date_key": parse_date(plain_text("date_key")),
        "year": parse_integer(blank_to_null(plain_text("year")), strict),
        "month": parse_integer(plain_text("month"), strict),
        "week": parse_integer(blank_to_null(plain_text("week")), strict),
        "day_of_week": plain_text("day_of_week"),
        "is_weekend": parse_boolean(F.col("is_weekend")),
        "is_holiday": parse_boolean(F.col("is_holiday")),
        "holiday_name": blank_to_null(plain_text("holiday_name"), trim=True),
    })


def clean_order_items(text: DataFrame, strict: bool = False) -> DataFrame:
    names = ["app_name", "restaurant_id", "order_id", "user_id", "printed_card_number",
             "currency", "lineitem_id", "item_category", "item_name"]
    return text.withColumns({
        **{name: plain_text(name) for name in names},
        "creation_time_utc": parse_timestamp(plain_text("creation_time_utc")),
        "is_loyalty": parse_boolean(F.col("is_loyalty")),
        "item_price": parse_decimal(plain_text("item_price"), strict),
        "item_quantity": parse_integer(plain_text("item_quantity"), strict),
    })


def clean_order_item_options(text: DataFrame, strict: bool = False) -> DataFrame:
    names = ["order_id", "lineitem_id", "option_group_name", "option_name"]
    return text.withColumns({
        **{name: plain_text(name) for name in names},
        "option_price": parse_decimal(plain_text("option_price"), strict),
        "option_quantity": parse_integer(plain_text("option_quantity"), strict),
    })


# Cleaning function and primary key per table; options get a generated key.
RULES = {
    "date_dim_raw": (clean_date_dim, "date_key"),
    "order_items_raw": (clean_order_items, "lineitem_id"),
    "order_item_options_raw": (clean_order_item_options, None),
}


def type_text(text: DataFrame, table: str, strict: bool = False, first_id: int = 1) -> DataFrame:
    """Typed rows of a text table with ``FILE_ORDER`` columns: the first row per key, or all with an id."""
    clean, key = RULES[table]
    typed = clean(text, strict)
    typed = first_by_key(typed, key, FILE_ORDER) if key else with_dense_id(typed, "id", first_id)
    return typed.select(*schemas.RAW_TABLES[table].names)


def load_text(spark: SparkSession, path, table: str, *, strict: bool = False, **how) -> DataFrame:
    """A raw table from its text files."""
    return type_text(read_text(spark, path, table, **how), table, strict)
