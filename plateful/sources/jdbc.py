"""Partitioned reads of the raw tables from a relational database."""

from pyspark.sql import DataFrame, SparkSession

# Columns whose ranges split a table into parallel reads; the date dimension is one small read.
SPLIT_COLUMNS = {"order_items_raw": "lineitem_id", "order_item_options_raw": "id"}

# Split columns that are text. Only they have an index there, so that a range is not a scan of the
# whole table; their values have no even distance, so the database cuts them into equal counts.
TEXT_KEYS = {"order_items_raw"}


def jdbc_options(url: str, table: str, properties: dict, *, column: str | None = None, lower=None,
                 upper=None, partitions: int | None = None, fetch_size: int = 10_000) -> dict:
    """Reader options. With ``column`` each task reads one range of it.

    The bounds only place the cuts: rows outside them, and rows where the column is NULL,
    are read by the first or last range.
    """
    options = {**properties, "url": url, "dbtable": table, "fetchsize": str(fetch_size),
               "preferTimestampNTZ": "true"}
    if url.startswith("jdbc:mysql:"):
        # Without a cursor this driver ignores the fetch size and buffers a task's whole range.
        options.setdefault("useCursorFetch", "true")
    if column is None:
        return options
    if lower is None or upper is None or not partitions:
        raise ValueError("a split read needs lower, upper and partitions")
    return {**options, "partitionColumn": column, "lowerBound": str(lower),
            "upperBound": str(upper), "numPartitions": str(partitions)}


def split_bounds(spark: SparkSession, url: str, table: str, properties: dict, column: str) -> tuple:
    """Smallest and largest value of a column; the database computes them and sends one row."""
    query = f"(select min({column}) as lo, max({column}) as hi from {table}) bounds"
    row = spark.read.format("jdbc").options(**jdbc_options(url, query, properties)).load().first()
    return row["lo"], row["hi"]


def cut_query(table: str, column: str, partitions: int) -> str:
    """The first value of each of ``partitions`` ranges with equally many rows, as one query of the database."""
    tiles = f"select {column} as k, ntile({partitions}) over (order by {column}) as tile from {table} where {column} is not null"
    return f"(select tile, min(k) as cut from ({tiles}) tiles group by tile) cuts"


def key_predicates(column: str, cuts: list[str], backslash_escapes: bool = False) -> list[str]:
    """One condition per range between the ``cuts``. Every row meets exactly one; the first also takes NULL.

    Equal cuts, as a value with very many rows makes them, are one. The database compares in its own
    order throughout, so ``cuts`` must be in that order.
    """
    def quoted(value):
        text = value.replace("\\", "\\\\") if backslash_escapes else value
        return "'" + text.replace("'", "''") + "'"

    inner = [quoted(c) for c in [*dict.fromkeys(cuts)][1:]]
    if not inner:
        return ["1 = 1"]
    between = [f"{column} >= {a} and {column} < {b}" for a, b in zip(inner, inner[1:])]
    return [f"{column} < {inner[0]} or {column} is null", *between, f"{column} >= {inner[-1]}"]


def key_ranges(spark: SparkSession, url: str, table: str, properties: dict, column: str, partitions: int) -> list[str]:
    """Predicates that split a table by a text key into ranges of equally many rows."""
    query = cut_query(table, column, partitions)
    rows = spark.read.format("jdbc").options(**jdbc_options(url, query, properties)).load().collect()
    cuts = [r["cut"] for r in sorted(rows, key=lambda r: r["tile"])]
    return key_predicates(column, cuts, url.startswith("jdbc:mysql:"))


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict, *, partitions: int,
              predicates: list[str] | None = None, column: str | None = None) -> DataFrame:
    """A table as a DataFrame; filters and columns are pushed to the database.

    ``partitions`` is the number of ranges, one task each; 1 reads a small table whole.
    ``predicates`` gives one WHERE clause per task and must cover every row exactly once. It
    suits tables whose split column is uneven. The items are split by their text key, which needs a database
    with window functions; name another ``column`` where there are none.
    """
    if not predicates and column is None and partitions > 1 and table in TEXT_KEYS:
        predicates = key_ranges(spark, url, table, properties, SPLIT_COLUMNS[table], partitions)
    if predicates:
        options = jdbc_options(url, table, properties)
        return spark.read.jdbc(options.pop("url"), options.pop("dbtable"), predicates=predicates,
                               properties=options)
    column = column or SPLIT_COLUMNS.get(table)
    if partitions > 1 and column:
        lower, upper = split_bounds(spark, url, table, properties, column)
        if lower is not None:
            options = jdbc_options(url, table, properties, column=column, lower=lower, upper=upper,
                                   partitions=partitions)
            return spark.read.format("jdbc").options(**options).load()
    return spark.read.format("jdbc").options(**jdbc_options(url, table, properties)).load()
