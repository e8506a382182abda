"""Load checks: what arrived, and what could not be read."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from plateful import schemas
from plateful.sources.text import RULES


def preview(table: DataFrame, rows: int = schemas.PREVIEW_ROWS, order_by: list[str] | None = None) -> DataFrame:
    """A few rows: the first by ``order_by``, or any."""
    return (table.orderBy(*order_by) if order_by else table).limit(rows)


# Per table: its key, fields that must be readable, and fields that may be blank but not unreadable.
CHECKS = {
    "date_dim_raw": ("date_key", ["date_key", "month"], ["year", "week"]),
    "order_items_raw": ("lineitem_id", ["creation_time_utc", "item_price", "item_quantity"], []),
    "order_item_options_raw": ("lineitem_id", ["option_price", "option_quantity"], []),
}


def audit_text(table: str, text: DataFrame) -> DataFrame:
    """One row: rows, distinct keys, rows without a key, and fields that typing cannot read.

    ``text`` is the table before typing.
    """
    key, parsed, blank_allowed = CHECKS[table]
    typed, bad = _strictly_typed(table, text)
    return _counted(table, typed, key, bad)


def with_checks(table: str, text: DataFrame) -> DataFrame:
    """``text`` with ``_unread``, the number of its fields that typing cannot read, and ``_no_key``."""
    key = CHECKS[table][0]
    kept = {c: F.col(c) for c in text.columns}
    typed, bad = _strictly_typed(table, text.withColumns({f"_raw_{c}": value for c, value in kept.items()}))
    checked = typed.withColumns({"_unread": reduce(lambda a, b: a + b, [b.cast("bigint") for b in bad]), "_no_key": _no_key(key)})
    return checked.select(*[F.col(f"_raw_{c}").alias(c) for c in text.columns], "_unread", "_no_key")


def _strictly_typed(table, text):
    """The typed table, and per checked field whether it could not be read."""
    key, parsed, blank_allowed = CHECKS[table]
    kept = {c: f"_text_{c}" for c in blank_allowed}
    typed = RULES[table][0](text.withColumns({new: F.col(c) for c, new in kept.items()}), strict=True)
    bad = [F.col(c).isNull() for c in parsed]
    return typed, bad + [F.col(c).isNull() & (F.trim(F.coalesce(new, F.lit(""))) != "") for c, new in kept.items()]


def _no_key(key):
    return F.col(key).isNull() | (F.col(key).cast("string") == "")


def audit_landed(table: str, rows: DataFrame) -> DataFrame:
    """The same row for a landed table that came typed, so nothing was left unread."""
    return _counted(table, rows, CHECKS[table][0], [])


def _counted(table, rows, key, bad):
    failures = reduce(lambda a, b: a + b, [F.sum(b.cast("bigint")) for b in bad], F.lit(0).cast("bigint"))
    return rows.agg(F.count(F.lit(1)).alias("row_count"),
                    F.countDistinct(key).alias("distinct_keys"),
                    F.coalesce(F.sum(_no_key(key).cast("bigint")), F.lit(0)).alias("null_keys"),
                    F.coalesce(failures, F.lit(0)).alias("parse_failures")
                    ).select(F.lit(table).alias("table_name"), "*")


def load_audit(date_dim: DataFrame, items: DataFrame, options: DataFrame) -> DataFrame:
    """One row per raw table, from the text tables."""
    texts = {"date_dim_raw": date_dim, "order_items_raw": items, "order_item_options_raw": options}
    return reduce(DataFrame.unionByName, [audit_text(table, text) for table, text in texts.items()])
