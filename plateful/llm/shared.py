"""What several operators of this folder share."""

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A word is a run without a space, tab, line feed, vertical tab, form feed or carriage return.
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def broadcast_below(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """``df`` (narrow rows, cheap to count) marked for broadcast if it has at most ``rows`` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def released(batches):
    """The batches in turn; after each, Arrow memory that is no longer used goes back to the system."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()


def hot_limit(rows: int, least: int = 100, keys: int = 100_000) -> int:
    """A key with more rows than this is hot; of ``rows`` rows there are at most ``keys`` such keys."""
    return max(least, rows // keys)


def split_join(rows: DataFrame, table: DataFrame, key: str, limit: int) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has one row per key and in ``n`` how many of ``rows`` have it.

    The few hot keys are sent to the rows (:func:`hot_limit` bounds their number), so that no task gets all rows
    of one; only the others are shuffled by key.
    """
    hot = F.broadcast(table.filter(F.col("n") > limit))
    cold = rows.join(hot.select(key), key, "left_anti").join(table.filter(F.col("n") <= limit), key)
    return rows.join(hot, key).unionByName(cold).drop("n")
