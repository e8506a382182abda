"""Percent ranks kept up to date: row counts per value, of which a change rewrites only the buckets it touches.

Values lie in buckets as in :mod:`plateful.operators.ranking`. Two tables are kept, by version:

* ``counts/version=v/bucket=b``: value, its rows, and the rows ahead of it in the bucket;
* ``totals/version=v``: per bucket its rows and the version that wrote its counts last.

A change reads and writes the counts of the buckets with a changed value; of the others only the totals
move on. The rank of any value is its place in the bucket plus the rows of the buckets ahead. A version that is
written again after a failure starts from the version before it.
"""

from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from plateful.operators.ranking import BUCKET_VALUES
from plateful.plans.staging import checkpointed, folders, remove_folder

MISSING = "missing"
# Values a bucket can hold: one task sorts that many at most, and each bucket is a folder.
STORED_VALUES = 10 * BUCKET_VALUES


class RankStore(NamedTuple):
    """Ranks of decimals with ``scale`` digits; NULL is last when descending and first when ascending."""

    base: str
    scale: int
    descending: bool
    bucket_values: int = STORED_VALUES

    @property
    def value_type(self) -> str:
        return f"decimal(38,{self.scale})"


def changes(before: DataFrame, after: DataFrame, key: str, column: str) -> DataFrame:
    """What changed per value between two tables with one row per ``key``: value and change of its rows.

    NULL keys are one key. Rows of both that are alike cancel out, so unchanged keys may be left out of both.
    """
    return (before.select(F.col(column).alias("value"), F.lit(-1).alias("change"))
            .unionByName(after.select(F.col(column).alias("value"), F.lit(1).alias("change")))
            .groupBy("value").agg(F.sum("change").alias("change")).filter("change != 0"))


def apply_changes(spark: SparkSession, store: RankStore, changed: DataFrame, version: int) -> None:
    """Write ``version`` (from 0) from the version before it and ``changed`` (value, change of its rows)."""
    bucket = F.coalesce(F.floor(F.col("value") / F.lit(_width(store))).cast("string"), F.lit(MISSING))
    changed = (changed.select(F.col("value").cast(store.value_type).alias("value"), "change").groupBy("value")
               .agg(F.sum("change").alias("n_rows")).filter("n_rows != 0"))
    changed = checkpointed(changed.withColumn("bucket", bucket))
    before = _totals(spark, store, version - 1)
    touched = changed.select("bucket").distinct()
    places = [(r.bucket, r.version) for r in before.join(touched, "bucket", "left_semi").collect()]
    counts = touched_counts(spark, store, places).unionByName(changed).groupBy("bucket", "value").agg(F.sum("n_rows").alias("n_rows"))
    direction = F.col("value").desc() if store.descending else F.col("value").asc()
    ahead = Window.partitionBy("bucket").orderBy(direction).rowsBetween(Window.unboundedPreceding, -1)
    counts = (counts.filter("n_rows != 0").withColumn("rows_in_bucket", F.coalesce(F.sum("n_rows").over(ahead), F.lit(0))))
    path = f"{store.base}/counts/version={version}"
    counts.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
    written = spark.read.schema(f"value {store.value_type}, n_rows bigint, bucket string").parquet(path)
    fresh = written.groupBy("bucket").agg(F.sum("n_rows").alias("n_rows")).withColumn("version", F.lit(version))
    (before.join(touched, "bucket", "left_anti").unionByName(fresh).coalesce(1)
     .write.mode("overwrite").parquet(f"{store.base}/totals/version={version}"))
    _remove_superseded(spark, store, version)


def touched_counts(spark: SparkSession, store: RankStore, places: list[tuple[str, int]]) -> DataFrame:
    """bucket, value, n_rows of the named buckets, each from the version that wrote it last; no other folder is read."""
    schema = f"bucket string, value {store.value_type}, n_rows bigint"
    if not places:
        return spark.createDataFrame([], schema).select("value", "n_rows", "bucket")
    paths = [f"{store.base}/counts/version={v}/bucket={b}" for b, v in places]
    return (spark.read.schema(schema + ", version int").option("basePath", f"{store.base}/counts").parquet(*paths)
            .select("value", "n_rows", "bucket"))


def value_ranks(spark: SparkSession, store: RankStore, version: int) -> DataFrame:
    """value, n_rows and percent_rank of every value. Only the list of buckets is ordered in one task."""
    totals = _totals(spark, store, version)
    order = [F.col("bucket") == MISSING, F.col("bucket").try_cast("decimal(38,0)")]
    order = [order[0].asc(), order[1].desc()] if store.descending else [order[0].desc(), order[1].asc()]
    ahead = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("bucket").alias("_bucket"), F.col("version").alias("_version"), F.sum("n_rows").over(Window.partitionBy()).alias("total"),
                           F.coalesce(F.sum("n_rows").over(ahead), F.lit(0)).alias("rows_before"))
    schema = f"value {store.value_type}, n_rows bigint, rows_in_bucket bigint, version int, bucket string"
    counts = spark.read.schema(schema).parquet(f"{store.base}/counts")
    same = (F.col("bucket") == F.col("_bucket")) & (F.col("version") == F.col("_version"))
    rank = F.when(F.col("total") > 1, (F.col("rows_in_bucket") + F.col("rows_before")) / (F.col("total") - 1)).otherwise(F.lit(0.0))
    return counts.join(totals, same).select("value", "n_rows", rank.alias("percent_rank"))


def with_percent_rank(df: DataFrame, store: RankStore, version: int, column: str, name: str = "percent_rank") -> DataFrame:
    """Add the rank of every row of ``df``, whose values of ``column`` the store must hold."""
    ranks = value_ranks(df.sparkSession, store, version).select(
        F.col("value").cast(df.schema[column].dataType).alias("_value"), F.col("percent_rank").alias(name))
    return df.join(ranks, F.col(column).eqNullSafe(F.col("_value"))).drop("_value")


def _width(store):
    return Decimal(store.bucket_values).scaleb(-store.scale)


def _totals(spark, store, version):
    schema = "bucket string, n_rows bigint, version int"
    if version < 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{store.base}/totals/version={version}")


def _remove_superseded(spark, store, version):
    """Drop what neither this version nor the one before it uses."""
    used = {(f"version={r.version}", f"bucket={r.bucket}") for v in (version - 1, version) for r in _totals(spark, store, v).collect()}
    for kept in folders(spark, f"{store.base}/counts"):
        for bucket in folders(spark, f"{store.base}/counts/{kept}"):
            if (kept, bucket) not in used:
                remove_folder(spark, f"{store.base}/counts/{kept}/{bucket}")
    for old in folders(spark, f"{store.base}/totals"):
        if int(old.rpartition("=")[2]) < version - 1:
            remove_folder(spark, f"{store.base}/totals/{old}")
