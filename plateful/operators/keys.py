"""Primary-key rules of the raw tables: first row wins, generated ids."""

from pyspark.sql import DataFrame, Window, functions as F

from plateful.plans.staging import checkpointed


def first_by_key(df: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """Keep the first row per key in ``order_by`` order; rows without a key drop out.

    Spark trims each key to one row per task before the shuffle, so a key that repeats in a
    large share of all rows stays cheap.
    """
    first = Window.partitionBy(key).orderBy(*order_by)
    return (df.filter(F.col(key).isNotNull())
            .withColumn("_nth", F.row_number().over(first))
            .filter("_nth = 1").drop("_nth"))


def with_positions(df: DataFrame, group_by: list[str], order_by: list[str], name: str = "position") -> DataFrame:
    """Number the rows of each group from 0 without a gap, in ``order_by`` order, as ``name``.

    Rows are sorted over the whole table by ranges, so no task holds a whole group and a hot
    group spreads over many tasks; rows that tie in every key are spread too. NULL is a group of its own.
    """
    keys = [*group_by, *order_by]
    rows = (df.withColumn("_tie", F.monotonically_increasing_id())
            .repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys, "_tie").drop("_tie"))
    return numbered(checkpointed(_with_place(rows)), group_by, name).select(*df.columns, name)


def with_dense_id(df: DataFrame, name: str = "id", first: int = 1) -> DataFrame:
    """Number all rows from ``first`` without a gap, in the order of tasks and rows, without a shuffle."""
    rows = numbered(checkpointed(_with_place(df)), [], name)
    return rows.withColumn(name, F.col(name) + F.lit(first).cast("bigint")).select(*df.columns, name)


def _with_place(df):
    """The task and the row of the task that each row comes from, as one number."""
    return df.withColumn("_id", F.monotonically_increasing_id())


def numbered(rows: DataFrame, group_by: list[str], name: str) -> DataFrame:
    """Add ``name``: the position within the group of rows ordered by ``_id``, as written by one job.

    Each task numbers its own rows, and the rows of the tasks ahead are added per group. That
    list has at most one row per task and group boundary, so sending it to every task is safe
    while the groups are few (shards, lengths), however many rows there are.
    """
    rows = rows.withColumn("_task", F.shiftright("_id", 33))
    runs = rows.groupBy(*group_by, "_task").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    ahead = Window.partitionBy(*group_by).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    shifts = runs.select(*[F.col(g).alias(f"_group_{i}") for i, g in enumerate(group_by)],
                         F.col("_task").alias("_of_task"),
                         (F.coalesce(F.sum("_n").over(ahead), F.lit(0)) - F.col("_first")).alias("_shift"))
    same = F.col("_task") == F.col("_of_task")
    for i, g in enumerate(group_by):
        same = same & F.col(g).eqNullSafe(F.col(f"_group_{i}"))
    return rows.join(F.broadcast(shifts), same).withColumn(name, F.col("_id") + F.col("_shift"))
