"""Exact distinct counts that can be merged: bitmaps over dense ids.

A count of distinct orders cannot be added up over days, because an order may come again. Its set of
orders can: every order has a dense id, a group keeps one bitmap per range of ids in which it has
any, and two states of a group merge by OR. Merging the same rows twice changes nothing.

A bitmap is as long as its range however few ids it holds, so ids that a group uses should lie close
together: new ids are given in the order of the group, which puts a day's orders of a restaurant into one or
two ranges. Stored bitmaps with few ids compress well.
"""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from plateful.operators.keys import with_dense_id

ID = "dense_id"


def extended_ids(values: DataFrame, key: str, known: DataFrame | None = None, near: list[str] = ()) -> DataFrame:
    """``known`` (key, ``ID``) and, after its largest, ids for the other values of ``key``; NULL gets none.

    Ids of values that are alike in the first values of the columns ``near`` follow one another.
    """
    new = values.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)), *[F.min(c).alias(c) for c in near])
    first = 0
    if known is not None:
        new = new.join(known.select(key), key, "left_anti")
        last = known.agg(F.max(ID)).first()[0]
        first = 0 if last is None else last + 1
    if near:
        new = new.repartitionByRange(*near, key).sortWithinPartitions(*near, key)
    new = with_dense_id(new.select(key), ID, first)
    return new if known is None else known.select(key, ID).unionByName(new)


def distinct_state(rows: DataFrame, groups: list[str], key: str, ids: DataFrame) -> DataFrame:
    """Per group and range of ids: ``bucket`` and ``bits``, the set of the values of ``key``.

    Rows are cut to one per group and value before they meet their ids, so a hot value is no hot key. Ids are
    then shuffled, not bitmaps: a task that held a few ids of every range would send a bitmap for each. A
    group and range has no more ids than a bitmap has bits.
    """
    each = rows.filter(F.col(key).isNotNull()).select(*groups, key).distinct().join(ids, key)
    return (each.select(*groups, F.bitmap_bucket_number(ID).alias("bucket"), F.bitmap_bit_position(ID).alias("_bit"))
            .repartition(*groups, "bucket").groupBy(*groups, "bucket")
            .agg(F.bitmap_construct_agg("_bit").alias("bits")))


def merged_states(states: list[DataFrame], groups: list[str]) -> DataFrame:
    """One state of all rows that any of ``states`` was made from."""
    return (reduce(DataFrame.unionByName, states).groupBy(*groups, "bucket")
            .agg(F.bitmap_or_agg("bits").alias("bits")))


def distinct_counts(state: DataFrame, groups: list[str], name: str) -> DataFrame:
    return state.groupBy(*groups).agg(F.sum(F.bitmap_count("bits")).alias(name))
