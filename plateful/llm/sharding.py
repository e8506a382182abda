"""Sharding by jump consistent hashing.

A key's shard follows from its hash and the number of shards alone; no ring table is kept.
Adding a shard at the end moves about one key in ``shards + 1``, all of them to the new one.
The jumps use the usual 64-bit linear generator, kept as two 32-bit halves in bigint so that
nothing overflows.

Defined results: a NULL key has a shard like any other value; equal keys share a shard; a NULL
text has size 1 and the checksum of no bytes, 0; a very long text is a size and a checksum like any other; rows
that repeat get slots of their own; an empty table gives an empty result; other columns are left out of the report.
"""

from pyspark.sql import Column, DataFrame, functions as F

from plateful.operators.keys import with_positions
from plateful.plans.staging import checkpointed

MULTIPLIER = 2862933555777941757
_LOW = 0xFFFFFFFF


def _times_plus_one(high: Column, low: Column) -> tuple[Column, Column]:
    """Halves of (value * MULTIPLIER + 1) mod 2**64; every product here has at most 48 bits."""
    m1, m0 = (F.lit(MULTIPLIER >> 32).cast("long"), F.lit(MULTIPLIER & _LOW).cast("long"))

    def halves(x):
        return F.shiftright(x, 16), x.bitwiseAND(F.lit(0xFFFF))

    def low_product(x, y):
        upper, lower = halves(x)
        return (F.shiftleft((upper * y).bitwiseAND(F.lit(0xFFFF)), 16) + lower * y).bitwiseAND(F.lit(_LOW))

    upper, lower = halves(low)
    bottom = F.shiftleft((upper * m0).bitwiseAND(F.lit(0xFFFF)), 16) + lower * m0 + F.lit(1)
    carry = F.shiftright(bottom, 32) + F.shiftright(upper * m0, 16)
    return ((low_product(high, m0) + low_product(low, m1) + carry).bitwiseAND(F.lit(_LOW)),
            bottom.bitwiseAND(F.lit(_LOW)))


def jump_shards(key: Column, *counts: int) -> Column:
    """Shard of a bigint ``key`` for each number of shards in ``counts``, as an array.

    All counts follow the same jumps: a key's shard among n is the last jump target below n.
    """
    most = max(counts)

    def step(state, _):
        high, low = _times_plus_one(state["high"], state["low"])
        to = F.floor((state["at"] + 1) * (F.lit(float(2 ** 31)) / (F.shiftright(high, 1) + 1))).cast("long")
        moved = F.struct(high.alias("high"), low.alias("low"), to.alias("at"),
                         F.transform(state["shards"], lambda s, i: F.when(
                             to < F.element_at(F.array(*[F.lit(c).cast("long") for c in counts]), i + 1), to)
                             .otherwise(s)).alias("shards"))
        return F.when(state["at"] < most, moved).otherwise(state)

    zero = F.lit(0).cast("long")
    start = F.struct(F.shiftrightunsigned(key, 32).alias("high"), key.bitwiseAND(F.lit(_LOW)).alias("low"),
                     zero.alias("at"), F.array(*[zero for _ in counts]).alias("shards"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(most)), start, step, lambda s: s["shards"])


def shard(rows: DataFrame, key: str, n_shards: int, order_by: list[str]) -> DataFrame:
    """Add shard, grown_shard (with one shard more) and slot (from 0 in each shard, by ``order_by``).

    The hot shard of a hot key is spread over tasks while it is numbered; see ``with_positions``.
    ``rows`` should be narrow: all its columns are sorted once.
    """
    both = jump_shards(F.xxhash64(key), n_shards, n_shards + 1)
    placed = (rows.withColumn("_shards", both)
              .withColumns({"shard": F.col("_shards")[0].cast("int"), "grown_shard": F.col("_shards")[1].cast("int")})
              .drop("_shards"))
    return with_positions(checkpointed(placed), ["shard"], order_by, "slot")


def shard_documents(docs: DataFrame, n_shards: int = 16) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"),
                         F.crc32(text).alias("text_crc32"))
    return (shard(narrow, "doc_id", n_shards, ["doc_id", "text_crc32", "size"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"))


def write_shards(docs: DataFrame, path: str, key: str, n_shards: int) -> None:
    """Write the rows, with all their columns, as one folder ``shard=...`` per shard.

    Rows go to the folder of their shard through tasks split by size, not one task per shard.
    """
    (docs.withColumn("shard", jump_shards(F.xxhash64(key), n_shards)[0].cast("int"))
     .hint("rebalance", "shard").write.partitionBy("shard").parquet(path))
