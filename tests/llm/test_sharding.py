import zlib

from pyspark.sql import functions as F

from plateful.llm import sharding
from tests.llm.cases import SCHEMA, clashing, documents, frame, rows


def plain_jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2 ** 64
        j = int((b + 1) * (2 ** 31 / ((key >> 33) + 1)))
    return b


def test_jumps_match_plain_form(spark):
    keys = [0, 1, -1, 2 ** 63 - 1, -2 ** 63, *range(1000, 1200)]
    counts = (1, 2, 16, 17, 100)
    df = spark.createDataFrame([(k,) for k in keys], "k long").select("k", sharding.jump_shards(F.col("k"), *counts).alias("s"))
    for r in df.collect():
        assert r["s"] == [plain_jump(r["k"] % 2 ** 64, n) for n in counts]


def test_report(spark):
    report = sharding.shard_documents(frame(spark)).collect()
    assert len(report) == len(documents())
    text = {d[0]: d[1] or "" for d in documents() if d[0] is not None}
    slots = {}
    for r in report:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "key" and 0 <= r["shard"] < 16 and r["grown_shard"] in (r["shard"], 16)
        if r["doc_id"] is not None:
            assert r["size"] == len(text[r["doc_id"]].encode()) + 1
            assert r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r["shard"] for r in report if r["doc_id"] == 206}) == 1
    assert rows(sharding.shard_documents(frame(spark).repartition(5))) == rows(sharding.shard_documents(frame(spark)))
    assert sharding.shard_documents(frame(spark, [], SCHEMA)).count() == 0


def test_few_keys_move_and_shards_are_even(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    found = sharding.shard_documents(docs).toPandas()
    sizes = found.groupby("shard").size()
    assert sizes.min() > 1100 and sizes.max() < 1400
    moved = found[found.shard != found.grown_shard]
    assert 1000 < len(moved) < 1350 and (moved.grown_shard == 16).all()


def test_hot_key_is_numbered_over_several_tasks(spark):
    docs = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("x").alias("text"))
    found = sharding.shard_documents(docs).toPandas()
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in found.groupby("shard"))


def test_written_shards_keep_rows_and_columns(spark, tmp_path):
    docs = clashing(frame(spark), "slot", "law")
    sharding.write_shards(docs, str(tmp_path / "out"), "doc_id", 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(documents()) and set(back.columns) == {*docs.columns, "shard"}


def test_report_leaves_clashing_columns_out(spark):
    docs = clashing(frame(spark), "size", "law", "shard", "slot", "grown_shard", "text_crc32", "_shards", "_tie", "_id")
    assert rows(sharding.shard_documents(docs)) == rows(sharding.shard_documents(frame(spark)))
