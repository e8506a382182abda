"""Incremental landing: each run adds the text files that arrived since the last one.

The files are a Structured Streaming source, so its checkpoint remembers which were read.
Every micro-batch is one folder of the landed table, named by the stream's own id and the
batch, and replaced as a whole if the batch is replayed after a failure.
"""

from threading import Event

from pyspark.sql import DataFrame, SparkSession, functions as F

from plateful import schemas
from plateful.plans.staging import checkpointed, exists
from plateful.sources.text import RULES, text_reader, type_text, with_file_place
from plateful.streaming.keytable import KeyTable

KEY_DATABASE = "plateful_keys"
KEY_BUCKETS = 64


def land_new_files(spark: SparkSession, source: str, table: str, raw_base: str, checkpoint: str, *,
                   strict: bool = False, key_database: str = KEY_DATABASE, key_buckets: int = KEY_BUCKETS, **how) -> None:
    """Clean the new files in the folder ``source`` and add them to the landed table, then stop.

    A row whose key was landed before is skipped: the first row wins, as in a full load. The landed keys
    are kept beside the table, hashed by key (:class:`KeyTable`), so a batch never shuffles them; they are
    made from the landed rows where they are missing. Tables without a key get dense ids that go on after
    the largest landed one. A new checkpoint would read files again that were landed under the old one, so it is
    refused where the table exists.
    """
    path = f"{raw_base.rstrip('/')}/{table}"
    refuse_new_checkpoint(spark, path, checkpoint)
    keys = landed_keys(spark, raw_base, table, key_database, key_buckets)
    started, stream_id = Event(), []

    def add(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        text = batch.withColumn("_row", F.monotonically_increasing_id())
        if keys:
            rows = new_rows(checkpointed(type_text(text, table, strict)), keys, batch_id)
        else:
            rows = _numbered(text, table, strict, path, stream_id[0], batch_id)
        rows.write.mode("overwrite").parquet(f"{path}/stream_id={stream_id[0]}/batch_id={batch_id}")
        if keys:
            keys.add(rows, batch_id)

    stream = with_file_place(text_reader(spark.readStream, table, **how).csv(source))
    query = (stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    stream_id.append(str(query.id))
    started.set()
    query.awaitTermination()


def refuse_new_checkpoint(spark: SparkSession, path: str, checkpoint: str) -> None:
    """A folder that a stream has written goes on with that stream's checkpoint only."""
    if exists(spark, path) and not exists(spark, f"{checkpoint.rstrip('/')}/metadata"):
        raise ValueError(f"{path} was landed with another checkpoint than {checkpoint}")


def landed_keys(spark: SparkSession, raw_base: str, table: str, database: str, buckets: int) -> KeyTable | None:
    """The key table of a landed table, filled from its rows if it is missing; None without a key."""
    key = RULES[table][1]
    if key is None:
        return None
    path = f"{raw_base.rstrip('/')}/{table}"
    keys = KeyTable(database, _name_of(path), f"{path}_keys", key, f"`{key}` {schemas.RAW_TABLES[table][key].dataType.simpleString()}",
                    buckets)
    filled = exists(spark, keys.path)
    keys.create(spark)
    if not filled and exists(spark, path):
        landed = spark.read.schema(f"{keys.columns}, stream_id string, batch_id bigint").parquet(path)
        keys.add(landed.filter("batch_id IS NULL").select(key), -1)
        for (batch,) in landed.filter("batch_id IS NOT NULL").select("batch_id").distinct().collect():
            keys.add(landed.filter(F.col("batch_id") == batch).select(key), batch)
    return keys


def _name_of(path):
    """One catalog name per folder."""
    return "".join(c if c.isalnum() else "_" for c in path).lower()


def new_rows(rows: DataFrame, keys: KeyTable, batch_id: int) -> DataFrame:
    """Rows, unique by key, whose key no earlier batch has landed."""
    return rows.join(keys.known(rows, batch_id).select(keys.key), keys.key, "left_anti").select(*rows.columns)


def _numbered(text, table, strict, path, stream_id, batch_id):
    """Rows with ids after the largest that other batches landed."""
    spark, last = text.sparkSession, None
    if exists(spark, path):
        landed = spark.read.schema("id bigint, stream_id string, batch_id bigint").parquet(path)
        own = (F.col("stream_id") == stream_id) & (F.col("batch_id") == batch_id)
        last = landed.filter(~own).agg(F.max("id")).first()[0]
    return type_text(text, table, strict, first_id=(last or 0) + 1)
