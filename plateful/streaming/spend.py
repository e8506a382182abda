"""Lifetime value kept up to date by the files that arrive.

One stream reads the new item files and the new option files. Each micro-batch makes the next version of a
small state from the version before it, and both carry the number of their batch:

* ``spend``: item and option spend per user;
* ``pending``: options whose line has not arrived yet;
* ``owners``: the user of every line that has arrived, hashed by line (:class:`KeyTable`).

A batch that is replayed after a failure starts from the version before it again and replaces what its
first try wrote, so nothing is added twice. Items and options are never read again: of the history a
batch reads the spend per user and the keys of the lines, and shuffles neither by line.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from plateful import schemas
from plateful.operators.facts import SPEND_TYPE
from plateful.plans.extensions import unowned_options, update_spend
from plateful.plans.staging import checkpointed, folders, remove_folder
from plateful.sources.text import clean_order_item_options, text_reader, type_text, with_file_place
from plateful.streaming.keytable import KeyTable
from plateful.streaming.landing import KEY_BUCKETS, KEY_DATABASE, _name_of, new_rows, refuse_new_checkpoint

ITEMS, OPTIONS = "order_items_raw", "order_item_options_raw"
SPEND = f"user_id string, total_item_spend {SPEND_TYPE}, total_option_spend {SPEND_TYPE}"
KEPT_VERSIONS = 2
# What the spend needs of a line; the other fields go no further than the file.
LINE = ["lineitem_id", "user_id", "item_price", "item_quantity"]


def merge_new_files(spark: SparkSession, items: str, options: str, base: str, checkpoint: str, *, strict: bool = False,
                    database: str = KEY_DATABASE, buckets: int = KEY_BUCKETS, **how) -> None:
    """Merge the files that arrived in the folders ``items`` and ``options`` into the state in ``base``, then stop.

    A line that arrived before is skipped: the first row wins. An option counts once its line is there, in
    this batch, before it or after it. Options of a line without a user are credited to nobody.
    """
    base = base.rstrip("/")
    refuse_new_checkpoint(spark, f"{base}/spend", checkpoint)
    owners = KeyTable(database, _name_of(f"{base}/owners"), f"{base}/owners", "lineitem_id", "lineitem_id string, user_id string", buckets)
    owners.create(spark)

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch.filter(F.col("_table") == ITEMS), batch.filter(F.col("_table") == OPTIONS),
                    base, owners, batch_id, strict)

    sources = [with_file_place(text_reader(spark.readStream, table, **how).csv(folder)).withColumn("_table", F.lit(table))
               for table, folder in ((ITEMS, items), (OPTIONS, options))]
    (sources[0].unionByName(sources[1], allowMissingColumns=True).writeStream.foreachBatch(merge)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())


def merge_batch(items_text: DataFrame, options_text: DataFrame, base: str, owners: KeyTable, batch_id: int,
                strict: bool = False) -> None:
    """Write version ``batch_id`` of the state from the version before it and the text rows of a batch."""
    spark = items_text.sparkSession
    items_text = items_text.withColumn("_row", F.monotonically_increasing_id())
    arrived = checkpointed(type_text(items_text, ITEMS, strict).select(*LINE))
    option_columns = [f for f in schemas.RAW_TABLES[OPTIONS].names if f != "id"]
    options = clean_order_item_options(options_text, strict).select(*option_columns)
    options = checkpointed(options.unionByName(_version(spark, base, "pending", batch_id - 1, _pending_schema())))
    # The lines of the batch and of its options meet the history once.
    wanted = arrived.select("lineitem_id").unionByName(options.select("lineitem_id")).distinct()
    known = checkpointed(owners.known(wanted, batch_id))
    fresh = checkpointed(arrived.join(known, "lineitem_id", "left_anti"))
    lines = known.unionByName(fresh.select("lineitem_id", "user_id"))
    spend = update_spend(_version(spark, base, "spend", batch_id - 1, SPEND), fresh, options, lines,
                         unique_owners=True)
    spend.write.mode("overwrite").parquet(f"{base}/spend/version={batch_id}")
    unowned_options(options, lines).write.mode("overwrite").parquet(f"{base}/pending/version={batch_id}")
    owners.add(fresh, batch_id)
    for part in ("spend", "pending"):
        for version in folders(spark, f"{base}/{part}"):
            if int(version.rpartition("=")[2]) <= batch_id - KEPT_VERSIONS:
                remove_folder(spark, f"{base}/{part}/{version}")


def read_spend(spark: SparkSession, base: str) -> DataFrame:
    """``customer_spend`` of everything merged so far: the newest version that was written whole."""
    base = base.rstrip("/")
    whole = [v for v in folders(spark, f"{base}/spend") if "_SUCCESS" in folders(spark, f"{base}/spend/{v}", files=True)]
    if not whole:
        raise ValueError(f"nothing has been merged into {base}")
    newest = max(int(v.rpartition("=")[2]) for v in whole)
    return _version(spark, base, "spend", newest, SPEND)


def _pending_schema():
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.RAW_TABLES[OPTIONS].fields if f.name != "id")


def _version(spark, base, part, version, schema):
    if version < 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{base}/{part}/version={version}")
