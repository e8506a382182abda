"""Keys that were landed before, kept hashed by key so that a batch can look its own keys up.

The table is a bucketed catalog table in a folder of its own. A batch shuffles only the keys it
asks for; the history is read bucket by bucket, without an exchange and without a sort. Every row carries
the number of the batch that added it. A batch only sees the rows of the batches before it, so a
replay after a failure sees what the first try saw, whatever that try had added already.
"""

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

BATCH = "added_by"


class KeyTable(NamedTuple):
    """A catalog table over the folder ``path``: a ``key``, columns found with it (DDL), and the batch."""

    database: str
    name: str
    path: str
    key: str
    columns: str
    buckets: int

    def create(self, spark: SparkSession) -> None:
        """Register the folder, in this session's catalog too if that is a new one; its rows stay."""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`")
        spark.sql(f"""CREATE TABLE IF NOT EXISTS {self.table} ({self.columns}, {BATCH} bigint) USING parquet
            CLUSTERED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{self.path}'""")

    @property
    def table(self) -> str:
        return f"`{self.database}`.`{self.name}`"

    def known(self, wanted: DataFrame, before: int) -> DataFrame:
        """The rows with a key in ``wanted`` that batches before number ``before`` added, once each.

        The wanted keys of one bucket are held in memory while the history passes by, so there should
        be enough buckets for those of a batch.
        """
        history = wanted.sparkSession.table(self.table).filter(F.col(BATCH) < before).drop(BATCH)
        keys = wanted.select(self.key).hint("shuffle_hash")
        return history.join(keys, self.key, "left_semi").distinct()

    def add(self, rows: DataFrame, batch: int) -> None:
        """Add the rows of a batch, one file per bucket. After a replay they are there twice, which ``known`` hides."""
        columns = [*rows.sparkSession.table(self.table).drop(BATCH).columns]
        (rows.select(*columns, F.lit(batch).cast("long").alias(BATCH)).repartition(self.buckets, self.key)
         .write.insertInto(self.table))
