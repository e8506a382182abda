"""Full-refresh writes and catalog tables."""

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from plateful import schemas
from plateful.plans.staging import exists, move_folder, remove_folder

# Table property with the folder that a reloaded catalog table had before.
PREVIOUS = "plateful.previous_place"

# Metric tables split into folders, so a reader of some months skips the rest.
FOLDERS = {"sales_trends": ["sales_year", "sales_month"]}


def write_table(df: DataFrame, base: str, name: str) -> str:
    """Replace the folder ``base/name`` with ``df``; running it again gives the same table.

    The rows are written beside the table and moved into its place when they are complete, so a write
    that fails leaves the old rows as they were, and ``df`` may read the table that it replaces.
    """
    return publish_folder(df.sparkSession, write_staged(df, base, name), base, name)


def write_staged(df: DataFrame, base: str, name: str, first_folders: list[str] = ()) -> str:
    """Write ``df`` in the layout of table ``name`` to a new folder, which goes again if that fails."""
    path = f"{base.rstrip('/')}/_staged/{name}-{uuid4().hex}"
    folders = [*first_folders, *FOLDERS.get(name, [])]
    if name in schemas.DAY_FOLDERS:
        day, time = schemas.DAY_FOLDERS[name]
        df, folders = df.withColumn(day, F.to_date(time)), [*folders, day]
    if folders:
        # One task per folder, uneven folders split, instead of every task writing to each one.
        df = df.hint("rebalance", *folders)
    try:
        df.write.partitionBy(*folders).parquet(path)
    except Exception:
        remove_folder(df.sparkSession, path)
        raise
    return path


def publish_folder(spark: SparkSession, staged: str, base: str, name: str) -> str:
    """Move a complete folder into the place of ``base/name``. If the move fails the old folder is put back.

    Between the two renames there is no table for a moment; who must never see that reads a catalog table
    (:func:`reload_raw_table`), whose place changes in one step.
    """
    base = base.rstrip("/")
    path, old = f"{base}/{name}", f"{base}/_replaced/{name}-{uuid4().hex}"
    had = exists(spark, path)
    if had:
        move_folder(spark, path, old)
    try:
        move_folder(spark, staged, path)
    except Exception:
        if had:
            move_folder(spark, old, path)
        raise
    if had:
        remove_folder(spark, old)
    return path


def land_tables(tables: dict[str, DataFrame], base: str) -> dict[str, str]:
    """Write each named table; every table is one distributed job."""
    return {name: write_table(df, base, name) for name, df in tables.items()}


def write_snapshot(df: DataFrame, base: str, name: str, day_column: str = "as_of_date") -> str:
    """Add or replace the days in ``df`` and keep the other days of the table."""
    path = f"{base.rstrip('/')}/{name}"
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(day_column).parquet(path))
    return path


def create_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")


def create_raw_table(spark: SparkSession, database: str, table: str, *, bucket_by: str | None = None,
                     buckets: int = 0) -> None:
    """Create an empty typed table if absent.

    With ``bucket_by`` rows are kept hashed by that column, so joins and aggregations on it
    need no shuffle: ``lineitem_id`` for lifetime value, ``order_id`` for order summaries and
    discount flags.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.RAW_TABLES[table].fields)
    clustering = f" CLUSTERED BY (`{bucket_by}`) INTO {buckets} BUCKETS" if bucket_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{table}` ({columns}) USING parquet{clustering}")


def reload_raw_table(df: DataFrame, database: str, table: str) -> None:
    """Replace all rows of a catalog table and keep its definition.

    The rows are written to a new folder of the same layout; when they are complete, one catalog step makes
    it the table's. A write that fails leaves the table as it was. The folder before stays for
    queries that still read it, until the next reload.
    """
    spark, name, staged = df.sparkSession, f"`{database}`.`{table}`", f"{table}_{uuid4().hex}"
    place = table_place(spark, database, table)
    path = f"{place.rpartition('/')[0]}/{staged}"
    spark.sql(f"CREATE TABLE `{database}`.`{staged}` LIKE {name} USING parquet LOCATION '{path}'")
    try:
        df.select(*schemas.RAW_TABLES[table].names).write.insertInto(f"`{database}`.`{staged}`")
    except Exception:
        remove_folder(spark, path)
        raise
    finally:
        spark.sql(f"DROP TABLE `{database}`.`{staged}`")        # its folder stays, as the place was named
    before = spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key") == PREVIOUS).collect()
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{PREVIOUS}' = '{place}')")
    for row in before:
        remove_folder(spark, row["value"])


def table_place(spark: SparkSession, database: str, table: str) -> str:
    """The folder of a catalog table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED `{database}`.`{table}`").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")
