"""Columnar tables by name."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from plateful import schemas


def read_raw(spark: SparkSession, base: str, table: str, day: str | None = None, days: list[str] | None = None) -> DataFrame:
    """A landed raw table with its declared schema; a missing folder raises.

    ``day``, or each of ``days``, reads only these days of a table landed in day folders.
    """
    schema = schemas.RAW_TABLES[table]
    rows = spark.read.schema(schema).parquet(f"{base.rstrip('/')}/{table}")
    if day is not None or days is not None:
        wanted = [F.lit(d).cast("date") for d in (days if day is None else [day])]
        rows = rows.filter(F.col(schemas.DAY_FOLDERS[table][0]).isin(wanted))
    return rows.select(*schema.names)


def read_metric(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A metric table with its contract schema; unknown or missing tables raise."""
    if name not in schemas.METRICS:
        raise KeyError(f"unknown metric table {name!r}, expected one of {sorted(schemas.METRICS)}")
    rows = spark.read.schema(schemas.METRICS[name]).parquet(f"{base.rstrip('/')}/{name}")
    return rows.select(*T.StructType.fromDDL(schemas.METRICS[name]).names)
