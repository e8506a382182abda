"""The batch run: text or database to landed tables, landed tables to metric tables and views."""

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F

from plateful import schemas
from plateful.operators.audit import CHECKS, audit_landed, with_checks
from plateful.operators.facts import item_facts, order_summary
from plateful.operators.keys import with_dense_id
from plateful.plans import customers, sales, views
from plateful.plans.staging import checkpointed, exists, lazy, remove_folder
from plateful.sinks.tables import land_tables, publish_folder, write_staged, write_table
from plateful.sources.jdbc import read_jdbc
from plateful.sources.tables import read_metric, read_raw
from plateful.sources.text import FILE_ORDER, MALFORMED, RULES, read_text

STATUS, LANDED, REJECTED = "load_status", "landed", "rejected"


class Landed(NamedTuple):
    """Where a table was landed and what arrived.

    ``parse_failures`` are fields that could not be read, ``malformed_rows`` lines with too few or too many fields.
    """

    path: str
    row_count: int
    distinct_keys: int
    null_keys: int
    parse_failures: int
    malformed_rows: int = 0


def land_text(spark: SparkSession, paths: dict[str, str], raw_base: str, *, strict: bool = False,
              **how) -> dict[str, Landed]:
    """Clean the named text files, replace their landed tables and report on each.

    The text is read once: the counts of the report are observed while the rows are written. Lines with too
    few or too many fields are landed all the same, padded or cut, and kept as they came in
    ``<table>_rejects`` (:func:`read_rejects`). Spark may count rows twice that a lost executor
    made it read again; ``load_audit`` counts anew.
    """
    return {table: land_text_table(spark, path, table, raw_base, strict=strict, **how) for table, path in paths.items()}


def land_text_table(spark: SparkSession, path, table: str, raw_base: str, *, strict: bool = False, **how) -> Landed:
    seen, kept = Observation(), Observation()
    text = with_checks(table, read_text(spark, path, table, malformed=True, **how))
    is_bad = F.col(MALFORMED).isNotNull()
    text = text.observe(seen, F.count(F.lit(1)).alias("rows"), *[
        F.coalesce(F.sum(c.cast("bigint")), F.lit(0)).alias(name)
        for name, c in (("no_key", F.col("_no_key")), ("unread", F.col("_unread")), ("malformed", is_bad))])
    rows = with_rejects(text, table, strict)
    rows = rows.observe(kept, F.count_if(F.col(STATUS) == LANDED).alias("rows"))
    staged = write_staged(rows, raw_base, table, [STATUS])
    landed = f"{staged}/{STATUS}={LANDED}"
    if not exists(spark, landed):           # not a single row
        declared_rows = spark.createDataFrame([], schemas.RAW_TABLES[table])
        declared_rows.write.parquet(landed)
    place = publish_folder(spark, landed, raw_base, table)
    rejects = f"{staged}/{STATUS}={REJECTED}"
    if exists(spark, rejects):
        publish_folder(spark, rejects, raw_base, f"{table}_rejects")
    else:
        remove_folder(spark, f"{raw_base.rstrip('/')}/{table}_rejects")
    remove_folder(spark, staged)
    counts = seen.get
    keys = kept.get["rows"] if RULES[table][1] else read_raw(spark, raw_base, table).agg(F.countDistinct(CHECKS[table][0])).first()[0]
    return Landed(place, counts["rows"], keys, counts["no_key"], counts["unread"], counts["malformed"])


def with_rejects(text: DataFrame, table: str, strict: bool) -> DataFrame:
    """The rows to land and, beside them, a copy of every malformed line, told apart by ``STATUS``.

    The copies are put in before the first row of each key is taken, each as a key of its own, so one
    read and one exchange serve both.
    """
    clean, key = RULES[table]
    columns = [*schemas.RAW_TABLES[table].names, MALFORMED, "_file", STATUS]
    both = F.when(F.col(MALFORMED).isNull(), F.array(F.lit(LANDED))).otherwise(F.array(F.lit(LANDED), F.lit(REJECTED)))
    if key is None:
        return with_dense_id(clean(text, strict)).withColumn(STATUS, F.explode(both)).select(*columns)
    typed = clean(text, strict).withColumn(STATUS, F.explode(both))
    rejected = F.col(STATUS) == REJECTED
    alone = F.when(rejected, F.concat_ws("/", *FILE_ORDER))
    first = Window.partitionBy(key, STATUS, alone).orderBy(*FILE_ORDER)
    return (typed.filter(F.col(key).isNotNull() | rejected).withColumn("_nth", F.row_number().over(first))
            .filter("_nth = 1").select(*columns))


def read_rejects(spark: SparkSession, raw_base: str, table: str) -> DataFrame:
    """The lines of the last load with too few or too many fields: file and line."""
    path = f"{raw_base.rstrip('/')}/{table}_rejects"
    if not exists(spark, path):
        return spark.createDataFrame([], "file string, line string")
    rows = spark.read.schema(f"_file string, {MALFORMED} string").parquet(path)
    return rows.select(F.col("_file").alias("file"), F.col(MALFORMED).alias("line"))


def land_jdbc(spark: SparkSession, url: str, properties: dict, raw_base: str, *, partitions: int,
              tables=tuple(schemas.RAW_TABLES), predicates: dict[str, list[str]] | None = None) -> dict[str, Landed]:
    """Copy raw tables from a database into landed tables and report on each.

    Each is read in ``partitions`` ranges of its split column, or by its own ``predicates``.
    """
    read = {t: declared(read_jdbc(spark, url, t, properties, partitions=partitions,
                                  predicates=(predicates or {}).get(t)), t) for t in tables}
    return {table: Landed(path, *audit_landed(table, read_raw(spark, raw_base, table)).first()[1:])
            for table, path in land_tables(read, raw_base).items()}


def declared(df: DataFrame, table: str) -> DataFrame:
    """The declared columns of a raw table in their declared types."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schemas.RAW_TABLES[table].fields])


def metric_tables(items: DataFrame, options: DataFrame, *, exclude_anonymous=False,
                  stage=lazy) -> dict[str, DataFrame]:
    """All six metric tables. The items are read twice: for lifetime value and for the facts of the rest.

    ``exclude_anonymous`` leaves blank and missing users out of the two customer tables; the
    other four count all sales.
    """
    lines = stage(item_facts(items))
    orders = stage(order_summary(lines))
    return {
        "customer_lifetime_value": customers.customer_lifetime_value(
            items, options, exclude_anonymous=exclude_anonymous, stage=stage),
        "customer_segments": customers.customer_segments(
            lines, orders=orders, exclude_anonymous=exclude_anonymous, stage=stage),
        "sales_trends": sales.sales_trends(lines),
        "loyalty_impact": sales.loyalty_impact(lines),
        "location_performance": sales.location_performance(lines),
        "discount_effectiveness": sales.discount_effectiveness(lines, options, orders=orders),
    }


def run_metrics(spark: SparkSession, raw_base: str, metrics_base: str, **how) -> dict[str, str]:
    """Read the landed tables and replace all metric tables. Facts that several share are written once."""
    items = read_raw(spark, raw_base, "order_items_raw")
    options = read_raw(spark, raw_base, "order_item_options_raw")
    return land_tables(metric_tables(items, options, stage=checkpointed, **how), metrics_base)


VIEWS = {
    "segment_counts": (views.segment_counts, "customer_segments"),
    "churn_counts": (views.churn_counts, "customer_segments"),
    "customer_roster": (views.customer_roster, "customer_segments"),
    "revenue_timeline": (views.revenue_timeline, "sales_trends"),
    "revenue_cells": (views.revenue_cells, "sales_trends"),
    "hourly_demand": (views.hourly_demand, "sales_trends"),
    "loyalty_comparison": (views.loyalty_comparison, "loyalty_impact"),
    "location_league": (views.location_league, "location_performance"),
    "discount_comparison": (views.discount_comparison, "discount_effectiveness"),
}


def run_views(spark: SparkSession, metrics_base: str, views_base: str) -> dict[str, str]:
    """Replace the nine views from the stored metric tables; no metric is computed again."""
    return {name: write_table(view(read_metric(spark, metrics_base, metric)), views_base, name)
            for name, (view, metric) in VIEWS.items()}
