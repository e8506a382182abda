"""Percent rank over a whole table without sorting the table in one task.

Rows are first counted per distinct value. The distinct values are cut into buckets that
hold at most ``BUCKET_VALUES`` of them by construction, ranked inside their bucket, and
shifted by the rows of the buckets ahead. Only the list of non-empty buckets is ordered in
one task. That list is short: k buckets need values whose absolute sum is at least
``width * k**2 / 4``, so total revenue of 10**14 allows fewer than a million buckets.
"""

from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F, types as T

BUCKET_VALUES = 100_000


class Tier(NamedTuple):
    """A label by percent rank of ``column``: the first step ``(limit, label)`` that fits.

    NULL is ranked last when descending and first when ascending.
    """

    column: str
    descending: bool
    steps: tuple = ()
    otherwise: object = None


def value_ranks(df: DataFrame, tiers: list[Tier]) -> DataFrame:
    """One row per ranked column and distinct value: column_name, value, n_rows, percent_rank.

    All columns are ranked in the same pass over ``df``. Values come back as decimals.
    """
    scale = max(_scale(df.schema[t.column].dataType) for t in tiers)
    width = format(Decimal(BUCKET_VALUES).scaleb(-scale), "f")
    entries = ", ".join(
        f"struct('{t.column}' AS column_name, CAST(`{t.column}` AS decimal(38,{scale})) AS value,"
        f" `{t.column}` IS {'' if t.descending else 'NOT '}NULL AS place,"
        f" {-1 if t.descending else 1} AS direction)" for t in tiers)
    per_value = (df.selectExpr(f"inline(array({entries}))")
                 .groupBy("column_name", "place", "direction", "value")
                 .agg(F.expr("count(*) AS n_rows"))
                 .selectExpr("*", f"floor(value / {width}) * direction AS bucket"))
    keys = ["column_name", "place", "bucket"]
    buckets = (per_value.groupBy(*keys).agg(F.expr("sum(n_rows) AS bucket_rows"))
               .selectExpr(*keys, "sum(bucket_rows) OVER (PARTITION BY column_name) AS total_rows",
                           """sum(bucket_rows) OVER (PARTITION BY column_name ORDER BY place, bucket
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS rows_before"""))
    in_bucket = """sum(n_rows) OVER (PARTITION BY column_name, place, bucket ORDER BY value * direction
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS rows_in_bucket"""
    same_bucket = F.expr("v.column_name = b.column_name AND v.place = b.place AND v.bucket <=> b.bucket")
    rows_ahead = "(coalesce(rows_in_bucket, 0) + coalesce(rows_before, 0))"
    return (per_value.selectExpr("*", in_bucket).alias("v").join(buckets.alias("b"), same_bucket)
            .selectExpr("v.column_name", "v.value", "v.n_rows",
                        f"if(total_rows > 1, {rows_ahead} / (total_rows - 1), 0D) AS percent_rank"))


def with_percent_rank(df: DataFrame, column: str, descending: bool,
                      name: str = "percent_rank") -> DataFrame:
    """Add the percent rank of every row."""
    ranks = value_ranks(df, [Tier(column, descending)]).select(
        F.col("value").cast(df.schema[column].dataType).alias("_value"), F.col("percent_rank").alias(name))
    return df.join(ranks, F.col(column).eqNullSafe(F.col("_value"))).drop("_value")


def with_tiers(df: DataFrame, tiers: dict[str, Tier]) -> DataFrame:
    """Add one label column per entry of ``tiers``.

    Percent rank moves in one direction with the value, so each limit is one cut-off value.
    All cut-offs are a single-row subquery and the rows themselves are not shuffled.
    """
    ranks = value_ranks(df, list(tiers.values()))
    cuts = ", ".join(_cuts(name, t) for name, t in tiers.items())
    bounds = ranks.agg(F.expr(f"struct({cuts})")).scalar()
    labels = [f"{_label(name, t)} AS `{name}`" for name, t in tiers.items()]
    return df.withColumn("_cuts", bounds).selectExpr("*", *labels).drop("_cuts")


def _cuts(name, tier):
    """The worst value inside each limit, and the rank that NULL has."""
    own = f"column_name = '{tier.column}'"
    worst = "min" if tier.descending else "max"
    cuts = [f"{worst}(value) FILTER (WHERE {own} AND percent_rank <= {limit}D) AS `{name}_{i}`"
            for i, (limit, _) in enumerate(tier.steps)]
    return ", ".join([*cuts, f"max(percent_rank) FILTER (WHERE {own} AND value IS NULL) AS `{name}_null`"])


def _label(name, tier):
    better = ">=" if tier.descending else "<="
    known = " ".join(f"WHEN `{tier.column}` {better} _cuts.`{name}_{i}` THEN {_literal(label)}"
                     for i, (_, label) in enumerate(tier.steps))
    unknown = " ".join(f"WHEN _cuts.`{name}_null` <= {limit}D THEN {_literal(label)}"
                       for limit, label in tier.steps)
    last = _literal(tier.otherwise)
    return (f"CASE WHEN `{tier.column}` IS NULL THEN CASE {unknown} ELSE {last} END"
            f" {known} ELSE {last} END")


def _literal(label):
    return f"'{label}'" if isinstance(label, str) else str(label)


def _scale(dtype):
    if isinstance(dtype, T.DecimalType):
        return dtype.scale
    if isinstance(dtype, T.IntegralType):
        return 0
    raise TypeError(f"percent rank needs a whole or decimal number, not {dtype.simpleString()}")
