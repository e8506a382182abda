"""States that are merged day by day, against the same figures from all rows."""

import random
from datetime import datetime
from decimal import Decimal

import golden
import pytest
from pyspark.sql import functions as F

from plateful import queries
from plateful.operators import distinct, rank_store, ranking
from plateful.plans import increments, sales
from plateful.plans.staging import folders
from plateful.sinks.tables import land_tables
from plateful.sources.tables import read_metric, read_raw


def sale(draw, day):
    return (draw.choice(["r1", "r2", None]), draw.choice([True, False, None]), draw.choice([f"o{draw.randrange(30)}", None]),
            draw.choice(["", "", "u1", f"u{draw.randrange(50)}", None]), draw.choice([None, Decimal("2.50"), Decimal("0.99")]),
            draw.choice([1, 2, None]), day)


SALES = "restaurant_id string, is_loyalty boolean, order_id string, user_id string, item_price decimal(10,2), item_quantity int, day int"


@pytest.mark.parametrize("seed", [1, 2])
def test_merged_days_equal_all_sales(spark, seed):
    """Orders and customers come again on other days, are missing, or one holds a third of all rows."""
    draw = random.Random(seed)
    rows = spark.createDataFrame([sale(draw, day) for day in range(3) for _ in range(150)], SALES)
    orders = users = None
    loyalty, location = [], []
    for day in range(3):
        lines = rows.filter(F.col("day") == day)
        orders = distinct.extended_ids(lines, "order_id", orders, ["restaurant_id"])
        users = distinct.extended_ids(lines, "user_id", users)
        loyalty.append(increments.group_state(lines, "is_loyalty", orders, users))
        location.append(increments.group_state(lines, "restaurant_id", orders))
        until = rows.filter(F.col("day") <= day)
        assert (golden.rows_of(increments.loyalty_impact_of(increments.merged(loyalty)))
                == golden.rows_of(sales.loyalty_impact(until)))
        assert (golden.rows_of(increments.location_performance_of(increments.merged(location)))
                == golden.rows_of(sales.location_performance(until)))
    assert increments.loyalty_impact_of(loyalty[0]).schema.simpleString() == sales.loyalty_impact(rows).schema.simpleString()
    assert increments.location_performance_of(location[0]).schema.simpleString() == sales.location_performance(rows).schema.simpleString()


@pytest.mark.parametrize("name, group", [("loyalty_impact", "is_loyalty"), ("location_performance", "restaurant_id")])
def test_merged_queries_make_each_line_once(spark, monkeypatch, name, group):
    """Ids, sums and sets of both spans read the written lines, not the joins that made them. Lines without a time are in no span."""
    draw, made = random.Random(3), spark.sparkContext.accumulator(0)
    days = [datetime(1994, 5, 1), datetime(1995, 1, 1), datetime(1996, 5, 1), None]
    rows = [sale(draw, day) for day in days for _ in range(40)]
    lines = spark.createDataFrame(rows, SALES.replace("day int", "creation_time_utc timestamp_ntz"))

    @F.udf("string")
    def seen(order):
        made.add(1)
        return order

    monkeypatch.setattr(queries, "items", lambda spark, sf, *columns: lines.withColumn("order_id", seen("order_id")).select(*columns))
    found = golden.rows_of(getattr(queries, f"{name}_merged")(spark, "unused"))
    assert found == golden.rows_of(getattr(sales, name)(lines.filter("creation_time_utc IS NOT NULL")))
    assert made.value <= len(rows)
    folder = spark.conf.get("spark.checkpoint.dir")
    assert not [f for f in folders(spark, folder) if f.startswith("lines-")]


def test_ids_are_dense_and_go_on(spark):
    values = spark.createDataFrame([(f"v{i % 70}", i % 7) for i in range(300)] + [(None, 1)], "v string, g int")
    first = distinct.extended_ids(values.filter("g < 3"), "v", None, ["g"])
    both = distinct.extended_ids(values, "v", first, ["g"])
    assert sorted(r.dense_id for r in both.collect()) == list(range(70))
    assert golden.rows_of(first) <= golden.rows_of(both)
    again = distinct.extended_ids(values, "v", both)
    assert golden.rows_of(again) == golden.rows_of(both)


def test_sets_over_several_ranges_merge_and_merging_twice_changes_nothing(spark):
    ids = spark.range(100_000).selectExpr("id AS v", f"id AS {distinct.ID}")
    one, two = (distinct.distinct_state(spark.range(a, b, step).selectExpr("id AS v", "id % 2 AS g"), ["g"], "v", ids)
                for a, b, step in ((0, 70_000, 1), (50_000, 100_000, 3)))
    assert one.count() > 2
    merged = distinct.merged_states([one, two, one, two], ["g"])
    expected = {g: len({x for x in [*range(0, 70_000), *range(50_000, 100_000, 3)] if x % 2 == g}) for g in (0, 1)}
    assert {r.g: r.n for r in distinct.distinct_counts(merged, ["g"], "n").collect()} == expected


def test_ids_are_shuffled_and_no_partial_bitmaps(spark):
    ids = spark.range(1000).selectExpr("id AS v", f"id AS {distinct.ID}")
    state = distinct.distinct_state(spark.range(1000).selectExpr("id AS v", "id % 9 AS g"), ["g"], "v", ids)
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan
    assert "Exchange" not in plan[:plan.index("partial_bitmap_construct_agg")]


VALUES = "user_id string, value decimal(12,2)"


def values_of(draw, n):
    return {f"u{i}": draw.choice([None, Decimal(draw.randrange(-300, 900)) / 100, Decimal("1.00")]) for i in range(n)}


@pytest.mark.parametrize("descending", [True, False])
def test_ranks_after_changes_equal_ranks_of_all_rows(spark, tmp_path, descending):
    draw = random.Random(5)
    store = rank_store.RankStore(str(tmp_path), 2, descending, bucket_values=50)
    before, known = spark.createDataFrame([], VALUES), {}
    for version in range(4):
        known = {**known, **dict(draw.sample(sorted(values_of(draw, 40 + 30 * version).items()), 25))}
        after = spark.createDataFrame([*known.items()], VALUES)
        for _ in range(2):          # the second time as after a failure
            rank_store.apply_changes(spark, store, rank_store.changes(before, after, "user_id", "value"), version)
        found = golden.rows_of(rank_store.with_percent_rank(after, store, version, "value"))
        assert found == golden.rows_of(ranking.with_percent_rank(after, "value", descending))
        before = after
    assert folders(spark, f"{tmp_path}/totals") == ["version=2", "version=3"]


def test_a_change_reads_and_writes_only_the_buckets_it_touches(spark, tmp_path):
    store = rank_store.RankStore(str(tmp_path), 2, True, bucket_values=100)
    many = spark.range(1000).selectExpr("concat('u', id) AS user_id", "CAST(id AS decimal(12,2)) AS value")
    rank_store.apply_changes(spark, store, rank_store.changes(many.limit(0), many, "user_id", "value"), 0)
    old = many.filter("value IN (17, 523)")
    new = old.withColumn("value", F.col("value") + F.lit(Decimal("0.50")))
    rank_store.apply_changes(spark, store, rank_store.changes(old, new, "user_id", "value"), 1)
    assert folders(spark, f"{tmp_path}/counts/version=1") == ["bucket=17", "bucket=523"]
    read = rank_store.touched_counts(spark, store, [("17", 0), ("523", 0)])
    assert {f.split("counts/")[1].rsplit("/", 1)[0] for f in read.inputFiles()} == {"version=0/bucket=17", "version=0/bucket=523"}
    everyone = many.join(old, "user_id", "left_anti").unionByName(new)
    assert (golden.rows_of(rank_store.with_percent_rank(everyone, store, 1, "value"))
            == golden.rows_of(ranking.with_percent_rank(everyone, "value", True)))


def test_trends_are_refreshed_by_day(spark, tmp_path):
    """A late line and a new day change their days only; the other folders are not written again."""
    raw, metrics = str(tmp_path / "raw"), str(tmp_path / "metrics")
    more = golden.ITEMS + [("u2", "o8", datetime(2024, 1, 1, 5, 0), "l20", "3.00", 2, False, "Food", "r1"),
                           ("u2", "o9", datetime(2024, 2, 1, 5, 0), "l21", "1.00", 1, False, "Soup", "r1")]
    land_tables({"order_items_raw": golden.items(spark)}, raw)
    land_tables({"sales_trends": sales.sales_trends(golden.items(spark))}, metrics)
    old = {p: p.stat().st_mtime_ns for p in (tmp_path / "metrics").rglob("sales_month=11/*.parquet")}
    land_tables({"order_items_raw": golden.items(spark, more)}, raw)
    for _ in range(2):
        increments.refresh_trends(spark, raw, metrics, ["2024-01-01", "2024-02-01", "2024-01-01"])
        assert golden.rows_of(read_metric(spark, metrics, "sales_trends")) == golden.rows_of(sales.sales_trends(golden.items(spark, more)))
    assert old and all(p.stat().st_mtime_ns == t for p, t in old.items())
    plan = read_raw(spark, raw, "order_items_raw", days=["2024-01-01"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(creation_day" in plan
