"""Metrics on the golden fixture, value by value."""

from datetime import datetime

import golden
import pytest
from pyspark.sql import functions as F, types as T

from plateful import schemas
from plateful.operators import facts, ranking
from plateful.plans import batch, customers, sales, views
from plateful.plans.staging import checkpointed, lazy


@pytest.fixture(scope="module")
def tables(spark):
    return golden.items(spark).cache(), golden.options(spark).cache()


@pytest.mark.parametrize("stage", [lazy, checkpointed])
def test_customer_lifetime_value(tables, stage):
    assert golden.rows_of(customers.customer_lifetime_value(*tables, stage=stage)) == golden.CLV


def test_clv_percent_rank(tables):
    ranked = ranking.with_percent_rank(customers.customer_values(*tables), "customer_lifetime_value", True)
    assert {r.user_id: r.percent_rank for r in ranked.collect()} == golden.CLV_RANKS


@pytest.mark.parametrize("stage", [lazy, checkpointed])
def test_customer_segments(tables, stage):
    assert golden.rows_of(customers.customer_segments(tables[0], stage=stage)) == golden.SEGMENTS


def test_rfm_scores(tables):
    scores = customers.rfm_scores(tables[0])
    assert {r.user_id: (r.r_score, r.f_score, r.m_score) for r in scores.collect()} == golden.SCORES


def test_recency_reference_point_can_be_given(tables):
    later = F.lit("2024-01-12").cast("date")
    days = {r.user_id: r.recency_days for r in customers.customer_segments(tables[0], as_of=later).collect()}
    assert days["u1"] == 10 and days["u2"] == 55


def test_anonymous_customers_can_be_left_out(tables):
    assert {r.user_id for r in customers.customer_segments(tables[0], exclude_anonymous=True).collect()} == \
        {"u1", "u2", "u3", "u4"}
    assert {r.user_id for r in customers.customer_lifetime_value(*tables, exclude_anonymous=True).collect()} == \
        {"u1", "u2", "u3", "u4"}


def test_sales_trends(tables):
    rows = {(str(r.sales_date), r.sales_week, r.sales_hour, r.item_category, r.total_revenue, r.total_orders)
            for r in sales.sales_trends(tables[0]).collect()}
    assert rows == golden.TRENDS


def test_week_is_iso_and_year_is_calendar(spark):
    late = golden.items(spark, [("u", "o", datetime(2024, 12, 30, 23, 59, 59), "l", "1.00", 1, True, "Food", "r")])
    row = sales.sales_trends(late).first()
    assert (row.sales_year, row.sales_month, row.sales_week, row.sales_hour) == (2024, 12, 1, 23)


def test_loyalty_impact(tables):
    assert golden.rows_of(sales.loyalty_impact(tables[0])) == golden.LOYALTY


def test_loyalty_group_without_known_users(spark):
    one = golden.items(spark, [(None, "o1", None, "l1", "2.00", 1, True, "Food", "r1")])
    assert golden.rows_of(sales.loyalty_impact(one)) == {(True, golden.d("2.00"), 1, 0, None)}


def test_location_performance(tables):
    assert golden.rows_of(sales.location_performance(tables[0])) == golden.LOCATIONS


def test_discount_effectiveness(tables):
    assert golden.rows_of(sales.discount_effectiveness(*tables)) == golden.DISCOUNTS


def test_item_option_joins(tables):
    items, options = tables
    joined = {(r.lineitem_id, r.user_id, r.option_line_revenue) for r in facts.options_with_user(items, options).collect()}
    d = golden.d
    assert joined == {("l1", "u1", d("3.00")), ("l4", "u2", d("-5.00")), ("l6", "", d("0.50")), ("l7", None, d("9.00"))}


def test_customer_spend_equals_the_two_sums(tables):
    items, options = tables
    spend = {r.user_id: (r.total_item_spend, r.total_option_spend) for r in facts.customer_spend(items, options).collect()}
    by_item = {r.user_id: r.total_item_spend for r in facts.customer_item_spend(items).collect()}
    by_option = {r.user_id: r.total_option_spend for r in facts.customer_option_spend(items, options).collect()}
    zero = golden.d("0.00")
    assert spend == {u: (by_item[u], zero if u is None else by_option.get(u, zero)) for u in by_item}


def test_repeated_line_ids_count_their_options_once_per_user(spark):
    t = golden.ITEMS[0][2]
    items = golden.items(spark, [("a", "o1", t, "x", "1.00", 1, True, "Food", "r"),
                                 ("a", "o1", t, "x", "2.00", 1, True, "Food", "r"),
                                 ("b", "o2", t, "x", "4.00", 1, True, "Food", "r")])
    options = golden.options(spark, [("o1", "x", "0.50", 1), ("o1", "x", "0.25", 1)])
    d = golden.d
    assert golden.rows_of(facts.customer_spend(items, options)) == {
        ("a", d("3.00"), d("0.75")), ("b", d("4.00"), d("0.75"))}


@pytest.mark.parametrize("name", sorted(schemas.METRICS))
def test_output_contracts(tables, name):
    table = batch.metric_tables(*tables, stage=lazy)[name]
    want = T._parse_datatype_string(schemas.METRICS[name])
    assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in want]


def test_empty_tables_give_empty_metrics_and_views(spark):
    items, options = golden.items(spark, []), golden.options(spark, [])
    tables = batch.metric_tables(items, options)
    assert all(t.count() == 0 for t in tables.values())
    shown = [views.segment_counts(tables["customer_segments"]), views.churn_counts(tables["customer_segments"]),
             views.customer_roster(tables["customer_segments"]),
             views.revenue_timeline(tables["sales_trends"], ["Food"]), views.hourly_demand(tables["sales_trends"]),
             views.loyalty_comparison(tables["loyalty_impact"]),
             views.location_league(tables["location_performance"]),
             views.discount_comparison(tables["discount_effectiveness"])]
    assert all(v.count() == 0 for v in shown)


def test_views(tables):
    items, options = tables
    metrics = batch.metric_tables(items, options)
    segments = metrics["customer_segments"]
    assert [tuple(r) for r in views.segment_counts(segments).collect()] == [("Regular Customer", 5), ("VIP", 1)]
    assert [tuple(r) for r in views.churn_counts(segments).collect()] == [("Active", 5), ("At Risk", 1)]
    assert [r.user_id for r in views.customer_roster(segments, 2).collect()] == ["u3", "u2"]
    timeline = views.revenue_timeline(metrics["sales_trends"])
    assert timeline.columns == ["sales_date", "Drink", "Food"]
    assert [tuple(r) for r in timeline.collect()] == [
        ("2023-11-17", 0.0, 7.0), ("2023-11-18", 0.0, 30.0), ("2024-01-01", 7.0, 20.0), ("2024-01-02", 0.0, 11.0)]
    cells = timeline.select(F.col("Drink") + F.col("Food")).groupBy().sum().first()[0]
    known = metrics["sales_trends"].filter("item_category IS NOT NULL").agg(F.sum("total_revenue")).first()[0]
    assert cells == float(known)
    listed = views.revenue_timeline(metrics["sales_trends"], ["Food", "Soup"])
    assert listed.columns == ["sales_date", "Food", "Soup", views.OTHER_CATEGORIES]
    assert [tuple(r)[1:] for r in listed.collect()][2] == (20.0, 0.0, 7.0)
    assert [tuple(r) for r in views.hourly_demand(metrics["sales_trends"]).collect()] == [
        (0, 1), (8, 1), (9, 1), (10, 1), (12, 2), (23, 2)]
    assert {r.is_loyalty for r in views.loyalty_comparison(metrics["loyalty_impact"]).collect()} == \
        {"Loyalty Member", "Standard Guest"}
    assert [r.restaurant_id for r in views.location_league(metrics["location_performance"]).collect()] == ["r1", "r2"]
    assert {r.is_discounted for r in views.discount_comparison(metrics["discount_effectiveness"]).collect()} == \
        {"Promo Applied", "Full Price Purchase"}
