"""Discount depth and calendars on small hand-made sales."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import golden

from plateful.plans import extensions


def sales(spark, rows):
    """(time, revenue) rows as order items."""
    return golden.items(spark, [("u", "o", t, f"l{i}", str(v), 1, True, "c", "r") for i, (t, v) in enumerate(rows)])


def test_depths_are_exact_quantiles(spark):
    lines = [("u", "o", None, f"l{i}", "10.00", 1, True, "c", "r1") for i in range(10)]
    lines += [("u", "o", None, "m1", "3.00", 1, True, "c", "r2"), ("u", "o", None, "m2", None, 1, True, "c", "r2"),
              ("u", "o", None, "m3", "0.00", 1, True, "c", None), ("u", "o", None, "m4", "9.00", 1, True, "c", "r3")]
    options = [("o", f"l{i}", f"-{i + 1}.00", 1) for i in range(10)] + [("o", "l0", "5.00", 1)]
    options += [("o", "m1", "-0.50", 1), ("o", "m1", "-0.25", 2), ("o", "m2", "-1.00", 1), ("o", "m3", "-1.00", 1), ("o", "none", "-1.00", 1)]
    found = extensions.discount_depth(golden.items(spark, lines), golden.options(spark, options))
    d = golden.d
    assert golden.rows_of(found) == {("r1", 10, d("50.00"), d("90.00")), ("r2", 2, d("33.33"), d("33.33")), (None, 1, None, None)}


def test_a_week_without_sales_is_in_the_calendar(spark):
    rows = [(datetime(2024, 1, 1, 9), 10), (datetime(2024, 1, 7, 23, 59), 5), (datetime(2024, 1, 15), 4), (None, 99)]
    found = [tuple(r) for r in extensions.period_calendar(sales(spark, rows)).filter("period_kind = 'week'").orderBy("period_start").collect()]
    d = golden.d
    assert found == [("week", date(2024, 1, 1), d("15.00"), None, None),
                     ("week", date(2024, 1, 8), d("0.00"), d("15.00"), d("-15.00")),
                     ("week", date(2024, 1, 15), d("4.00"), d("0.00"), d("4.00"))]
    days = extensions.daily_calendar(sales(spark, rows)).collect()
    assert len(days) == 15 and sum(r.revenue for r in days) == 19


def test_season_index_against_plain_python(spark):
    start = date(2023, 1, 1)
    revenue = {start + timedelta(i): Decimal(100 + 50 * ((start + timedelta(i)).weekday() == 4) + i % 3) for i in range(800) if i % 11}
    rows = [(datetime(x.year, x.month, x.day, 12), v) for x, v in revenue.items()]
    found = {(r.season_kind, r.season_value): r for r in extensions.seasonal_index(sales(spark, rows)).collect()}
    first, last = min(revenue), max(revenue)
    every = [revenue.get(first + timedelta(i), Decimal(0)) for i in range((last - first).days + 1)]
    own, around = Decimal(0), Decimal(0)
    for i in range(3, len(every) - 3):
        if (first + timedelta(i)).weekday() == 4:
            own, around = own + every[i], around + sum(every[i - 3:i + 4])
    friday = found["weekday", "Friday"]
    assert friday.total_revenue == own and friday.season_index == float(own * 7) / float(around)
    months = {}
    for i, v in enumerate(every):
        x = first + timedelta(i)
        months[x.year, x.month] = months.get((x.year, x.month), 0) + v
    ordered = [months[k] for k in sorted(months)]
    at = [i for i, k in enumerate(sorted(months)) if k[1] == 8 and 6 <= i < len(ordered) - 6]
    own = sum(ordered[i] for i in at)
    around = sum(sum(ordered[i - 6:i + 6]) + sum(ordered[i - 5:i + 7]) for i in at)
    assert found["month", "8"].season_index == float(own * 24) / float(around)
    assert found["month", "8"].n_periods == len(at) > 0


def test_no_sales_give_no_rows(spark):
    none = sales(spark, [(None, 1)])
    for table in (extensions.period_calendar(none), extensions.seasonal_index(none), extensions.daily_calendar(none),
                  extensions.discount_depth(none, golden.options(spark, []))):
        assert table.count() == 0
