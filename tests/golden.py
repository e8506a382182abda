"""A small order history with the awkward cases: blank and missing users, missing price,
orphan option, discount, midnight, the 45-day limit, rank ties."""

from datetime import datetime
from decimal import Decimal

from plateful.schemas import ORDER_ITEM_OPTIONS, ORDER_ITEMS


def d(text):
    return None if text is None else Decimal(text)


# user, order, time, line, price, quantity, loyal, category, restaurant
ITEMS = [
    ("u1", "o1", datetime(2024, 1, 1, 23, 50), "l1", "10.00", 2, True, "Food", "r1"),
    ("u1", "o1", datetime(2024, 1, 1, 23, 50), "l2", "5.00", 1, True, "Drink", "r1"),
    ("u1", "o2", datetime(2024, 1, 2, 0, 10), "l3", "8.00", 1, True, "Food", "r2"),
    ("u2", "o3", datetime(2023, 11, 18, 12, 0), "l4", "30.00", 1, False, "Food", "r1"),
    ("u3", "o4", datetime(2023, 11, 17, 12, 0), "l5", "7.00", 1, False, "Food", "r2"),
    ("", "o5", datetime(2024, 1, 2, 8, 0), "l6", "1.00", 3, False, "Food", "r2"),
    (None, "o6", datetime(2024, 1, 1, 9, 0), "l7", "2.00", 1, False, "Drink", "r2"),
    ("u4", "o7", datetime(2024, 1, 1, 10, 0), "l8", None, 1, False, None, "r2"),
]

# order, line, price, quantity
OPTIONS = [
    ("o1", "l1", "1.50", 2),
    ("o3", "l4", "-5.00", 1),
    ("o5", "l6", "0.50", 1),
    ("o6", "l7", "9.00", 1),
    ("o9", "l9", "4.00", 1),
]


def items(spark, rows=ITEMS):
    full = [("app", restaurant, time, order, user, None, loyal, "USD", line, category, "item", d(price), quantity)
            for user, order, time, line, price, quantity, loyal, category, restaurant in rows]
    return spark.createDataFrame(full, ORDER_ITEMS)


def options(spark, rows=OPTIONS):
    full = [(order, line, "group", "option", d(price), quantity, i)
            for i, (order, line, price, quantity) in enumerate(rows)]
    return spark.createDataFrame(full, ORDER_ITEM_OPTIONS)


def rows_of(df):
    return {tuple(r) for r in df.collect()}


CLV = {
    ("u1", d("36.00"), "High CLV"),
    ("u2", d("25.00"), "High CLV"),
    ("u3", d("7.00"), "Medium CLV"),
    ("", d("3.50"), "Medium CLV"),
    (None, d("2.00"), "Medium CLV"),
    ("u4", None, "Low CLV"),
}

CLV_RANKS = {"u1": 0.0, "u2": 0.2, "u3": 0.4, "": 0.6, None: 0.8, "u4": 1.0}

SEGMENTS = {
    ("u1", 0, 2, d("33.00"), 1.0, "VIP", "Active"),
    ("u2", 45, 1, d("30.00"), 0.0, "Regular Customer", "Active"),
    ("u3", 46, 1, d("7.00"), 0.0, "Regular Customer", "At Risk"),
    ("", 0, 1, d("3.00"), 0.0, "Regular Customer", "Active"),
    (None, 1, 1, d("2.00"), 0.0, "Regular Customer", "Active"),
    ("u4", 1, 1, None, 0.0, "Regular Customer", "Active"),
}

SCORES = {"u1": (5, 5, 5), "u2": (2, 5, 5), "u3": (1, 5, 4), "": (5, 5, 3), None: (4, 5, 2), "u4": (4, 5, 1)}

# date, week, hour, category, revenue, orders
TRENDS = {
    ("2023-11-17", 46, 12, "Food", d("7.00"), 1),
    ("2023-11-18", 46, 12, "Food", d("30.00"), 1),
    ("2024-01-01", 1, 9, "Drink", d("2.00"), 1),
    ("2024-01-01", 1, 10, None, None, 1),
    ("2024-01-01", 1, 23, "Drink", d("5.00"), 1),
    ("2024-01-01", 1, 23, "Food", d("20.00"), 1),
    ("2024-01-02", 1, 0, "Food", d("8.00"), 1),
    ("2024-01-02", 1, 8, "Food", d("3.00"), 1),
}

LOYALTY = {(True, d("11.00"), 2, 1, d("33.00")), (False, d("10.50"), 5, 4, d("10.50"))}
LOCATIONS = {("r1", d("55.00"), 2, d("18.33")), ("r2", d("20.00"), 5, d("5.00"))}
DISCOUNTS = {(True, 1, d("30.00"), d("30.00")), (False, 6, d("45.00"), d("9.00"))}
