"""The registered queries as SQL over the test tables, for an independent engine.

Rounded averages are computed in whole cents, because dividing doubles differs from decimal
half-up rounding on exact half cents.
"""

_ITEMS = """
items AS (
  SELECT o.o_orderpriority AS app_name, CAST(l.l_suppkey AS VARCHAR) AS restaurant_id,
    o.o_orderdate + to_hours(CAST(o.o_orderkey % 24 AS INTEGER)) AS creation_time_utc,
    CAST(o.o_orderkey AS VARCHAR) AS order_id, CAST(o.o_custkey AS VARCHAR) AS user_id,
    CAST(NULL AS VARCHAR) AS printed_card_number,
    c.c_mktsegment IN ('BUILDING', 'HOUSEHOLD') AS is_loyalty, 'USD' AS currency,
    concat_ws('-', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey) AS lineitem_id,
    p.p_type AS item_category, p.p_name AS item_name,
    CAST(p.p_retailprice AS DECIMAL(10,2)) AS item_price, CAST(l.l_quantity AS INTEGER) AS item_quantity,
    CAST(p.p_retailprice AS DECIMAL(10,2)) * CAST(l.l_quantity AS INTEGER) AS rev,
    l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_shipdate, l.l_extendedprice, o.o_custkey
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN part p ON l.l_partkey = p.p_partkey)"""

_OPTIONS = """
option_src AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS lineitem_id,
    CAST(p_retailprice AS DECIMAL(10,2)) AS price, l_tax, l_discount, l_linenumber
  FROM lineitem JOIN part ON l_partkey = p_partkey),
options AS (
  SELECT order_id, lineitem_id, 'addon' AS option_group_name, 'tax' AS option_name,
    CAST(round(price * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(10,2)) AS option_price,
    CAST(l_linenumber AS INTEGER) AS option_quantity
  FROM option_src WHERE l_tax > 0
  UNION ALL
  SELECT order_id, lineitem_id, 'promo', 'discount',
    CAST(-round(price * CAST(l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(10,2)), 1
  FROM option_src WHERE l_discount >= 0.09)"""

_SPEND = _ITEMS + "," + _OPTIONS + """,
owner AS (SELECT DISTINCT lineitem_id, user_id FROM items),
item_spend AS (SELECT user_id, sum(rev) AS spend FROM items GROUP BY user_id),
option_spend AS (SELECT user_id, sum(option_price * option_quantity) AS spend
  FROM options JOIN owner USING (lineitem_id) GROUP BY user_id)"""

_CLV = _SPEND + """,
clv AS (SELECT i.user_id, i.spend + coalesce(o.spend, 0) AS value
  FROM item_spend i LEFT JOIN option_spend o ON i.user_id = o.user_id),
ranked AS (SELECT *, percent_rank() OVER (ORDER BY value DESC NULLS LAST) AS pr FROM clv)"""

_TIER = "CASE WHEN pr <= 0.2 THEN 'High CLV' WHEN pr <= 0.8 THEN 'Medium CLV' ELSE 'Low CLV' END"

_ORDERS = _ITEMS + """,
order_rows AS (SELECT user_id, order_id, creation_time_utc, sum(rev) AS revenue
  FROM items GROUP BY ALL)"""

_GAPS = _ORDERS + """,
gap_rows AS (SELECT *, lag(creation_time_utc) OVER (
    PARTITION BY user_id ORDER BY creation_time_utc NULLS FIRST, order_id) AS prev
  FROM order_rows),
gaps AS (SELECT *, date_diff('day', CAST(prev AS DATE), CAST(creation_time_utc AS DATE)) AS gap
  FROM gap_rows)"""

_RFM = _GAPS + """,
rfm AS (SELECT user_id, max(creation_time_utc) AS last_time,
    date_diff('day', CAST(max(creation_time_utc) AS DATE),
      CAST((SELECT max(creation_time_utc) FROM items) AS DATE)) AS recency,
    count(DISTINCT order_id) AS frequency, sum(revenue) AS monetary,
    coalesce(round(avg(gap), 1), 0) AS avg_gap
  FROM gaps GROUP BY user_id),
rfm_ranks AS (SELECT *, percent_rank() OVER (ORDER BY recency ASC NULLS FIRST) AS rp,
    percent_rank() OVER (ORDER BY frequency DESC NULLS LAST) AS fp,
    percent_rank() OVER (ORDER BY monetary DESC NULLS LAST) AS mp FROM rfm),
scored AS (SELECT *,
    CASE WHEN rp <= 0.2 THEN 5 WHEN rp <= 0.4 THEN 4 WHEN rp <= 0.6 THEN 3 WHEN rp <= 0.8 THEN 2 ELSE 1 END AS r,
    CASE WHEN fp <= 0.2 THEN 5 WHEN fp <= 0.4 THEN 4 WHEN fp <= 0.6 THEN 3 WHEN fp <= 0.8 THEN 2 ELSE 1 END AS f,
    CASE WHEN mp <= 0.2 THEN 5 WHEN mp <= 0.4 THEN 4 WHEN mp <= 0.6 THEN 3 WHEN mp <= 0.8 THEN 2 ELSE 1 END AS m
  FROM rfm_ranks),
segments AS (SELECT user_id, recency AS recency_days, frequency AS frequency_total,
    CAST(monetary AS DOUBLE) AS monetary_total, avg_gap AS avg_days_between_orders,
    CASE WHEN r >= 4 AND f >= 4 AND m >= 4 THEN 'VIP' WHEN f <= 2 AND r >= 4 THEN 'New Customer'
      WHEN r <= 2 AND f <= 2 THEN 'Churn Risk' ELSE 'Regular Customer' END AS rfm_segment,
    CASE WHEN recency > 45 THEN 'At Risk' ELSE 'Active' END AS churn_indicator
  FROM scored)"""


def _mean(total, count):
    """Half-up mean of a non-negative decimal total, in whole cents, as double."""
    return f"CAST((2 * CAST({total} * 100 AS HUGEINT) + {count}) // (2 * {count}) AS DOUBLE) / 100"


_TRENDS = _ITEMS + """,
trends AS (SELECT CAST(CAST(creation_time_utc AS DATE) AS VARCHAR) AS sales_date,
    year(creation_time_utc) AS sales_year, month(creation_time_utc) AS sales_month,
    week(creation_time_utc) AS sales_week, hour(creation_time_utc) AS sales_hour, item_category,
    sum(rev) AS total_revenue, count(DISTINCT order_id) AS total_orders
  FROM items GROUP BY 1, 2, 3, 4, 5, 6)"""

_LOYALTY = _ITEMS + f""",
loyalty AS (SELECT is_loyalty, {_mean('sum(rev)', 'count(rev)')} AS avg_order_spend,
    count(DISTINCT order_id) AS total_orders_placed, count(DISTINCT user_id) AS unique_customers,
    {_mean('sum(rev)', 'count(DISTINCT user_id)')} AS avg_lifetime_value_spend
  FROM items GROUP BY is_loyalty)"""

_LOCATIONS = _ITEMS + f""",
locations AS (SELECT restaurant_id, CAST(sum(rev) AS DOUBLE) AS total_revenue,
    count(DISTINCT order_id) AS total_orders, {_mean('sum(rev)', 'count(rev)')} AS average_order_value
  FROM items GROUP BY restaurant_id)"""

_FLAGGED = _ORDERS + "," + _OPTIONS + """,
flagged AS (SELECT *, EXISTS (SELECT 1 FROM options p
    WHERE p.order_id = o.order_id AND p.option_price < 0) AS is_discounted
  FROM order_rows o)"""

_DISCOUNTS = _FLAGGED + f""",
discounts AS (SELECT is_discounted, count(order_id) AS total_orders,
    CAST(sum(revenue) AS DOUBLE) AS total_revenue_generated,
    {_mean('sum(revenue)', 'count(revenue)')} AS average_basket_value
  FROM flagged GROUP BY is_discounted)"""

_BOOL = "coalesce(lower({0}) IN ('true', '1', 'yes'), false)"


def _flag_text(flag, number):
    return (f"CASE WHEN {flag} THEN list_value('True','TRUE','1','yes')[CAST({number} % 4 AS INTEGER) + 1] "
            f"ELSE list_value('False','0','no','','true ')[CAST({number} % 5 AS INTEGER) + 1] END")


_DATE_TEXT = f"""
date_text AS (
  SELECT CASE WHEN o_orderkey % 97 = 0 THEN strftime(o_orderdate, '%Y/%m/%d')
      ELSE strftime(o_orderdate, '%d-%m-%Y') END AS date_key,
    CASE WHEN o_orderkey % 101 = 0 THEN '20x4' ELSE CAST(year(o_orderdate) AS VARCHAR) END AS year,
    CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE CAST(month(o_orderdate) AS VARCHAR) END AS month,
    CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 103 = 0 THEN 'wk' ELSE CAST(week(o_orderdate) AS VARCHAR) END AS week,
    dayname(o_orderdate) AS day_of_week,
    {_flag_text("dayname(o_orderdate) IN ('Saturday', 'Sunday')", 'o_orderkey')} AS is_weekend,
    {_flag_text("o_orderpriority = '1-URGENT'", 'o_orderkey')} AS is_holiday,
    CASE WHEN o_orderkey % 3 = 0 THEN '  ' ELSE concat(' ', o_orderpriority) END AS holiday_name,
    o_orderkey AS position
  FROM orders)"""

_PARSED_DATE = "CAST(try_strptime(date_key, '%d-%m-%Y') AS DATE)"

_ITEM_TEXT = _ITEMS + f""",
item_text AS (
  SELECT app_name, restaurant_id, order_id, printed_card_number, currency, item_category, item_name,
    CASE WHEN l_orderkey % 89 = 0 THEN 'bad'
      ELSE concat(strftime(creation_time_utc, '%Y-%m-%dT%H:%M:%S'), '.250Z') END AS creation_time_utc,
    CASE WHEN o_custkey % 20 = 0 THEN NULL ELSE user_id END AS user_id,
    {_flag_text('is_loyalty', 'l_orderkey')} AS is_loyalty, lineitem_id,
    CASE WHEN l_partkey % 53 = 0 THEN '' ELSE CAST(item_price AS VARCHAR) END AS item_price,
    CASE WHEN l_partkey % 59 = 0 THEN 'x' ELSE CAST(item_quantity AS VARCHAR) END AS item_quantity,
    l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice
  FROM items)"""

_PARSED_TIME = "try_strptime(left(creation_time_utc, 19), '%Y-%m-%dT%H:%M:%S')"

_OPTION_TEXT = _OPTIONS + """,
option_text AS (
  SELECT order_id, lineitem_id, option_group_name,
    CASE WHEN option_group_name = 'addon' THEN NULL ELSE option_name END AS option_name,
    CASE WHEN option_quantity = 6 THEN 'n/a' ELSE CAST(option_price AS VARCHAR) END AS option_price,
    CASE WHEN option_quantity = 7 THEN '' ELSE CAST(option_quantity AS VARCHAR) END AS option_quantity
  FROM options)"""

_LINE_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice"

_DATE_DIM = """
date_dim AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS date_key, month(o_orderdate) AS month,
    dayname(o_orderdate) AS day_of_week, dayname(o_orderdate) IN ('Saturday', 'Sunday') AS is_weekend,
    strftime(o_orderdate, '%m-%d') IN ('01-01', '07-04', '12-25') AS is_holiday
  FROM orders)"""

_OPTION_COLUMNS = """order_id, lineitem_id, option_group_name, option_name,
  CAST(option_price AS DOUBLE) AS option_price, CAST(option_quantity AS BIGINT) AS option_quantity"""


def statements() -> dict[str, str]:
    """Query name to SQL."""
    select = {
        "scan_order_items": (_ITEMS, """SELECT app_name, restaurant_id,
            CAST(creation_time_utc AS VARCHAR) AS creation_time_utc, order_id, user_id, printed_card_number,
            is_loyalty, currency, lineitem_id, item_category, item_name,
            CAST(item_price AS DOUBLE) AS item_price, CAST(item_quantity AS BIGINT) AS item_quantity FROM items"""),
        "scan_order_item_options": (_OPTIONS, f"SELECT {_OPTION_COLUMNS} FROM options"),
        "ingest_date_dim": (_DATE_TEXT, f"""SELECT CAST({_PARSED_DATE} AS VARCHAR) AS date_key,
            CASE WHEN year = '' THEN NULL ELSE coalesce(TRY_CAST(year AS BIGINT), 0) END AS year,
            CASE WHEN month = '' THEN 0 ELSE CAST(month AS BIGINT) END AS month,
            CASE WHEN week = '' THEN NULL ELSE coalesce(TRY_CAST(week AS BIGINT), 0) END AS week, day_of_week,
            {_BOOL.format('is_weekend')} AS is_weekend, {_BOOL.format('is_holiday')} AS is_holiday,
            nullif(trim(holiday_name), '') AS holiday_name
          FROM date_text WHERE {_PARSED_DATE} IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY {_PARSED_DATE} ORDER BY position) = 1"""),
        "ingest_order_items": (_ITEM_TEXT, f"""SELECT app_name, restaurant_id,
            CAST({_PARSED_TIME} AS VARCHAR) AS creation_time_utc, order_id,
            coalesce(user_id, '') AS user_id, coalesce(printed_card_number, '') AS printed_card_number,
            {_BOOL.format('is_loyalty')} AS is_loyalty, currency, lineitem_id, item_category, item_name,
            coalesce(TRY_CAST(item_price AS DOUBLE), 0) AS item_price,
            coalesce(TRY_CAST(item_quantity AS BIGINT), 0) AS item_quantity
          FROM item_text
          QUALIFY row_number() OVER (PARTITION BY lineitem_id ORDER BY {_LINE_ORDER}) = 1"""),
        "ingest_order_item_options": (_OPTION_TEXT, """SELECT order_id, lineitem_id, option_group_name,
            coalesce(option_name, '') AS option_name,
            coalesce(TRY_CAST(option_price AS DOUBLE), 0) AS option_price,
            coalesce(TRY_CAST(option_quantity AS BIGINT), 0) AS option_quantity FROM option_text"""),
        "dedup_date_dim": (_DATE_TEXT, """SELECT * FROM date_text
          QUALIFY row_number() OVER (PARTITION BY date_key ORDER BY position) = 1"""),
        "dedup_order_items": (_ITEM_TEXT, f"""SELECT concat_ws('-', l_orderkey, l_linenumber) AS lineitem_id,
            restaurant_id, item_name, item_price, item_quantity FROM item_text
          QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) = 1"""),
        "load_audit": (_DATE_TEXT + "," + _ITEM_TEXT + "," + _OPTION_TEXT, f"""
          SELECT 'date_dim_raw' AS table_name, count(*) AS row_count,
            count(DISTINCT {_PARSED_DATE}) AS distinct_keys, count(*) - count({_PARSED_DATE}) AS null_keys,
            CAST(2 * count(*) - count({_PARSED_DATE}) - count(nullif(month, ''))
              + count(*) FILTER (trim(year) <> '' AND TRY_CAST(year AS BIGINT) IS NULL)
              + count(*) FILTER (trim(week) <> '' AND TRY_CAST(week AS BIGINT) IS NULL) AS BIGINT) AS parse_failures
          FROM date_text
          UNION ALL SELECT 'order_items_raw', count(*), count(DISTINCT lineitem_id),
            count(*) - count(nullif(lineitem_id, '')),
            3 * count(*) - count({_PARSED_TIME}) - count(TRY_CAST(item_price AS DOUBLE))
              - count(TRY_CAST(item_quantity AS BIGINT)) FROM item_text
          UNION ALL SELECT 'order_item_options_raw', count(*), count(DISTINCT lineitem_id),
            count(*) - count(nullif(lineitem_id, '')),
            2 * count(*) - count(TRY_CAST(option_price AS DOUBLE)) - count(TRY_CAST(option_quantity AS BIGINT))
          FROM option_text"""),
        "parse_boolean": (_ITEM_TEXT, f"""SELECT lineitem_id, is_loyalty,
            {_BOOL.format('is_loyalty')} AS parsed FROM item_text"""),
        "parse_date": (_DATE_TEXT, f"""SELECT position, date_key,
            CAST({_PARSED_DATE} AS VARCHAR) AS parsed FROM date_text"""),
        "parse_timestamp": (_ITEM_TEXT, f"""SELECT lineitem_id, creation_time_utc,
            CAST({_PARSED_TIME} AS VARCHAR) AS parsed FROM item_text"""),
        "blank_to_null": (_DATE_TEXT, """SELECT position, nullif(week, '') AS week,
            nullif(trim(holiday_name), '') AS holiday_name FROM date_text"""),
        "item_line_revenue": (_ITEMS, "SELECT lineitem_id, CAST(rev AS DOUBLE) AS item_line_revenue FROM items"),
        "option_line_revenue": (_OPTIONS, """SELECT lineitem_id, option_group_name,
            CAST(option_price * option_quantity AS DOUBLE) AS option_line_revenue FROM options"""),
        "discount_lines": (_OPTIONS, f"SELECT {_OPTION_COLUMNS} FROM options WHERE option_price < 0"),
        "item_user_map": (_ITEMS, "SELECT DISTINCT lineitem_id, user_id FROM items"),
        "options_with_user": (_SPEND, f"""SELECT {_OPTION_COLUMNS},
            CAST(option_price * option_quantity AS DOUBLE) AS option_line_revenue, user_id
          FROM options JOIN owner USING (lineitem_id)"""),
        "customer_item_spend": (_SPEND, "SELECT user_id, CAST(spend AS DOUBLE) AS total_item_spend FROM item_spend"),
        "customer_option_spend": (_SPEND,
                                  "SELECT user_id, CAST(spend AS DOUBLE) AS total_option_spend FROM option_spend"),
        "customer_spend": (_SPEND, """SELECT i.user_id, CAST(i.spend AS DOUBLE) AS total_item_spend,
            CAST(coalesce(o.spend, 0) AS DOUBLE) AS total_option_spend
          FROM item_spend i LEFT JOIN option_spend o ON i.user_id = o.user_id"""),
        "order_summary": (_ORDERS, """SELECT user_id, order_id,
            CAST(creation_time_utc AS VARCHAR) AS creation_time_utc,
            CAST(revenue AS DOUBLE) AS order_total_revenue FROM order_rows"""),
        "discounted_orders": (_OPTIONS, "SELECT DISTINCT order_id FROM options WHERE option_price < 0"),
        "order_discount_flag": (_FLAGGED, """SELECT order_id, user_id,
            CAST(creation_time_utc AS VARCHAR) AS creation_time_utc,
            CAST(revenue AS DOUBLE) AS order_total_revenue, is_discounted FROM flagged"""),
        "recency_baseline": (_ITEMS, "SELECT CAST(max(creation_time_utc) AS VARCHAR) AS baseline FROM items"),
        "order_gaps": (_GAPS, """SELECT user_id, order_id, CAST(creation_time_utc AS VARCHAR) AS creation_time_utc,
            CAST(revenue AS DOUBLE) AS order_total_revenue, CAST(prev AS VARCHAR) AS prev_order_time,
            gap AS days_between_orders FROM gaps"""),
        "customer_rfm": (_RFM, """SELECT user_id, CAST(last_time AS VARCHAR) AS last_order_time,
            frequency AS frequency_total, CAST(monetary AS DOUBLE) AS monetary_total,
            avg_gap AS avg_days_between_orders, recency AS recency_days FROM rfm"""),
        "clv_percent_rank": (_CLV, """SELECT user_id, CAST(value AS DOUBLE) AS customer_lifetime_value,
            pr AS percent_rank FROM ranked"""),
        "rfm_scores": (_RFM, """SELECT user_id, CAST(last_time AS VARCHAR) AS last_order_time,
            frequency AS frequency_total, CAST(monetary AS DOUBLE) AS monetary_total,
            avg_gap AS avg_days_between_orders, recency AS recency_days, CAST(r AS BIGINT) AS r_score,
            CAST(f AS BIGINT) AS f_score, CAST(m AS BIGINT) AS m_score FROM scored"""),
        "customer_lifetime_value": (_CLV, f"""SELECT user_id, CAST(value AS DOUBLE) AS customer_lifetime_value,
            {_TIER} AS clv_segment FROM ranked"""),
        "customer_segments": (_RFM, "SELECT * FROM segments"),
        "sales_trends": (_TRENDS, """SELECT * REPLACE (CAST(total_revenue AS DOUBLE) AS total_revenue)
          FROM trends"""),
        "loyalty_impact": (_LOYALTY, "SELECT * FROM loyalty"),
        "location_performance": (_LOCATIONS, "SELECT * FROM locations"),
        "discount_effectiveness": (_DISCOUNTS, "SELECT * FROM discounts"),
        "view_segment_counts": (_RFM, """SELECT rfm_segment AS "Segment", count(*) AS "Total Customers"
          FROM segments GROUP BY 1 ORDER BY 2 DESC, 1"""),
        "view_churn_counts": (_RFM, """SELECT churn_indicator AS "Status", count(*) AS "Volume"
          FROM segments GROUP BY 1 ORDER BY 2 DESC, 1"""),
        "view_customer_roster": (_RFM, """SELECT * FROM segments
          ORDER BY recency_days DESC NULLS LAST, user_id LIMIT 100"""),
        "view_revenue_timeline": (_TRENDS, """,
          cells AS (SELECT sales_date, item_category, sum(total_revenue) AS revenue FROM trends
            WHERE sales_date IS NOT NULL AND item_category IS NOT NULL GROUP BY ALL),
          grid AS (SELECT * FROM (SELECT DISTINCT sales_date FROM cells), (SELECT DISTINCT item_category FROM cells))
          SELECT sales_date, item_category, CAST(coalesce(revenue, 0) AS DOUBLE) AS total_revenue
          FROM grid LEFT JOIN cells USING (sales_date, item_category) ORDER BY sales_date, item_category"""),
        "view_hourly_demand": (_TRENDS, """SELECT sales_hour, CAST(sum(total_orders) AS BIGINT) AS total_orders
          FROM trends GROUP BY sales_hour ORDER BY sales_hour"""),
        "view_loyalty": (_LOYALTY, """SELECT * REPLACE (
            CASE WHEN is_loyalty THEN 'Loyalty Member' WHEN NOT is_loyalty THEN 'Standard Guest' END AS is_loyalty)
          FROM loyalty"""),
        "view_location_league": (_LOCATIONS, """SELECT * FROM locations
          ORDER BY total_revenue DESC NULLS LAST, restaurant_id"""),
        "view_discount": (_DISCOUNTS, """SELECT * REPLACE (CASE WHEN is_discounted THEN 'Promo Applied'
            WHEN NOT is_discounted THEN 'Full Price Purchase' END AS is_discounted) FROM discounts"""),
        "clv_as_of": (_CLV.replace("ON l.l_partkey = p.p_partkey)",
                                   "ON l.l_partkey = p.p_partkey\n  WHERE o.o_orderdate + "
                                   "to_hours(CAST(o.o_orderkey % 24 AS INTEGER)) < TIMESTAMP '1998-07-01')"),
                      f"""SELECT user_id, CAST(value AS DOUBLE) AS customer_lifetime_value,
            {_TIER} AS clv_segment, '1998-06-30' AS as_of_date FROM ranked"""),
        "seasonal_sales": (_ITEMS + "," + _DATE_DIM, f""",
          daily AS (SELECT CAST(creation_time_utc AS DATE) AS date_key, sum(rev) AS revenue
            FROM items GROUP BY 1),
          tagged AS (SELECT d.*, dd.* EXCLUDE (date_key) FROM daily d LEFT JOIN date_dim dd USING (date_key)),
          stacked AS (
            SELECT 'weekend' AS season_kind, coalesce(CAST(is_weekend AS VARCHAR), 'unknown') AS season_value,
              revenue FROM tagged
            UNION ALL SELECT 'holiday', coalesce(CAST(is_holiday AS VARCHAR), 'unknown'), revenue FROM tagged
            UNION ALL SELECT 'month', coalesce(CAST(month AS VARCHAR), 'unknown'), revenue FROM tagged
            UNION ALL SELECT 'weekday', coalesce(day_of_week, 'unknown'), revenue FROM tagged)
          SELECT season_kind, season_value, count(*) AS sales_days, CAST(sum(revenue) AS DOUBLE) AS total_revenue,
            {_mean('sum(revenue)', 'count(*)')} AS avg_daily_revenue
          FROM stacked GROUP BY 1, 2"""),
        "location_extremes": (_LOCATIONS, """
          (SELECT *, 'best' AS placing FROM locations ORDER BY total_revenue DESC NULLS LAST, restaurant_id LIMIT 10)
          UNION ALL
          (SELECT *, 'worst' AS placing FROM locations ORDER BY total_revenue ASC NULLS LAST, restaurant_id LIMIT 10)"""),
        "discount_net_revenue": (_ITEMS + "," + _OPTIONS, """,
          gross AS (SELECT order_id, sum(rev) AS gross FROM items GROUP BY 1),
          extra AS (SELECT order_id, sum(option_price * option_quantity) FILTER (option_price >= 0) AS addons,
              sum(option_price * option_quantity) FILTER (option_price < 0) AS discounts,
              bool_or(option_price < 0) AS flag FROM options GROUP BY 1),
          totals AS (SELECT coalesce(flag, false) AS is_discounted, count(*) AS n, sum(gross) AS g,
              coalesce(sum(addons), 0) AS a, coalesce(sum(discounts), 0) AS d
            FROM gross LEFT JOIN extra USING (order_id) GROUP BY 1)
          SELECT is_discounted, n AS total_orders, CAST(g AS DOUBLE) AS gross_revenue,
            CAST(a AS DOUBLE) AS addon_revenue, CAST(d AS DOUBLE) AS discount_amount,
            CAST(g + a + d AS DOUBLE) AS net_revenue FROM totals"""),
        "discount_depth": (_ITEMS + "," + _OPTIONS, """,
          cuts AS (SELECT lineitem_id, -sum(option_price * option_quantity) AS discount FROM options
            WHERE option_price < 0 GROUP BY 1),
          depths AS (SELECT restaurant_id, CASE WHEN rev > 0 THEN
              (20000 * CAST(discount * 100 AS HUGEINT) + CAST(rev * 100 AS HUGEINT)) // (2 * CAST(rev * 100 AS HUGEINT)) END AS depth
            FROM items JOIN cuts USING (lineitem_id)),
          placed AS (SELECT *, row_number() OVER (PARTITION BY restaurant_id, depth IS NULL ORDER BY depth) AS place,
              count(depth) OVER (PARTITION BY restaurant_id) AS n FROM depths)
          SELECT restaurant_id, count(*) AS discounted_lines,
            CAST(min(depth) FILTER (depth IS NOT NULL AND place * 2 >= n) AS DOUBLE) / 100 AS median_depth,
            CAST(min(depth) FILTER (depth IS NOT NULL AND place * 10 >= n * 9) AS DOUBLE) / 100 AS depth_90
          FROM placed GROUP BY 1"""),
        "period_calendar": (_ITEMS, """,
          daily AS (SELECT CAST(creation_time_utc AS DATE) AS day, rev FROM items WHERE creation_time_utc IS NOT NULL),
          span AS (SELECT min(day) AS lo, max(day) AS hi FROM daily),
          starts AS (
            SELECT 'week' AS period_kind, CAST(unnest(generate_series(date_trunc('week', lo), hi, INTERVAL 7 DAY)) AS DATE) AS period_start FROM span
            UNION ALL
            SELECT 'month', CAST(unnest(generate_series(date_trunc('month', lo), hi, INTERVAL 1 MONTH)) AS DATE) FROM span),
          sums AS (SELECT period_kind, period_start, coalesce(sum(rev), 0) AS revenue
            FROM starts LEFT JOIN daily ON date_trunc(period_kind, day) = period_start GROUP BY ALL),
          steps AS (SELECT *, lag(revenue) OVER (PARTITION BY period_kind ORDER BY period_start) AS before FROM sums)
          SELECT period_kind, CAST(period_start AS VARCHAR) AS period_start, CAST(revenue AS DOUBLE) AS total_revenue,
            CAST(before AS DOUBLE) AS previous_revenue, CAST(revenue - before AS DOUBLE) AS revenue_change FROM steps"""),
        "seasonal_index": (_ITEMS, """,
          span AS (SELECT CAST(min(creation_time_utc) AS DATE) AS lo, CAST(max(creation_time_utc) AS DATE) AS hi FROM items),
          days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM span),
          daily AS (SELECT day, coalesce(sum(rev), 0) AS revenue FROM days LEFT JOIN items ON CAST(creation_time_utc AS DATE) = day GROUP BY 1),
          monthly AS (SELECT date_trunc('month', day) AS day, sum(revenue) AS revenue FROM daily GROUP BY 1),
          seasons AS (
            SELECT 'weekday' AS season_kind, dayname(day) AS season_value, revenue, 7 AS periods,
              sum(revenue) OVER (ORDER BY day ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS around,
              count(*) OVER (ORDER BY day ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) = 7 AS whole FROM daily
            UNION ALL
            SELECT 'month', CAST(month(day) AS VARCHAR), revenue, 24,
              sum(revenue) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING)
                + sum(revenue) OVER (ORDER BY day ROWS BETWEEN 5 PRECEDING AND 6 FOLLOWING),
              count(*) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) = 13 FROM monthly)
          SELECT season_kind, season_value, count(*) AS n_periods, CAST(sum(revenue) AS DOUBLE) AS total_revenue,
            CAST(sum(revenue) * any_value(periods) AS DOUBLE) / CAST(sum(around) AS DOUBLE) AS season_index
          FROM seasons WHERE whole GROUP BY 1, 2"""),
        "period_change": (_ITEMS, """,
          periods AS (
            SELECT 'week' AS period_kind, date_trunc('week', creation_time_utc) AS start, sum(rev) AS revenue
            FROM items GROUP BY 1, 2
            UNION ALL SELECT 'month', date_trunc('month', creation_time_utc), sum(rev) FROM items GROUP BY 1, 2),
          steps AS (SELECT *, lag(revenue) OVER (PARTITION BY period_kind, start IS NULL ORDER BY start) AS before FROM periods)
          SELECT period_kind, CAST(CAST(start AS DATE) AS VARCHAR) AS period_start,
            CAST(revenue AS DOUBLE) AS total_revenue, CAST(before AS DOUBLE) AS previous_revenue,
            CAST(revenue - before AS DOUBLE) AS revenue_change FROM steps"""),
    }
    select["clv_daily_merge"] = (tables, query) = select["clv_as_of"]
    first = "TIMESTAMP '1998-07-01' QUALIFY row_number() OVER (PARTITION BY lineitem_id ORDER BY l.l_quantity) = 1"
    select["clv_merged_batches"] = (tables.replace("TIMESTAMP '1998-07-01'", first), query)
    for name in ("clv_percent_rank", "loyalty_impact", "location_performance"):
        select[f"{name}_merged"] = select[name]
    select["preview"] = (select["scan_order_items"][0], select["scan_order_items"][1] + " ORDER BY lineitem_id LIMIT 5")
    select["option_surrogate_id"] = (_OPTIONS, """SELECT count(*) AS n_rows, count(*) AS n_ids, count(*) AS n_not_null,
        CAST(1 AS BIGINT) AS first_id, count(*) AS last_id FROM options""")
    return {name: f"WITH {tables.strip()} {query}" for name, (tables, query) in select.items()}
