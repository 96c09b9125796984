"""DuckDB SQL for the e-commerce reports, and the union with all other oracle statements.

The statements state what a report means by other means than the DataFrame code: set operations,
FILTER sums, positions and self-joins, arg_min / arg_max, counts of larger values.  Money is
summed as DECIMAL and rounded at the end; ratios are computed in DOUBLE and rounded half-up on
their decimal digits.
"""

from __future__ import annotations

from datetime import date, timedelta

from tillpoint.plans import params as P
from tillpoint.plans.oracle_views import money, percent, round_half_up, with_views

TIERS = f"['Low', 'Medium', 'High'][1 + CAST(r >= {P.MEDIUM_TIER} AS INT) + CAST(r > {P.HIGH_TIER} AS INT)]"


def _change(now: str, then: str) -> str:
    ratio = f"CAST(100.0 AS DOUBLE) * CAST({now} - {then} AS DOUBLE) / CAST({then} AS DOUBLE)"
    return f"CASE WHEN {then} <> 0 THEN {round_half_up(ratio, 2)} END"


def order_reports(orders: str) -> dict[str, str]:
    """The reports that read orders, over the view ``orders`` (with or without NULLs)."""
    per_order = "per_order AS (SELECT order_id, SUM(revenue) AS r FROM order_items GROUP BY ALL)"
    known = f"(SELECT * FROM {orders} WHERE customer_id IS NOT NULL)"
    spent = (f"{per_order},\nspent AS (SELECT customer_id, SUM(r) AS r FROM per_order JOIN {known} "
             "USING (order_id) GROUP BY ALL)")
    return {
        "top10_customers": with_views(f"""
WITH {spent}
SELECT customer_id, {money('r')} AS total_order_value FROM spent
QUALIFY ROW_NUMBER() OVER (ORDER BY {money('r')} DESC, customer_id) <= 10""",
                                      "order_items", orders),
        "monthly_orders_12m": with_views(f"""
WITH newest AS (SELECT CAST(MAX(order_date) AS DATE) AS day FROM {orders})
SELECT left(CAST(CAST(order_date AS DATE) AS VARCHAR), 7) AS year_month, COUNT(*) AS order_count
FROM newest JOIN {orders} ON order_date >= CAST(day - INTERVAL 1 YEAR AS TIMESTAMP)
GROUP BY ALL""", orders),
        "never_delivered": with_views(f"""
SELECT customer_id FROM {known}
EXCEPT
SELECT customer_id FROM {orders} WHERE status = 'DELIVERED'""", orders),
        "running_revenue": with_views(f"""
WITH {per_order},
days AS (SELECT region_code, date_trunc('day', order_date) AS d, SUM(r) AS r
         FROM {orders} NATURAL JOIN per_order GROUP BY ALL)
SELECT region_code, CAST(d AS TIMESTAMP) AS order_date, {money('r')} AS daily_revenue,
       {money('SUM(r) OVER up')} AS running_total
FROM days WINDOW up AS (PARTITION BY region_code ORDER BY d NULLS FIRST ROWS UNBOUNDED PRECEDING)""",
                                      "order_items", orders),
        "order_gaps": with_views(f"""
WITH placed AS (
    SELECT customer_id, order_date,
           ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY order_date NULLS FIRST, order_id) AS n
    FROM {known}),
steps AS (
    SELECT b.customer_id, b.order_date, a.order_date AS previous_order_date,
           CAST(date_diff('microsecond', a.order_date, b.order_date) AS DOUBLE) / CAST(864e8 AS DOUBLE) AS gap
    FROM placed b LEFT JOIN placed a ON a.customer_id = b.customer_id AND a.n + 1 = b.n)
SELECT customer_id, order_date, previous_order_date, {round_half_up('gap', 1)} AS days_gap,
       ['Active', 'At Risk'][1 + CAST(AVG(gap) OVER (PARTITION BY customer_id) > {P.RISK_DAYS} AS INT)] AS risk_flag
FROM steps QUALIFY COUNT(gap) OVER (PARTITION BY customer_id) > 0""", orders),
        "revenue_tiers": with_views(f"""
WITH {per_order},
months AS (SELECT customer_id, left(CAST(CAST(order_date AS DATE) AS VARCHAR), 7) AS year_month, SUM(r) AS r
           FROM per_order JOIN {known} USING (order_id) GROUP BY ALL)
SELECT year_month, {TIERS} AS tier, COUNT(*) AS customer_count FROM months GROUP BY ALL""",
                                    "order_items", orders),
        "customer_quartiles": with_views(f"""
WITH {spent},
placed AS (SELECT customer_id, r, ROW_NUMBER() OVER (ORDER BY r DESC, customer_id) - 1 AS k,
                  COUNT(*) OVER () // 4 AS q, COUNT(*) OVER () % 4 AS m FROM spent),
tiles AS (SELECT customer_id, r,
                 1 + CASE WHEN k < m * (q + 1) THEN k // (q + 1) ELSE m + (k - m * (q + 1)) // q END AS t
          FROM placed)
SELECT customer_id, {money('r')} AS total_value, CAST(t AS BIGINT) AS quartile,
       ['Platinum', 'Gold', 'Silver', 'Bronze'][t] AS quartile_label
FROM tiles""", "order_items", orders),
        "yoy_revenue": with_views(f"""
WITH {per_order},
months AS (SELECT year(order_date) AS y, month(order_date) AS m, SUM(r) AS r
           FROM {orders} NATURAL JOIN per_order GROUP BY ALL),
pairs AS (SELECT y, m, r, CASE WHEN LAG(y) OVER back = y - 1 THEN LAG(r) OVER back END AS old
          FROM months WINDOW back AS (PARTITION BY m ORDER BY y))
SELECT CAST(y AS BIGINT) AS year, CAST(m AS BIGINT) AS month, {money('r')} AS revenue,
       {money('old')} AS prev_year_revenue, {_change('r', 'old')} AS yoy_growth_percent
FROM pairs""", "order_items", orders),
        "first_last_category": with_views(f"""
WITH bought AS (SELECT customer_id, category, ROW(order_date, order_id, product_id) AS place
                FROM {known} NATURAL JOIN order_items NATURAL JOIN products)
SELECT customer_id, arg_min(category, place) AS first_category, arg_max(category, place) AS last_category,
       CASE arg_min(category, place) WHEN arg_max(category, place) THEN 'No' ELSE 'Yes' END AS category_shift
FROM bought GROUP BY customer_id""", "order_items", orders, "products"),
        "cumulative_revenue": with_views(f"""
WITH {spent},
run AS (SELECT customer_id, r, SUM(r) OVER (ORDER BY r DESC, customer_id ROWS UNBOUNDED PRECEDING) AS c
        FROM spent)
SELECT customer_id, {money('r')} AS revenue, {money('c')} AS cumulative_revenue,
       {percent('c', 't')} AS cumulative_percent
FROM run CROSS JOIN (SELECT SUM(r) AS t FROM spent)""", "order_items", orders),
        "cohort_retention": with_views(f"""
WITH joined AS (SELECT customer_id, registration_date AS d,
                       left(CAST(CAST(registration_date AS DATE) AS VARCHAR), 7) AS cohort_month FROM customers),
seen AS (SELECT DISTINCT cohort_month, customer_id, date_diff('month', d, order_date) AS month_offset
         FROM joined NATURAL JOIN {known})
SELECT cohort_month, CAST(month_offset AS BIGINT) AS month_offset, COUNT(*) AS active_customers,
       ANY_VALUE(n) AS cohort_size, {percent('COUNT(*)', 'ANY_VALUE(n)')} AS retention_rate
FROM seen NATURAL JOIN (SELECT cohort_month, COUNT(DISTINCT customer_id) AS n FROM joined GROUP BY ALL)
WHERE month_offset IN (0, 1, 2, 3) GROUP BY cohort_month, month_offset""", orders, "customers"),
    }


def _period_sql(start: str, end: str) -> str:
    days = (date.fromisoformat(end) - date.fromisoformat(start)).days
    before = str(date.fromisoformat(start) - timedelta(days))
    tops = ",\n       ".join(f"best[{i}].p AS top_{i}, {money(f'best[{i}].r')} AS top_{i}_revenue"
                             for i in (1, 2, 3))
    return with_views(f"""
WITH spans(period, start_date, end_date) AS (
    VALUES ('current', '{start}', '{end}'), ('previous', '{before}', '{start}')),
inside AS (
    SELECT period, o.order_id, o.customer_id FROM spans
    JOIN orders_v o ON o.order_date >= CAST(start_date AS TIMESTAMP) AND o.order_date < CAST(end_date AS TIMESTAMP)),
sold AS (SELECT period, product_id, revenue FROM inside NATURAL JOIN order_items),
names AS (SELECT period, product_name AS p, SUM(revenue) AS r FROM sold NATURAL JOIN products GROUP BY ALL),
best AS (SELECT period, list({{'p': p, 'r': r}} ORDER BY r DESC, p) AS best FROM names GROUP BY ALL),
facts AS (
    SELECT period, start_date, end_date, best,
           (SELECT COUNT(*) FROM inside i WHERE i.period = s.period) AS n,
           (SELECT COUNT(DISTINCT customer_id) FROM inside i WHERE i.period = s.period) AS u,
           COALESCE((SELECT SUM(revenue) FROM sold x WHERE x.period = s.period), 0) AS r
    FROM spans s LEFT JOIN best USING (period)),
old AS (SELECT 'current' AS period, n AS n0, u AS u0, r AS r0 FROM facts WHERE period = 'previous')
SELECT period, start_date, end_date, CAST(n AS BIGINT) AS total_orders, {money('r')} AS revenue,
       CAST(u AS BIGINT) AS unique_customers, {_change('n', 'n0')} AS orders_change_pct,
       {_change('r', 'r0')} AS revenue_change_pct, {_change('u', 'u0')} AS customers_change_pct,
       {tops}
FROM facts LEFT JOIN old USING (period)""", "order_items", "orders_v", "products")


def _last_days(days: int) -> str:
    return _period_sql(str(date.fromisoformat(P.REPORT_ANCHOR) - timedelta(days)), P.REPORT_ANCHOR)


_CATEGORY_REVENUE = with_views(f"""
WITH sold AS (SELECT product_id, SUM(revenue) AS r FROM order_items GROUP BY ALL)
SELECT category, {money('SUM(r)')} AS total_revenue FROM products NATURAL JOIN sold GROUP BY category""",
                               "order_items", "products")

_UNITS = """units AS (
    SELECT product_id, COALESCE(SUM(quantity) FILTER (quantity > 0), 0) AS bought,
           COALESCE(-SUM(quantity) FILTER (quantity < 0), 0) AS back
    FROM order_items GROUP BY product_id)"""

RETAIL_SQL: dict[str, str] = {
    **order_reports("orders_v"),
    "category_revenue": _CATEGORY_REVENUE,
    "sql_category_revenue": _CATEGORY_REVENUE,
    "more_returns": with_views(f"""
WITH {_UNITS}
SELECT product_id, product_name, CAST(bought AS BIGINT) AS purchased_qty, CAST(back AS BIGINT) AS returned_qty
FROM products NATURAL JOIN units WHERE bought - back < 0""", "order_items", "products"),
    "return_rate": with_views(f"""
WITH {_UNITS}, c AS (SELECT category, SUM(back) AS b, SUM(bought) + SUM(back) AS n
                     FROM products NATURAL JOIN units GROUP BY ALL)
SELECT category, CAST(b AS BIGINT) AS returned_items, CAST(n AS BIGINT) AS total_items,
       {round_half_up('CAST(b AS DOUBLE) / CAST(NULLIF(n, 0) AS DOUBLE)', 4)} AS return_rate
FROM c""", "order_items", "products"),
    "rank_in_category": with_views(f"""
WITH named AS (SELECT category, product_name, SUM(revenue) AS r
               FROM order_items NATURAL JOIN products GROUP BY ALL)
SELECT category, product_name, {money('r')} AS total_revenue,
       1 + (SELECT COUNT(DISTINCT b.r) FROM named b WHERE b.category = a.category AND b.r > a.r) AS rank_in_category
FROM named a""", "order_items", "products"),
    "bought_together": with_views("""
WITH carts AS (SELECT order_id, product_id, product_name, COUNT(*) AS n
               FROM order_items NATURAL JOIN products GROUP BY ALL),
pairs AS (SELECT l.product_name AS product_a, r.product_name AS product_b,
                 CAST(SUM(l.n * r.n) AS BIGINT) AS times_bought_together
          FROM carts l, carts r WHERE l.order_id = r.order_id AND r.product_id > l.product_id GROUP BY ALL)
SELECT * FROM pairs
QUALIFY ROW_NUMBER() OVER (ORDER BY times_bought_together DESC, product_a, product_b) <= 20""",
                                  "order_items", "products"),
    "period_report": _period_sql(P.PERIOD_START, P.PERIOD_END),
    "period_report_daily": _last_days(1),
    "period_report_weekly": _last_days(7),
    "period_report_monthly": _last_days(30),
    **{f"clean_{k}": v for k, v in order_reports("orders_clean").items() if k in (
        "top10_customers", "monthly_orders_12m", "never_delivered", "running_revenue", "order_gaps",
        "revenue_tiers", "yoy_revenue", "cohort_retention")},
}

from tillpoint.plans.oracle_more import MORE_SQL  # noqa: E402

ORACLE_SQL: dict[str, str] = {**RETAIL_SQL, **MORE_SQL}
