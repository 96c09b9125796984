"""Oracle SQL (DuckDB) for the customer-sales, sales, cleaning, profiling, quality, source
and merge queries."""

from __future__ import annotations

from tillpoint.plans import params as P
from tillpoint.plans.oracle_views import money, round_half_up, with_views

# Amounts have four decimals; eight digits cut nothing.
AMOUNT = "CAST({} AS DECIMAL(30,8))"


def avg2(col: str, digits: int = 4) -> str:
    return round_half_up(f"CAST(SUM(CAST({col} AS DECIMAL(30,8))) AS DOUBLE) "
                         f"/ CAST(COUNT({col}) AS DOUBLE)", digits)


def sum2(col: str) -> str:
    return money4(f"SUM({AMOUNT.format(col)})")


def money4(expr: str) -> str:
    return money(expr, 4)


SALES_COLS = ["order_id", "order_date", "ship_date", "customer_id", "customer_name", "segment",
              "city", "region", "product_id", "product_name", "category", "sales", "quantity",
              "discount", "profit"]
DOUBLE_COLS = {"sales", "discount", "profit"}

PARSED = """parsed AS (
    SELECT * REPLACE (CASE WHEN trim(sales) IN ('null', 'NULL', '') THEN NULL
                           ELSE TRY_CAST(sales AS DOUBLE) END AS sales)
    FROM sales_dirty)"""

DIM = """cdim AS (SELECT customer_id, MIN(customer_name) AS customer_name
                 FROM customer_names GROUP BY customer_id)"""

TOTALS = f"tot AS (SELECT customer_id, SUM({AMOUNT.format('sales')}) AS total FROM order_lines GROUP BY ALL)"
NAMED = f"{TOTALS}, {DIM}, named AS (SELECT customer_name, SUM(total) AS total FROM tot NATURAL JOIN cdim GROUP BY ALL)"


def _cs(sql: str) -> str:
    return with_views(sql, "order_lines", "customer_names")


def _sales(sql: str) -> str:
    return with_views(sql, "sales")


def _parsed(sql: str) -> str:
    body = sql.strip()
    if body.upper().startswith("WITH "):
        body = f"WITH {PARSED},\n{body[5:]}"
    else:
        body = f"WITH {PARSED}\n{body}"
    return with_views(body, "sales_dirty")


CUSTOMER_SALES_SQL = {
    "above_avg_orders": _cs(f"""
SELECT o.* FROM order_lines o
JOIN (SELECT SUM({AMOUNT.format('sales')}) AS s, COUNT(sales) AS n FROM order_lines) ON {AMOUNT.format('o.sales')} * n > s"""),
    "max_per_customer": _cs("""
SELECT customer_id, MAX(sales) AS max_sales FROM order_lines GROUP BY customer_id"""),
    "sales_per_customer": _cs(f"""
SELECT customer_id, {sum2('sales')} AS total_sales FROM order_lines GROUP BY customer_id"""),
    "customers_above_avg": _cs(f"""
WITH {TOTALS}
SELECT customer_id, {money4('total')} AS total_sales FROM tot
JOIN (SELECT SUM(total) AS s, COUNT(*) AS n FROM tot) ON total * n > s"""),
    "customer_sales_rank": _cs(f"""
WITH {TOTALS}
SELECT customer_id, {money4('total')} AS total_sales,
       1 + (SELECT COUNT(*) FROM tot b WHERE b.total > a.total) AS sales_rank
FROM tot a"""),
    "order_row_number": _cs("""
SELECT order_id, customer_id,
       CAST(ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY order_id) AS BIGINT) AS row_num
FROM order_lines"""),
    "top_customers_rank": _cs(f"""
WITH {TOTALS}
SELECT customer_id, {money4('total')} AS total_sales FROM tot a
WHERE (SELECT COUNT(*) FROM tot b WHERE b.total > a.total) < 3"""),
    "customer_rank_named": _cs(f"""
WITH {TOTALS}, {DIM},
levels AS (SELECT total, COUNT(*) AS n FROM tot GROUP BY ALL),
places AS (SELECT total, 1 + COALESCE(SUM(n) OVER (ORDER BY total DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS p
           FROM levels)
SELECT customer_name, {money4('total')} AS total_sales, CAST(p AS BIGINT) AS sales_rank
FROM places NATURAL JOIN tot NATURAL JOIN cdim"""),
    "top5_named": _cs(f"""
WITH {NAMED}, ahead AS (SELECT a.customer_name, a.total, COUNT(b.total) AS n
                        FROM named a LEFT JOIN named b ON b.total > a.total GROUP BY ALL)
SELECT customer_name, {money4('total')} AS total_sales, n + 1 AS sales_rank FROM ahead WHERE n < 5"""),
    "bottom_customers": _cs(f"""
WITH {NAMED}, below AS (SELECT a.customer_name, a.total, COUNT(b.total) AS n
                        FROM named a LEFT JOIN named b ON b.total < a.total GROUP BY ALL)
SELECT customer_name, {money4('total')} AS total_sales, n + 1 AS sales_rank FROM below WHERE n < 5"""),
    "single_order_customers": _cs(f"""
WITH {DIM}
SELECT ANY_VALUE(customer_name) AS customer_name FROM order_lines NATURAL JOIN cdim
GROUP BY customer_id HAVING MIN(order_id) = MAX(order_id)"""),
    "above_avg_named": _cs(f"""
WITH {TOTALS}, {DIM}
SELECT customer_name, {money4('total')} AS total_sales, customer_id FROM tot NATURAL JOIN cdim
WHERE total * (SELECT COUNT(*) FROM tot) > (SELECT SUM(total) FROM tot)"""),
    "top_order_per_customer": _cs(f"""
WITH {DIM}
SELECT customer_name, order_id, sales FROM order_lines NATURAL JOIN cdim
QUALIFY sales = MAX(sales) OVER (PARTITION BY customer_id)"""),
    "insert_distinct": _cs("""
SELECT DISTINCT order_id, customer_id, product_id, quantity, sales FROM order_lines"""),
}

SALES_SQL = {
    "scan_sales": _sales("SELECT * FROM sales"),
    "filter_region": _sales(f"SELECT * FROM sales WHERE region = '{P.REGION}'"),
    "filter_category": _sales(f"SELECT * FROM sales WHERE category = '{P.CATEGORY}'"),
    "filter_sales": _sales(f"SELECT * FROM sales WHERE sales > {P.SALES_OVER}"),
    "filter_date": _sales(f"SELECT * FROM sales WHERE order_date > TIMESTAMP '{P.DATE_AFTER}'"),
    "sales_totals": _sales(f"""
SELECT {sum2('sales')} AS total_sales, MAX(sales) AS highest_sale, {avg2('sales')} AS average_sales
FROM sales"""),
    "sales_by_region": _sales(f"SELECT region, {sum2('sales')} AS total_sales FROM sales GROUP BY region"),
    "avg_by_category": _sales(f"SELECT category, {avg2('sales')} AS average_sales FROM sales GROUP BY category"),
    "quantity_by_region": _sales("""
SELECT region, CAST(SUM(quantity) AS BIGINT) AS quantity_sold FROM sales GROUP BY region"""),
    "count_by_category": _sales("SELECT category, COUNT(*) AS orders FROM sales GROUP BY category"),
    "having_quantity": _sales(f"""
SELECT customer_name, CAST(SUM(quantity) AS BIGINT) AS quantity FROM sales
GROUP BY customer_name HAVING SUM(quantity) > {P.QUANTITY_OVER}"""),
    "top10_customers_sales": _sales(f"""
SELECT customer_name, {sum2('sales')} AS total_sales FROM sales GROUP BY customer_name
ORDER BY total_sales DESC, customer_name LIMIT 10"""),
    "profit_by_region": _sales(f"""
SELECT region, {sum2('profit')} AS profit FROM sales GROUP BY region"""),
    "top10_products": _sales(f"""
SELECT product_name, {sum2('sales')} AS total_sales FROM sales GROUP BY product_name
ORDER BY total_sales DESC, product_name LIMIT 10"""),
    "profile_shape": _sales(f"""
SELECT COUNT(*) AS row_count, CAST({len(SALES_COLS)} AS BIGINT) AS column_count FROM sales"""),
    "dup_groups": _sales("""
SELECT customer_name, order_date, COUNT(*) AS duplicate_count FROM sales
GROUP BY customer_name, order_date HAVING COUNT(*) > 1"""),
}

_not_null = " AND ".join(f"{c} IS NOT NULL" for c in SALES_COLS)
_renamed = ", ".join("customer_name AS Customer_Name" if c == "customer_name" else c
                     for c in SALES_COLS)
_survivor = ["product_id", "ship_date", "quantity", "discount", "profit", "sales"]
_rest = [c for c in SALES_COLS if c not in ("order_id", "customer_name", "category")
         and c not in _survivor]
_dedup_order = ", ".join(f"{c} NULLS FIRST" for c in _survivor + _rest)
DEDUP = f"""d AS (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id, customer_name, category
                                 ORDER BY {_dedup_order}) AS rn
    FROM parsed)"""

PARSED_SQL = {
    "parse_numeric": _parsed("SELECT * FROM parsed"),
    "west_avg": _parsed(f"""
SELECT category, {avg2('sales')} AS average_sales FROM parsed
WHERE region = '{P.REGION}' GROUP BY category"""),
    "drop_nulls": _parsed(f"SELECT * FROM parsed WHERE {_not_null}"),
    "fill_constants": _parsed("""
SELECT * REPLACE (COALESCE(customer_name, 'Unknown') AS customer_name) FROM parsed"""),
    "city_counts": _parsed(f"""
SELECT city, COUNT(*) AS total_count FROM parsed GROUP BY city HAVING COUNT(*) > {P.CITY_COUNT_OVER}"""),
    "drop_col": _parsed("SELECT * EXCLUDE (segment) FROM parsed"),
    "rename_col": _parsed(f"SELECT {_renamed} FROM parsed"),
    "filter_and": _parsed(f"""
SELECT * FROM parsed WHERE region = '{P.REGION}' AND sales > {P.SALES_OVER_SMALL}"""),
    "avg_filled_sales": _parsed(f"""
SELECT {avg2('COALESCE(sales, CAST(0 AS DOUBLE))')} AS average_sales FROM parsed"""),
    "const_timestamp": _parsed("""
SELECT order_id, TIMESTAMP '2025-01-01 00:00:00' AS event_time FROM parsed"""),
    "sales_by_category": _parsed(f"""
SELECT category, {sum2('sales')} AS total_sales FROM parsed GROUP BY category"""),
    "filter_blank": _parsed("""
SELECT * FROM parsed WHERE customer_name IS NOT NULL AND trim(customer_name) != ''"""),
    "sales_statistics": _parsed(f"""
SELECT MIN(sales) AS minimum_sales, MAX(sales) AS maximum_sales, {avg2('sales')} AS average_sales
FROM parsed"""),
    "region_revenue_clean": _parsed(f"""
WITH {DEDUP}
SELECT region, {sum2('COALESCE(sales, CAST(0 AS DOUBLE))')} AS total_revenue
FROM d WHERE rn = 1 GROUP BY region"""),
    "dedup_by_key": _parsed(f"""
WITH {DEDUP}
SELECT {', '.join(SALES_COLS)} FROM d WHERE rn = 1"""),
}

_null_aggs = ",\n       ".join(
    (f"COUNT(*) FILTER (WHERE {c} IS NULL OR isnan({c})) AS {c}" if c in DOUBLE_COLS
     else f"COUNT(*) FILTER (WHERE {c} IS NULL) AS {c}") for c in SALES_COLS)
_head_order = ["order_id", "product_id", "ship_date", "quantity", "sales", "discount"]
_dup_cols = "customer_name, category, region, segment"


def _mean_fill_sql(src: str, cols_sql: str, text_cols: list[str], num_cols: list[str],
                   keep: list[str], order: list[str]) -> str:
    means = ", ".join(f"{avg2(c, 8)} AS m_{c}" for c in num_cols)
    out = []
    for c in order:
        if c in text_cols:
            out.append(f"COALESCE({c}, 'Unknown') AS {c}")
        elif c in num_cols:
            out.append(f"COALESCE(CAST({c} AS DOUBLE), m.m_{c}) AS {c}")
        else:
            out.append(c)
    return f"""raw AS (SELECT {cols_sql} FROM {src}),
m AS (SELECT {means} FROM raw),
filled AS (SELECT {', '.join(out)} FROM raw, m)"""


_impute_cols = ["order_id", "customer_name", "category", "sales", "quantity"]
_backpack = _mean_fill_sql("parsed", "product_name, category, sales AS price, quantity",
                           ["product_name", "category"], ["price", "quantity"], [],
                           ["product_name", "category", "price", "quantity"])
_impute_mean = _mean_fill_sql("parsed", ", ".join(_impute_cols), ["customer_name"],
                              ["sales", "quantity"], [], _impute_cols)

_TYPE_NAMES = ("CASE {t} WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' "
               "WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' "
               "WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'BOOLEAN' THEN 'boolean' ELSE {t} END")
_schema_rows = "\nUNION ALL\n".join(
    f"SELECT {i} AS position, '{c}' AS column_name, "
    f"{_TYPE_NAMES.format(t=f'ANY_VALUE(typeof({c}))')} AS data_type, COUNT({c}) AS non_null_count "
    f"FROM sales" for i, c in enumerate(SALES_COLS))

PROFILE_CLEAN_SQL = {
    "profile_schema": _sales(_schema_rows),
    "profile_head": _sales(f"SELECT * FROM sales ORDER BY {', '.join(_head_order)} LIMIT 5"),
    "profile_tail": _sales(f"""
SELECT * FROM sales ORDER BY {', '.join(c + ' DESC' for c in _head_order)} LIMIT 5"""),
    "profile_nulls": _parsed(f"""
WITH w AS (SELECT {_null_aggs} FROM parsed)
SELECT column_name, null_count FROM (UNPIVOT w ON {', '.join(SALES_COLS)}
                                     INTO NAME column_name VALUE null_count)"""),
    "profile_dup_count": _sales(f"""
SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT COUNT(*) AS n FROM sales GROUP BY {_dup_cols})"""),
    "select_cols": _sales("SELECT sales, quantity FROM sales"),
    "derive_amount": with_views("""
SELECT order_id, product_id, unit_price, quantity, unit_price * quantity AS total_amount
FROM order_items""", "order_items"),
    "cleaning_summary": _parsed(f"""
WITH {_backpack},
final AS (SELECT DISTINCT * FROM filled)
SELECT CAST(4 AS BIGINT) AS original_columns, CAST(5 AS BIGINT) AS final_columns,
       (SELECT COUNT(*) FROM final) AS total_records,
       (SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT)
        FROM (SELECT COUNT(*) AS n FROM filled GROUP BY product_name, category, price, quantity))
           AS duplicates_removed"""),
    "impute_mean": _parsed(f"""
WITH {_impute_mean}
SELECT * FROM filled"""),
    "impute_median": _parsed(f"""
WITH raw AS (SELECT {', '.join(_impute_cols)} FROM parsed),
m AS (SELECT {round_half_up('quantile_cont(CAST(sales AS DOUBLE), 0.5)', 8)} AS m_sales,
             {round_half_up('quantile_cont(CAST(quantity AS DOUBLE), 0.5)', 8)} AS m_quantity FROM raw)
SELECT order_id, COALESCE(customer_name, 'Unknown') AS customer_name, category,
       COALESCE(CAST(sales AS DOUBLE), m.m_sales) AS sales,
       COALESCE(CAST(quantity AS DOUBLE), m.m_quantity) AS quantity
FROM raw, m"""),
    "bucketed_status_revenue": with_views("""
SELECT status, COUNT(DISTINCT order_id) AS orders, COUNT(*) AS lines,
       CAST(ROUND(SUM(revenue), 2) AS DOUBLE) AS revenue
FROM order_items JOIN orders_v USING (order_id) GROUP BY status""", "order_items", "orders_v"),
    "median_approx": _sales("""
SELECT column_name, COUNT(value) AS n_values, TRUE AS within_tolerance
FROM (SELECT CAST(sales AS DOUBLE) AS sales, CAST(quantity AS DOUBLE) AS quantity,
             CAST(profit AS DOUBLE) AS profit FROM sales)
UNPIVOT INCLUDE NULLS (value FOR column_name IN (sales, quantity, profit)) GROUP BY column_name"""),
    "dedup_rows": _sales(f"SELECT DISTINCT {_dup_cols} FROM sales"),
    "trim_text": with_views(r"""
SELECT product_id,
       regexp_replace(product_name, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS product_name,
       regexp_replace(category, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS category,
       regexp_replace(subcategory, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS subcategory,
       cost_price
FROM products_dirty""", "products_dirty"),
    "title_case": with_views(r"""
SELECT product_id,
       array_to_string(list_transform(
           regexp_extract_all(regexp_replace(product_name, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'),
                              '(\p{L}+|[^\p{L}]+)'),
           lambda x: upper(x[1]) || lower(x[2:])), '') AS product_name,
       category, subcategory, cost_price
FROM products_dirty""", "products_dirty"),
    "convert_types": with_views("""
SELECT order_id, TRY_CAST(customer_id AS BIGINT) AS customer_id, order_date, status
FROM orders_dirty""", "orders_dirty"),
    "cap_outliers": _sales("""
WITH base AS (SELECT order_id, product_id, sales, profit FROM sales),
q AS (SELECT quantile_cont(sales, 0.25) AS s1, quantile_cont(sales, 0.75) AS s3,
             quantile_cont(profit, 0.25) AS p1, quantile_cont(profit, 0.75) AS p3 FROM base)
SELECT order_id, product_id,
       LEAST(GREATEST(sales, s1 - CAST(1.5 AS DOUBLE) * (s3 - s1)), s3 + CAST(1.5 AS DOUBLE) * (s3 - s1)) AS sales,
       LEAST(GREATEST(profit, p1 - CAST(1.5 AS DOUBLE) * (p3 - p1)), p3 + CAST(1.5 AS DOUBLE) * (p3 - p1)) AS profit
FROM base, q"""),
    "flag_missing": with_views("""
SELECT order_id, NULLIF(customer_id, '') AS customer_id,
       NULLIF(customer_id, '') IS NULL AS customer_id_missing
FROM orders_dirty""", "orders_dirty"),
    "parse_two_formats": with_views("""
SELECT order_id,
       COALESCE(TRY_STRPTIME(order_date, '%Y-%m-%d %H:%M:%S'), TRY_STRPTIME(order_date, '%d-%m-%Y')) AS order_date,
       COALESCE(TRY_STRPTIME(order_date, '%Y-%m-%d %H:%M:%S'), TRY_STRPTIME(order_date, '%d-%m-%Y')) IS NULL
           AS order_date_unparseable
FROM orders_dirty""", "orders_dirty"),
    "normalise_separators": with_views("""
SELECT order_id, TRY_STRPTIME(replace(order_date, '/', '-'), '%m-%d-%Y') AS order_date
FROM mixed_date_text""", "mixed_date_text"),
}

AS_OF = "2001-06-01"


def _rule(name: str, src: str, id_col: str | None) -> str:
    if id_col is None:
        ids = "''"
    else:
        ids = (f"COALESCE((SELECT string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) FROM "
               f"(SELECT CAST({id_col} AS BIGINT) AS i FROM ({src}) WHERE {id_col} IS NOT NULL "
               f"ORDER BY i LIMIT 20)), '')")
    return (f"SELECT '{name}' AS rule, (SELECT COUNT(*) FROM ({src})) AS n_bad, "
            f"{ids} AS sample_ids")


_rules = [
    _rule("orders_missing_customer",
          "SELECT order_id FROM orders_dirty WHERE NULLIF(customer_id, '') IS NULL", "order_id"),
    _rule("orders_unparseable_date",
          "SELECT order_id FROM orders_dirty WHERE COALESCE(TRY_STRPTIME(order_date, '%Y-%m-%d %H:%M:%S'), "
          "TRY_STRPTIME(order_date, '%d-%m-%Y')) IS NULL", "order_id"),
    _rule("customers_invalid_email",
          r"SELECT customer_id FROM customers WHERE NOT regexp_matches(COALESCE(email, ''), '^[^@\s]+@[^@\s]+\.[^@\s]+$')",
          "customer_id"),
    _rule("items_without_order",
          "SELECT order_id FROM order_items_dirty ANTI JOIN orders_v USING (order_id)", "order_id"),
    _rule("items_negative_quantity", "SELECT 1 AS x FROM order_items_dirty WHERE quantity < 0", None),
    _rule("items_discount_over_100", "SELECT 1 AS x FROM order_items_dirty WHERE discount_percent > 100", None),
    _rule("items_zero_quantity", "SELECT 1 AS x FROM order_items_dirty WHERE quantity = 0", None),
    _rule("orders_in_future",
          f"SELECT order_id FROM orders_v WHERE order_date > TIMESTAMP '{AS_OF}'", "order_id"),
    _rule("customers_repeated_key",
          "SELECT customer_id FROM customers GROUP BY customer_id HAVING COUNT(*) > 1", "customer_id"),
]

QUALITY_SQL = {
    "dq_email": with_views(r"""
SELECT customer_id, email FROM customers
WHERE NOT regexp_matches(COALESCE(email, ''), '^[^@\s]+@[^@\s]+\.[^@\s]+$')""", "customers"),
    "dq_orphans": with_views("""
SELECT order_id, product_id, line_number FROM order_items_dirty ANTI JOIN orders_v USING (order_id)""",
                             "order_items_dirty", "orders_v"),
    "dq_discount": with_views("""
SELECT order_id, product_id, line_number, discount_percent FROM order_items_dirty
WHERE discount_percent > 100""", "order_items_dirty"),
    "dq_zero_qty": with_views("""
SELECT order_id, product_id, line_number, quantity FROM order_items_dirty WHERE quantity = 0""",
                              "order_items_dirty"),
    "items_revenue": with_views(f"""
SELECT order_id, product_id, line_number,
       {money("CAST(quantity AS DECIMAL(18,0)) * CAST(unit_price AS DECIMAL(18,2)) * (100 - CAST(discount_percent AS DECIMAL(9,2))) / 100", 4)} AS revenue
FROM order_items_dirty""", "order_items_dirty"),
    "dq_future": with_views(f"""
SELECT order_id, order_date FROM orders_v WHERE order_date > TIMESTAMP '{AS_OF}'""", "orders_v"),
    "dq_report": with_views("\nUNION ALL\n".join(_rules),
                            "orders_dirty", "customers", "order_items_dirty", "orders_v"),
}

SOURCES_SQL = {
    "csv_roundtrip": with_views("SELECT * FROM products_dirty", "products_dirty"),
    "csv_null_policy": with_views("""
SELECT order_id, NULLIF(customer_id, '') AS customer_id, order_date, status FROM orders_dirty""",
                                  "orders_dirty"),
    "csv_inferred": with_views("""
SELECT CAST(product_id AS INTEGER) AS product_id, category, cost_price FROM products""", "products"),
    "scan_limit": "SELECT * FROM customer ORDER BY c_custkey LIMIT 100",
    "parquet_roundtrip": _sales("SELECT * FROM sales"),
    "load_counts": with_views("""
SELECT 'customers' AS table_name, COUNT(*) AS row_count FROM customers
UNION ALL SELECT 'products', COUNT(*) FROM products
UNION ALL SELECT 'orders', COUNT(*) FROM orders_v
UNION ALL SELECT 'order_items', COUNT(*) FROM order_items""",
                              "customers", "products", "orders_v", "order_items"),
    "canonical_ts": with_views("""
SELECT order_id, strftime(order_date, '%Y-%m-%d %H:%M:%S') AS order_date FROM orders_v""",
                               "orders_v"),
}

_TARGET = """tgt AS (SELECT order_id, customer_id, order_date, status, total_price FROM orders_v),
batch AS (
    SELECT order_id, customer_id, order_date, status,
           CAST(ROUND(CAST(total_price AS DECIMAL(18,2)) * CAST(1.1 AS DECIMAL(4,2)), 2) AS DOUBLE) AS total_price
    FROM tgt WHERE order_id % 75 = 0
    UNION ALL
    SELECT order_id + (SELECT MAX(order_id) FROM tgt) + 1, customer_id, order_date, status, total_price
    FROM tgt WHERE order_id % 100 = 1),
res AS (
    SELECT CASE WHEN b.order_id IS NOT NULL THEN b.order_id ELSE t.order_id END AS order_id,
           CASE WHEN b.order_id IS NOT NULL THEN b.customer_id ELSE t.customer_id END AS customer_id,
           CASE WHEN b.order_id IS NOT NULL THEN b.order_date ELSE t.order_date END AS order_date,
           CASE WHEN b.order_id IS NOT NULL THEN b.status ELSE t.status END AS status,
           CASE WHEN b.order_id IS NOT NULL THEN b.total_price ELSE t.total_price END AS total_price,
           CASE WHEN b.order_id IS NOT NULL AND t.order_id IS NOT NULL THEN 'update'
                WHEN b.order_id IS NOT NULL THEN 'insert' ELSE 'unchanged' END AS op,
           t.total_price AS old_total_price
    FROM tgt t FULL OUTER JOIN batch b ON t.order_id = b.order_id)"""


def _merge(sql: str) -> str:
    return with_views(f"WITH {_TARGET}\n{sql}", "orders_v")


MERGE_SQL = {
    "merge_batch": _merge("SELECT * FROM batch"),
    "merge_upsert": _merge("SELECT order_id, customer_id, order_date, status, total_price FROM res"),
    "merge_stream": _merge("SELECT order_id, customer_id, order_date, status, total_price FROM res"),
    "merge_changes": _merge("""
SELECT order_id, op, old_total_price, total_price AS new_total_price FROM res WHERE op != 'unchanged'"""),
    "merge_validation": _merge("""
SELECT (SELECT COUNT(*) FROM tgt) AS rows_before, COUNT(*) AS rows_after,
       COUNT(*) FILTER (WHERE op = 'insert') AS inserted,
       COUNT(*) FILTER (WHERE op = 'update') AS updated,
       COUNT(*) FILTER (WHERE op = 'unchanged') AS unchanged,
       (SELECT COUNT(*) FROM (SELECT order_id FROM res GROUP BY order_id HAVING COUNT(*) > 1)) AS duplicate_keys_after,
       (SELECT COALESCE(BOOL_AND(r.total_price IS NOT DISTINCT FROM b.total_price), TRUE)
        FROM res r JOIN batch b ON r.order_id = b.order_id WHERE r.op = 'update') AS updated_values_match
FROM res"""),
    "merge_history": _merge("""
SELECT CAST(0 AS BIGINT) AS version, 'WRITE' AS operation, COUNT(*) AS rows_inserted,
       CAST(0 AS BIGINT) AS rows_updated, COUNT(*) AS rows_total FROM tgt
UNION ALL
SELECT CAST(1 AS BIGINT), 'MERGE', COUNT(*) FILTER (WHERE op = 'insert'),
       COUNT(*) FILTER (WHERE op = 'update'), COUNT(*) FROM res"""),
}

_TWO = """tgt AS (SELECT order_id, SUM(CAST(sales AS DECIMAL(30,8))) AS s, SUM(CAST(profit AS DECIMAL(30,8))) AS p
        FROM sales GROUP BY order_id),
t2 AS (SELECT order_id, CAST(ROUND(s, 2) AS DOUBLE) AS sales, CAST(ROUND(p, 2) AS DOUBLE) AS profit FROM tgt),
b2 AS (SELECT order_id, CAST(ROUND(CAST(sales AS DECIMAL(18,2)) * CAST(1.1 AS DECIMAL(4,2)), 2) AS DOUBLE) AS sales,
              CAST(ROUND(CAST(profit AS DECIMAL(18,2)) * CAST(1.1 AS DECIMAL(4,2)), 2) AS DOUBLE) AS profit
       FROM t2 WHERE order_id % 75 = 0
       UNION ALL
       SELECT order_id + (SELECT MAX(order_id) FROM t2) + 1, sales, profit FROM t2 WHERE order_id % 100 = 1)"""
MERGE_SQL["merge_two_columns"] = _sales(f"""
WITH {_TWO}
SELECT * FROM b2 UNION ALL SELECT * FROM t2 ANTI JOIN b2 USING (order_id)""")

MORE_SQL = {**CUSTOMER_SALES_SQL, **SALES_SQL, **PARSED_SQL, **PROFILE_CLEAN_SQL, **QUALITY_SQL,
            **SOURCES_SQL, **MERGE_SQL}
