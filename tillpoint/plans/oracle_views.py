"""The retail views as DuckDB SQL, written independently of the DataFrame code.

``with_views(sql, names)`` prefixes a query with the CTEs it needs, so that every oracle
statement runs on the base tables the driver registers.
"""

from __future__ import annotations

import re

VIEW_SQL: dict[str, str] = {
    "order_items": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, l_linenumber AS line_number,
               CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INTEGER) AS quantity,
               l_extendedprice / l_quantity AS unit_price,
               l_discount * CAST(100.0 AS DOUBLE) AS discount_percent,
               CASE WHEN l_returnflag = 'R'
                    THEN -(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))))
                    ELSE CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) END AS revenue
        FROM lineitem""",
    "products": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
               p_brand AS subcategory, p_retailprice AS cost_price
        FROM part""",
    "geo": """
        SELECT c_custkey, n_name, r_name
        FROM customer JOIN nation ON c_nationkey = n_nationkey
                      JOIN region ON n_regionkey = r_regionkey""",
    "orders_v": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
               CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'O' THEN 'PLACED'
                                  WHEN 'P' THEN 'SHIPPED' ELSE o_orderstatus END AS status,
               o_totalprice AS total_price, g.r_name AS region_code
        FROM orders LEFT JOIN geo g ON o_custkey = g.c_custkey""",
    "customers": """
        SELECT c_custkey AS customer_id, c_name AS customer_name,
               CASE WHEN c_custkey % 97 = 5 THEN NULL
                    WHEN c_custkey % 50 = 7 THEN lower(replace(c_name, '#', '.')) || '.example.com'
                    WHEN c_custkey % 50 = 13 THEN lower(replace(c_name, '#', '.')) || '@'
                    ELSE lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
               f.registration_date, c_mktsegment AS customer_type
        FROM customer LEFT JOIN (SELECT o_custkey, MIN(o_orderdate) AS registration_date
                                 FROM orders GROUP BY o_custkey) f ON c_custkey = f.o_custkey""",
    "sales": """
        SELECT l_orderkey AS order_id, o_orderdate AS order_date, l_shipdate AS ship_date,
               o_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment,
               g.n_name AS city, g.r_name AS region, l_partkey AS product_id,
               p_name AS product_name, p_type AS category,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS sales,
               CAST(l_quantity AS INTEGER) AS quantity, l_discount AS discount,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                    - CAST(p_retailprice AS DECIMAL(18,2)) * CAST(l_quantity AS DECIMAL(18,0)) AS DOUBLE) AS profit
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                      JOIN customer ON o_custkey = c_custkey
                      JOIN geo g ON customer.c_custkey = g.c_custkey
                      JOIN part ON l_partkey = p_partkey""",
    "sales_dirty": """
        SELECT order_id, order_date, ship_date, customer_id,
               CASE WHEN order_id % 20 = 0 THEN NULL WHEN order_id % 20 = 1 THEN '  '
                    ELSE customer_name END AS customer_name,
               segment, city, region, product_id, product_name, category,
               CASE WHEN product_id % 50 = 0 THEN 'null' WHEN product_id % 50 = 1 THEN ''
                    WHEN product_id % 50 = 2 THEN 'NULL'
                    ELSE CAST(CAST(sales AS DECIMAL(18,4)) AS VARCHAR) END AS sales,
               quantity, discount, profit
        FROM sales""",
    "orders_dirty": """
        SELECT o_orderkey AS order_id,
               CASE WHEN o_orderkey % 20 = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
               CASE WHEN o_orderkey % 101 = 0 THEN 'not a date'
                    WHEN o_orderkey % 12 = 0 THEN strftime(o_orderdate, '%d-%m-%Y')
                    ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS order_date,
               CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'O' THEN 'PLACED'
                                  WHEN 'P' THEN 'SHIPPED' ELSE o_orderstatus END AS status
        FROM orders""",
    "products_dirty": """
        SELECT product_id,
               CASE WHEN product_id % 7 = 0 THEN '  ' || product_name || ' '
                    WHEN product_id % 7 = 1 THEN upper(product_name)
                    WHEN product_id % 7 = 2 THEN chr(9) || product_name || chr(10)
                    WHEN product_id % 7 = 3 THEN upper(replace(product_name, ' ', '-'))
                    ELSE product_name END AS product_name,
               category, subcategory, cost_price
        FROM products""",
}

VIEW_SQL["order_lines"] = """
        SELECT l_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS sales
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
VIEW_SQL["customer_names"] = """
        SELECT c_custkey AS customer_id, c_name AS customer_name FROM customer"""
VIEW_SQL["mixed_date_text"] = """
        SELECT o_orderkey AS order_id,
               CASE WHEN o_orderkey % 2 = 0
                    THEN CAST(month(o_orderdate) AS VARCHAR) || '/' || CAST(day(o_orderdate) AS VARCHAR) || '/' || CAST(year(o_orderdate) AS VARCHAR)
                    ELSE CAST(month(o_orderdate) AS VARCHAR) || '-' || CAST(day(o_orderdate) AS VARCHAR) || '-' || CAST(year(o_orderdate) AS VARCHAR)
               END AS order_date
        FROM orders"""

VIEW_SQL["orders_clean"] = """
        SELECT d.order_id, TRY_CAST(NULLIF(d.customer_id, '') AS BIGINT) AS customer_id,
               COALESCE(TRY_STRPTIME(d.order_date, '%Y-%m-%d %H:%M:%S'),
                        TRY_STRPTIME(d.order_date, '%d-%m-%Y')) AS order_date,
               d.status, g.r_name AS region_code
        FROM orders_dirty d LEFT JOIN geo g ON TRY_CAST(NULLIF(d.customer_id, '') AS BIGINT) = g.c_custkey"""
VIEW_SQL["order_items_dirty"] = """
        SELECT CASE WHEN l_orderkey % 211 = 5 THEN l_orderkey + 1000000000 ELSE l_orderkey END AS order_id,
               l_partkey AS product_id, l_linenumber AS line_number,
               CASE WHEN l_partkey % 50 = 3 THEN 0
                    ELSE CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INTEGER) END AS quantity,
               l_extendedprice AS unit_price,
               CASE WHEN l_suppkey % 10 = 7 THEN CAST(150.0 AS DOUBLE)
                    ELSE ROUND(l_discount * CAST(100.0 AS DOUBLE), 2) END AS discount_percent
        FROM lineitem"""

VIEW_DEPS = {
    "orders_clean": ["orders_dirty", "geo"],
    "orders_v": ["geo"],
    "sales": ["geo"],
    "sales_dirty": ["sales"],
    "products_dirty": ["products"],
}


def _resolve(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        for d in VIEW_DEPS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTEs of the named views (and what they depend on)."""
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n]})" for n in _resolve(names))
    body = sql.strip()
    if re.match(r"(?is)^with\s", body):
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


# Rounding helpers for the oracle text, matching tillpoint.functions.exprs.
def money(expr: str, digits: int = 2) -> str:
    return f"CAST(ROUND({expr}, {digits}) AS DOUBLE)"


def round_half_up(expr: str, digits: int = 2) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def percent(num: str, den: str, digits: int = 2) -> str:
    return (f"CASE WHEN CAST({den} AS DOUBLE) IS NULL OR CAST({den} AS DOUBLE) = 0 THEN NULL "
            f"ELSE {round_half_up(f'CAST(100.0 AS DOUBLE) * CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE)', digits)} END")
