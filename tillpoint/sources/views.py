"""Retail views over the TPC-H-style test tables.

The reports are written against an e-commerce model (order_items, products, orders,
customers) and a denormalised ``sales`` line table.  These functions derive those relations
from the driver's tables with ordinary projections and joins, so every report reads the
given tables and its work grows with them.  The ``*_dirty`` views add deterministic dirt
(missing ids, a second date format, padded names, null tokens) so that the cleaning
operators have something to clean; the same rules are written in the SQL oracle.

Mapping (fixed values of the test model):
  order_items: order_id=l_orderkey, product_id=l_partkey, quantity = -l_quantity when
               l_returnflag = 'R' (a return) else l_quantity, unit_price = extendedprice /
               quantity, discount_percent = 100 * l_discount
  products:    product_id=p_partkey, product_name=p_name, category=p_type,
               subcategory=p_brand, cost_price=p_retailprice
  orders:      status F -> DELIVERED, O -> PLACED, P -> SHIPPED; region_code = region name
  customers:   registration_date = first order date of the customer
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpoint.functions.exprs import dec, line_revenue
from tillpoint.operators.clean import clean_orders
from tillpoint.sources.tables import Tables

# Order status codes of the test tables and their retail names.
STATUS_NAMES = {"F": "DELIVERED", "O": "PLACED", "P": "SHIPPED"}


def _status(code: Column) -> Column:
    out = None
    for k, v in STATUS_NAMES.items():
        out = F.when(code == k, v) if out is None else out.when(code == k, v)
    return out.otherwise(code)


def _net(price: Column, discount: Column) -> Column:
    """Price after discount: an amount with four decimals."""
    return dec(price, 18, 2) * (F.lit(1).cast("decimal(1,0)") - dec(discount, 4, 2))


def _signed_revenue(flag: Column, price: Column, discount: Column) -> Column:
    amount = _net(price, discount)
    return F.when(flag == "R", -amount).otherwise(amount)


def order_items(t: Tables) -> DataFrame:
    li = t.lineitem
    sign = F.when(F.col("l_returnflag") == "R", F.lit(-1)).otherwise(F.lit(1))
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("line_number"),
        (sign * F.col("l_quantity")).cast("int").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        (F.col("l_discount") * F.lit(100.0)).alias("discount_percent"),
        _signed_revenue(F.col("l_returnflag"), F.col("l_extendedprice"),
                        F.col("l_discount")).alias("revenue"),
    )


def products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.col("p_retailprice").alias("cost_price"),
    )


def customer_regions(t: Tables) -> DataFrame:
    """customer key -> nation name and region name (nation and region are fixed 25 / 5 rows)."""
    geo = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name")
    return t.customer.select("c_custkey", "c_nationkey").join(
        geo, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name", "r_name")


def orders(t: Tables, with_region: bool = False) -> DataFrame:
    o = t.orders
    cols = [
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        _status(F.col("o_orderstatus")).alias("status"),
        F.col("o_totalprice").alias("total_price"),
    ]
    if not with_region:
        return o.select(*cols)
    # The region lives on the customer; a left join keeps orders of unknown customers.
    cr = customer_regions(t).select("c_custkey", F.col("r_name").alias("region_code"))
    return o.join(cr, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        *cols, "region_code")


def _email(name: Column, key: Column) -> Column:
    base = F.lower(F.regexp_replace(name, "#", "."))
    m = F.pmod(key, F.lit(50))
    return (F.when(F.pmod(key, F.lit(97)) == 5, F.lit(None).cast("string"))
            .when(m == 7, F.concat(base, F.lit(".example.com")))
            .when(m == 13, F.concat(base, F.lit("@")))
            .otherwise(F.concat(base, F.lit("@example.com"))))


def customers(t: Tables) -> DataFrame:
    first = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("registration_date"))
    return t.customer.join(first, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        _email(F.col("c_name"), F.col("c_custkey")).alias("email"),
        F.col("registration_date"),
        F.col("c_mktsegment").alias("customer_type"),
    )


def sales(t: Tables) -> DataFrame:
    """One row per order line with order, customer, geography and product attributes."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice",
                           "l_discount", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    geo = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name")
    c = t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey").join(
        geo, F.col("c_nationkey") == F.col("n_nationkey"))
    p = t.part.select("p_partkey", "p_name", "p_type", "p_retailprice")
    net = _net(F.col("l_extendedprice"), F.col("l_discount"))
    cost = dec("p_retailprice", 18, 2) * dec("l_quantity", 18, 0)
    # Orders meet customers and geography first (an orders-sized join), so lines are shuffled
    # once by order key and once by part key; AQE broadcasts what turns out to be small.
    oc = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    joined = li.join(oc, F.col("l_orderkey") == F.col("o_orderkey"))
    return (joined.join(p, F.col("l_partkey") == F.col("p_partkey"))
            .select(
                F.col("l_orderkey").alias("order_id"),
                F.col("o_orderdate").alias("order_date"),
                F.col("l_shipdate").alias("ship_date"),
                F.col("o_custkey").alias("customer_id"),
                F.col("c_name").alias("customer_name"),
                F.col("c_mktsegment").alias("segment"),
                F.col("n_name").alias("city"),
                F.col("r_name").alias("region"),
                F.col("l_partkey").alias("product_id"),
                F.col("p_name").alias("product_name"),
                F.col("p_type").alias("category"),
                net.cast("double").alias("sales"),
                F.col("l_quantity").cast("int").alias("quantity"),
                F.col("l_discount").alias("discount"),
                (net - cost).cast("double").alias("profit"),
            ))


def sales_dirty(t: Tables) -> DataFrame:
    """``sales`` as raw text would arrive: sales as text with null tokens, blank names."""
    s = sales(t)
    pk = F.pmod(F.col("product_id"), F.lit(50))
    ok = F.pmod(F.col("order_id"), F.lit(20))
    sales_text = (F.when(pk == 0, F.lit("null")).when(pk == 1, F.lit(""))
                  .when(pk == 2, F.lit("NULL"))
                  .otherwise(dec("sales", 18, 4).cast("string")))
    name = (F.when(ok == 0, F.lit(None).cast("string")).when(ok == 1, F.lit("  "))
            .otherwise(F.col("customer_name")))
    return s.withColumn("sales", sales_text).withColumn("customer_name", name)


def orders_dirty(t: Tables) -> DataFrame:
    """Raw orders: customer id as text ('' when missing), order date in two formats."""
    o = orders(t)
    k = F.col("order_id")
    cust = F.when(F.pmod(k, F.lit(20)) == 0, F.lit("")).otherwise(
        F.col("customer_id").cast("string"))
    date_text = (F.when(F.pmod(k, F.lit(101)) == 0, F.lit("not a date"))
                 .when(F.pmod(k, F.lit(12)) == 0, F.date_format("order_date", "dd-MM-yyyy"))
                 .otherwise(F.date_format("order_date", "yyyy-MM-dd HH:mm:ss")))
    return o.select("order_id", cust.alias("customer_id"), date_text.alias("order_date"),
                    "status")


def orders_clean(t: Tables) -> DataFrame:
    """``orders_dirty`` after cleaning, as the reports meet it: NULL customers and dates.

    The region of an order comes from its customer; orders without one have none.
    """
    o = clean_orders(orders_dirty(t)).withColumn("customer_id", F.col("customer_id").cast("bigint"))
    cr = customer_regions(t).select("c_custkey", F.col("r_name").alias("region_code"))
    return (o.join(cr, F.col("customer_id") == F.col("c_custkey"), "left")
            .select("order_id", "customer_id", "order_date", "status", "region_code"))


def order_items_dirty(t: Tables) -> DataFrame:
    """Order items with orphans, discounts of 150 % and quantities of 0, by modulo rules.

    The unit price is the line's price, and the revenue follows the general formula.
    """
    li = t.lineitem
    sign = F.when(F.col("l_returnflag") == "R", F.lit(-1)).otherwise(F.lit(1))
    lost = F.pmod(F.col("l_orderkey"), F.lit(211)) == 5
    items = li.select(
        F.when(lost, F.col("l_orderkey") + 1_000_000_000).otherwise(F.col("l_orderkey"))
        .alias("order_id"),
        F.col("l_partkey").alias("product_id"), F.col("l_linenumber").alias("line_number"),
        F.when(F.pmod(F.col("l_partkey"), F.lit(50)) == 3, F.lit(0))
        .otherwise((sign * F.col("l_quantity")).cast("int")).alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        F.when(F.pmod(F.col("l_suppkey"), F.lit(10)) == 7, F.lit(150.0))
        .otherwise(F.round(F.col("l_discount") * F.lit(100.0), 2)).alias("discount_percent"))
    return items.withColumn("revenue", line_revenue())


def products_dirty(t: Tables) -> DataFrame:
    """Product names padded with spaces / tabs, or in upper case, by product id."""
    p = products(t)
    m = F.pmod(F.col("product_id"), F.lit(7))
    n = F.col("product_name")
    name = (F.when(m == 0, F.concat(F.lit("  "), n, F.lit(" ")))
            .when(m == 1, F.upper(n))
            .when(m == 2, F.concat(F.lit("\t"), n, F.lit("\n")))
            .when(m == 3, F.upper(F.regexp_replace(n, " ", "-")))
            .otherwise(n))
    return p.withColumn("product_name", name)


def order_lines(t: Tables) -> DataFrame:
    """Order lines with customer: order_id, customer_id, product_id, quantity, sales."""
    return t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"),
                           F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        _net(F.col("l_extendedprice"), F.col("l_discount")).cast("double").alias("sales"),
    )


def customer_names(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("customer_id"),
                             F.col("c_name").alias("customer_name"))


def mixed_date_text(t: Tables) -> DataFrame:
    """Order dates as text in two separator styles, M-d-yyyy and M/d/yyyy, by order key."""
    k = F.col("o_orderkey")
    text = F.when(F.pmod(k, F.lit(2)) == 0, F.date_format("o_orderdate", "M/d/yyyy")).otherwise(
        F.date_format("o_orderdate", "M-d-yyyy"))
    return t.orders.select(k.alias("order_id"), text.alias("order_date"))
