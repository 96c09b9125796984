"""Report functions on literal fixtures, against brute force."""

import itertools
import random
from collections import Counter

from tillpoint.plans import retail as R


def test_bought_together_hot_orders_are_salted_without_changing_counts(spark):
    rnd = random.Random(4)
    items, names = [], {}
    for p in range(1, 61):
        names[p] = f"name{p % 9}"
    # one huge order (a third of the lines) and many small ones
    for p in range(1, 61):
        for _ in range(rnd.randint(1, 2)):
            items.append((1, p))
    for o in range(2, 80):
        for p in rnd.sample(range(1, 61), rnd.randint(1, 5)):
            items.append((o, p))
    df = spark.createDataFrame(items, "order_id long, product_id long")
    prods = spark.createDataFrame(list(names.items()), "product_id long, product_name string")
    brute = Counter()
    by_order = {}
    for o, p in items:
        by_order.setdefault(o, []).append(p)
    for o, ps in by_order.items():
        for a, b in itertools.product(ps, ps):
            if a < b:
                brute[(names[a], names[b])] += 1
    want = sorted(brute.items(), key=lambda kv: (-kv[1], kv[0]))[:20]
    for chunk in (500, 7, 1):
        got = [((r["product_a"], r["product_b"]), r["times_bought_together"]) for r in
               R.bought_together(df, prods, 20, chunk=chunk).collect()]
        assert got == want, chunk


def test_dense_rank_in_category_with_ties(spark):
    items = spark.createDataFrame(
        [(1, p, 1, 0.0, __import__("decimal").Decimal(v)) for p, v in
         [(1, "10"), (2, "10"), (3, "5"), (4, "7"), (5, "7"), (6, "1")]],
        "order_id long, product_id long, quantity int, discount_percent double, revenue decimal(18,2)")
    prods = spark.createDataFrame([(p, f"n{p}", "c" if p < 6 else "d") for p in range(1, 7)],
                                  "product_id long, product_name string, category string")
    got = {r["product_name"]: r["rank_in_category"] for r in R.rank_in_category(items, prods).collect()}
    assert got == {"n1": 1, "n2": 1, "n4": 2, "n5": 2, "n3": 3, "n6": 1}


def _retail(spark):
    from datetime import datetime
    from decimal import Decimal

    orders = spark.createDataFrame(
        [(1, 10, datetime(2020, 1, 5), "DELIVERED"), (2, 10, datetime(2020, 1, 20), "PLACED"),
         (3, 11, datetime(2020, 2, 3), "PLACED"), (4, None, datetime(2020, 2, 4), "PLACED"),
         (5, 12, datetime(2020, 2, 10), "SHIPPED")],
        "order_id long, customer_id long, order_date timestamp_ntz, status string")
    items = spark.createDataFrame(
        [(1, 100, 2, Decimal("20.00")), (2, 101, 1, Decimal("5.50")), (3, 100, -1, Decimal("-10.00")),
         (4, 102, 3, Decimal("9.00"))],
        "order_id long, product_id long, quantity int, revenue decimal(18,2)")
    products = spark.createDataFrame([(100, "Alpha", "A"), (101, "Beta", "B"), (102, "Gamma", "A")],
                                     "product_id long, product_name string, category string")
    return items, orders, products


def test_period_without_orders_reports_zeros_and_no_change(spark):
    items, orders, products = _retail(spark)
    rows = {r["period"]: r for r in
            R.period_report(items, orders, products, "2021-01-01", "2021-02-01").collect()}
    cur = rows["current"]
    assert (cur["total_orders"], cur["revenue"], cur["unique_customers"]) == (0, 0.0, 0)
    assert cur["orders_change_pct"] is None and cur["top_1"] is None


def test_period_report_counts_orders_without_items_and_skips_null_customers(spark):
    items, orders, products = _retail(spark)
    rows = {r["period"]: r for r in
            R.period_report(items, orders, products, "2020-02-01", "2020-03-01").collect()}
    cur, prev = rows["current"], rows["previous"]
    assert (cur["total_orders"], cur["unique_customers"], cur["revenue"]) == (3, 2, -1.0)
    assert (prev["total_orders"], prev["unique_customers"], prev["revenue"]) == (2, 1, 25.5)
    assert cur["orders_change_pct"] == 50.0
    assert (cur["top_1"], cur["top_1_revenue"], cur["top_2"]) == ("Gamma", 9.0, "Alpha")


def test_one_order_customer_has_no_gap_rows(spark):
    _, orders, _ = _retail(spark)
    got = R.order_gaps(orders, risk_days=10).collect()
    assert {r["customer_id"] for r in got} == {10}
    first, second = sorted(got, key=lambda r: r["order_date"])
    assert first["previous_order_date"] is None and second["days_gap"] == 15.0
    assert second["risk_flag"] == "At Risk"


def test_empty_inputs(spark):
    from tillpoint.operators.clean import exact_quantiles
    from tillpoint.operators.topk import top_k_with_ties
    from tillpoint.operators.windows import ordered_window

    empty = spark.createDataFrame([], "id long, v double")
    assert ordered_window(empty, [("v", False), ("id", True)], ntile=("t", 4)).count() == 0
    assert exact_quantiles(empty, {"v": [0.5]}) == {"v": [None]}
    assert top_k_with_ties(empty, "v", 3).count() == 0


def test_undated_orders_do_not_count_as_gaps(spark):
    from datetime import datetime

    day = lambda n: datetime(2020, 1, 1 + n)
    orders = spark.createDataFrame(
        [(1, 7, day(0)), (2, 7, day(10)), (3, 7, None),   # gap 10 over one dated pair
         (4, 8, day(0)), (5, 8, None), (6, 9, day(3))],   # fewer than two dated orders
        "order_id long, customer_id long, order_date timestamp_ntz")
    rows = R.order_gaps(orders, risk_days=7).collect()
    assert {(r["customer_id"], r["risk_flag"]) for r in rows} == {(7, "At Risk")}
    assert sorted(r["days_gap"] or 0 for r in rows) == [0, 0, 10.0]


def test_many_undated_orders(spark):
    from datetime import datetime, timedelta

    orders = spark.createDataFrame(
        [(i, i % 40, None if i % 5 == 0 else datetime(2020, 1, 1) + timedelta(hours=7 * i))
         for i in range(1000)], "order_id long, customer_id long, order_date timestamp_ntz")
    assert R.order_gaps(orders).count() == sum(1 for i in range(1000) if i % 40 % 5)


def test_previous_period_and_ranges():
    import pytest

    assert R.previous_period("2020-03-01", "2020-03-08") == ("2020-02-23", "2020-03-01")
    assert R.report_range("daily", "2020-03-01") == ("2020-02-29", "2020-03-01")
    with pytest.raises(ValueError):
        R.report_range("yearly", "2020-03-01")
