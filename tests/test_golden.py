"""Published outputs of the original customer-sales statements, replayed.

The fixture files hold the published per-customer totals with their ranks (793 customers),
the customers above the average total (299) and the top three.  Each total is fed back as
one order line per customer, so the totals, the above-average set, the ranks and the top
three must come out as published.
"""

import csv
import os

from tillpoint.plans import customer_sales as CS

HERE = os.path.join(os.path.dirname(__file__), "fixtures")


def _read(name):
    with open(os.path.join(HERE, name)) as f:
        return list(csv.reader(f))[1:]


def _lines(spark):
    rows = _read("golden_customer_rank.csv")
    data = [(i, cid, 1, 1, float(total)) for i, (cid, total, _) in enumerate(rows)]
    return spark.createDataFrame(
        data, "order_id long, customer_id string, product_id long, quantity int, sales double")


def test_totals_round_to_published(spark):
    rows = _read("golden_customer_rank.csv")
    got = {r["customer_id"]: r["total_sales"] for r in CS.sales_per_customer(_lines(spark)).collect()}
    assert len(got) == 793
    for cid, total, _ in rows:
        assert abs(got[cid] - float(total)) < 0.00006


def test_above_average_set_is_published_set(spark):
    want = {cid for cid, _ in _read("golden_customers_above_avg.csv")}
    got = {r["customer_id"] for r in CS.customers_above_average(_lines(spark)).collect()}
    assert len(want) == 299
    assert got == want


def test_ranks_are_published_ranks(spark):
    want = {cid: int(rank) for cid, _, rank in _read("golden_customer_rank.csv")}
    got = {r["customer_id"]: r["sales_rank"] for r in
           CS.customer_sales_rank(_lines(spark), rows_per_bucket=50).collect()}
    assert got == want


def test_top_three_is_published(spark):
    want = [cid for cid, _ in _read("golden_top3.csv")]
    got = [r["customer_id"] for r in
           CS.top_customers_by_rank(_lines(spark), 3).orderBy("total_sales", ascending=False).collect()]
    assert got == want
