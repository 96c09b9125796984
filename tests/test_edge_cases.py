"""Data-quality rules on literal frames."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tillpoint.functions.exprs import line_revenue
from tillpoint.operators import quality as Q


ITEMS = ("item_id long, order_id long, product_id long, quantity int, unit_price double, "
         "discount_percent double")


def _items(spark, *rows):
    """(item, order, quantity, price, discount) rows as order items."""
    return spark.createDataFrame([(i, o, 40 + i, q, p, d) for i, o, q, p, d in rows], ITEMS)


def test_orphans_are_items_of_unknown_orders(spark):
    orders = spark.createDataFrame([(71, 3), (72, 4)], "order_id long, customer_id long")
    items = _items(spark, (1, 71, 3, 2.5, 0.0), (2, 808, 1, 4.0, 0.0), (3, 909, 2, 1.0, 5.0))
    assert sorted(r["order_id"] for r in Q.orphans(items, orders, "order_id").collect()) == [808, 909]


def test_discount_above_the_whole_price(spark):
    items = _items(spark, (7, 1, 2, 30.0, 100.5), (8, 1, 4, 25.0, 100.0), (9, 1, 3, 8.0, 25.0))
    assert [r["item_id"] for r in Q.discount_over_100(items).collect()] == [7]
    revenue = {r["item_id"]: float(r["r"]) for r in
               items.select("item_id", line_revenue().alias("r")).collect()}
    assert revenue == {7: -0.3, 8: 0.0, 9: 18.0}


def test_quantities_of_zero_and_returns(spark):
    items = _items(spark, (1, 5, 0, 19.9, 10.0), (2, 5, 6, 19.9, 0.0), (3, 5, -6, 19.9, 0.0))
    assert [r["item_id"] for r in Q.zero_quantity(items).collect()] == [1]
    assert [r["item_id"] for r in Q.returns(items).collect()] == [3]
    assert float(items.agg(F.sum(line_revenue())).first()[0]) == 0.0


def test_orders_after_the_day_of_the_check(spark):
    noon = datetime(2031, 5, 4, 12)
    orders = spark.createDataFrame([(k, k, noon + timedelta(hours=h)) for k, h in
                                    ((21, -13), (22, -12), (23, -11), (24, 400))],
                                   "order_id long, customer_id long, order_date timestamp_ntz")
    late = Q.future_orders(orders, "2031-05-04")
    assert sorted(r["order_id"] for r in late.collect()) == [23, 24]


def test_email_rule_null_and_trailing_at_fail(spark):
    df = spark.createDataFrame(
        [(1, "a@b.com"), (2, "a.b.com"), (3, "a@"), (4, None), (5, "x y@b.com")],
        "customer_id long, email string")
    bad = sorted(r["customer_id"] for r in Q.invalid_emails(df).collect())
    assert bad == [2, 3, 4, 5]


def test_dq_report_sample_is_numeric_order_and_bounded(spark):
    orders_clean = spark.createDataFrame(
        [(i, i % 2 == 0, False) for i in range(1, 60)],
        "order_id long, customer_id_missing boolean, order_date_unparseable boolean")
    customers = spark.createDataFrame([(1, "a@b.com"), (1, "c@d.com")],
                                      "customer_id long, email string")
    items = spark.createDataFrame([(5, 1, 1, 1, 1.0, 0.0)],
                                  "order_id long, product_id long, line_number int, quantity int, "
                                  "unit_price double, discount_percent double")
    orders = spark.createDataFrame([(5, datetime(2020, 1, 1))], "order_id long, order_date timestamp_ntz")
    rep = {r["rule"]: r for r in Q.dq_report(orders_clean, customers, items, orders,
                                            "2021-01-01", sample=20).collect()}
    miss = rep["orders_missing_customer"]
    assert miss["n_bad"] == 29
    ids = [int(x) for x in miss["sample_ids"].split(",")]
    assert ids == list(range(2, 42, 2))
    assert rep["customers_repeated_key"]["n_bad"] == 1
    assert rep["items_without_order"]["n_bad"] == 0


def test_scratch_folder_must_be_named_off_local_mode(tmp_path):
    from types import SimpleNamespace

    import pytest

    from tillpoint.session import checkpoint_dir

    def session(master, named=None, known=None):
        option = SimpleNamespace(isDefined=lambda: known is not None, get=lambda: known)
        sc = SimpleNamespace(getCheckpointDir=lambda: option)
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default=None: named or default),
            sparkContext=SimpleNamespace(master=master, setCheckpointDir=lambda p: None,
                                         _jsc=SimpleNamespace(sc=lambda: sc)))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(session("yarn"))
    assert checkpoint_dir(session("yarn", named="hdfs://x/y")) == "hdfs://x/y"
    assert checkpoint_dir(session("k8s://h", known="hdfs://x/z")) == "hdfs://x/z"


def test_replaced_table_is_read_anew(spark, scratch):
    import os
    import time

    from tillpoint.sources.tables import Tables

    path = os.path.join(scratch, "region.parquet")
    spark.range(3).write.parquet(path)
    assert Tables(spark, scratch).region.count() == 3
    assert Tables(spark, scratch).region is Tables(spark, scratch).region
    time.sleep(0.01)
    spark.range(5).write.mode("overwrite").parquet(path)
    assert Tables(spark, scratch).region.count() == 5
