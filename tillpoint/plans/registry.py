"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillpoint.plans import params as P
from tillpoint.plans import retail as R
from tillpoint.sources import views as V
from tillpoint.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _t(spark: SparkSession, sf: str) -> Tables:
    return Tables(spark, sf)


# -- e-commerce reports ------------------------------------------------------------------

@register("category_revenue")
def _category_revenue(spark, sf):
    t = _t(spark, sf)
    return R.category_revenue(V.order_items(t), V.products(t))


@register("sql_category_revenue")
def _sql_category_revenue(spark, sf):
    """The same report as SQL text (S4): lines are summed per product before they meet it."""
    t = _t(spark, sf)
    return spark.sql("""
        WITH sold AS (SELECT product_id, sum(revenue) AS amount FROM {items} GROUP BY product_id)
        SELECT category, CAST(round(sum(amount), 2) AS DOUBLE) AS total_revenue
        FROM sold INNER JOIN {products} USING (product_id)
        GROUP BY category ORDER BY 2 DESC, 1""", items=V.order_items(t), products=V.products(t))


@register("top10_customers")
def _top10_customers(spark, sf):
    t = _t(spark, sf)
    return R.top_customers(V.order_items(t), V.orders(t), 10)


@register("monthly_orders_12m")
def _monthly_orders_12m(spark, sf):
    return R.monthly_orders_last_12m(V.orders(_t(spark, sf)))


@register("never_delivered")
def _never_delivered(spark, sf):
    return R.never_delivered(V.orders(_t(spark, sf)))


@register("more_returns")
def _more_returns(spark, sf):
    t = _t(spark, sf)
    return R.more_returns_than_purchases(V.order_items(t), V.products(t))


@register("return_rate")
def _return_rate(spark, sf):
    t = _t(spark, sf)
    return R.return_rate(V.order_items(t), V.products(t))


@register("running_revenue")
def _running_revenue(spark, sf):
    t = _t(spark, sf)
    return R.running_revenue(V.order_items(t), V.orders(t, with_region=True))


@register("rank_in_category")
def _rank_in_category(spark, sf):
    t = _t(spark, sf)
    return R.rank_in_category(V.order_items(t), V.products(t))


@register("order_gaps")
def _order_gaps(spark, sf):
    return R.order_gaps(V.orders(_t(spark, sf)), risk_days=P.RISK_DAYS)


@register("revenue_tiers")
def _revenue_tiers(spark, sf):
    t = _t(spark, sf)
    return R.revenue_tiers(V.order_items(t), V.orders(t), P.HIGH_TIER, P.MEDIUM_TIER)


@register("customer_quartiles")
def _customer_quartiles(spark, sf):
    t = _t(spark, sf)
    return R.customer_quartiles(V.order_items(t), V.orders(t))


@register("yoy_revenue")
def _yoy_revenue(spark, sf):
    t = _t(spark, sf)
    return R.yoy_revenue(V.order_items(t), V.orders(t))


@register("first_last_category")
def _first_last_category(spark, sf):
    t = _t(spark, sf)
    return R.first_last_category(V.order_items(t), V.orders(t), V.products(t))


@register("cumulative_revenue")
def _cumulative_revenue(spark, sf):
    t = _t(spark, sf)
    return R.cumulative_revenue(V.order_items(t), V.orders(t))


@register("cohort_retention")
def _cohort_retention(spark, sf):
    t = _t(spark, sf)
    return R.cohort_retention(V.orders(t), V.customers(t))


@register("bought_together")
def _bought_together(spark, sf):
    t = _t(spark, sf)
    return R.bought_together(V.order_items(t), V.products(t), 20)


@register("period_report")
def _period_report(spark, sf):
    t = _t(spark, sf)
    return R.period_report(V.order_items(t), V.orders(t), V.products(t),
                           P.PERIOD_START, P.PERIOD_END)


def _period_for(kind):
    def query(spark, sf):
        t = _t(spark, sf)
        return R.period_report_for(V.order_items(t), V.orders(t), V.products(t), kind,
                                   P.REPORT_ANCHOR)
    return query


for _kind in R.REPORT_DAYS:
    QUERIES[f"period_report_{_kind}"] = _period_for(_kind)


# The reports as the raw pipeline feeds them: cleaned orders with NULL customers and dates.

@register("clean_top10_customers")
def _clean_top10_customers(spark, sf):
    t = _t(spark, sf)
    return R.top_customers(V.order_items(t), V.orders_clean(t), 10)


@register("clean_monthly_orders_12m")
def _clean_monthly_orders_12m(spark, sf):
    return R.monthly_orders_last_12m(V.orders_clean(_t(spark, sf)))


@register("clean_never_delivered")
def _clean_never_delivered(spark, sf):
    return R.never_delivered(V.orders_clean(_t(spark, sf)))


@register("clean_running_revenue")
def _clean_running_revenue(spark, sf):
    t = _t(spark, sf)
    return R.running_revenue(V.order_items(t), V.orders_clean(t))


@register("clean_order_gaps")
def _clean_order_gaps(spark, sf):
    return R.order_gaps(V.orders_clean(_t(spark, sf)), risk_days=P.RISK_DAYS)


@register("clean_revenue_tiers")
def _clean_revenue_tiers(spark, sf):
    t = _t(spark, sf)
    return R.revenue_tiers(V.order_items(t), V.orders_clean(t), P.HIGH_TIER, P.MEDIUM_TIER)


@register("clean_yoy_revenue")
def _clean_yoy_revenue(spark, sf):
    t = _t(spark, sf)
    return R.yoy_revenue(V.order_items(t), V.orders_clean(t))


@register("clean_cohort_retention")
def _clean_cohort_retention(spark, sf):
    t = _t(spark, sf)
    return R.cohort_retention(V.orders_clean(t), V.customers(t))


# -- customer sales statements ---------------------------------------------------------------

from tillpoint.plans import customer_sales as CS  # noqa: E402


def _lines(spark, sf):
    t = _t(spark, sf)
    return V.order_lines(t), V.customer_names(t)


@register("above_avg_orders")
def _above_avg_orders(spark, sf):
    return CS.orders_above_average(_lines(spark, sf)[0])


@register("max_per_customer")
def _max_per_customer(spark, sf):
    return CS.max_sale_per_customer(_lines(spark, sf)[0])


@register("sales_per_customer")
def _sales_per_customer(spark, sf):
    return CS.sales_per_customer(_lines(spark, sf)[0])


@register("customers_above_avg")
def _customers_above_avg(spark, sf):
    return CS.customers_above_average(_lines(spark, sf)[0])


@register("customer_sales_rank")
def _customer_sales_rank(spark, sf):
    return CS.customer_sales_rank(_lines(spark, sf)[0])


@register("order_row_number")
def _order_row_number(spark, sf):
    return CS.order_row_number(_lines(spark, sf)[0])


@register("top_customers_rank")
def _top_customers_rank(spark, sf):
    return CS.top_customers_by_rank(_lines(spark, sf)[0], 3)


@register("customer_rank_named")
def _customer_rank_named(spark, sf):
    return CS.customer_rank_named(*_lines(spark, sf))


@register("top5_named")
def _top5_named(spark, sf):
    return CS.top_named(*_lines(spark, sf), k=5)


@register("bottom_customers")
def _bottom_customers(spark, sf):
    return CS.bottom_named(*_lines(spark, sf), k=5)


@register("single_order_customers")
def _single_order_customers(spark, sf):
    return CS.single_order_customers(*_lines(spark, sf))


@register("above_avg_named")
def _above_avg_named(spark, sf):
    return CS.above_average_named(*_lines(spark, sf))


@register("top_order_per_customer")
def _top_order_per_customer(spark, sf):
    return CS.top_order_per_customer(*_lines(spark, sf))


@register("insert_distinct")
def _insert_distinct(spark, sf):
    from tillpoint.sources.files import append_distinct, scratch_path
    return append_distinct(scratch_path(spark, "orders-distinct"), _lines(spark, sf)[0],
                           ["order_id", "customer_id", "product_id", "quantity", "sales"])


# -- sales statements ------------------------------------------------------------------------

from tillpoint.operators import clean as C  # noqa: E402
from tillpoint.plans import sales as S  # noqa: E402


def _sales(spark, sf):
    return V.sales(_t(spark, sf))


def _parsed(spark, sf):
    return S.parsed(V.sales_dirty(_t(spark, sf)))


@register("scan_sales")
def _scan_sales(spark, sf):
    return _sales(spark, sf)


@register("filter_region")
def _filter_region(spark, sf):
    return S.filter_eq(_sales(spark, sf), "region", P.REGION)


@register("filter_category")
def _filter_category(spark, sf):
    return S.filter_eq(_sales(spark, sf), "category", P.CATEGORY)


@register("filter_sales")
def _filter_sales(spark, sf):
    return S.filter_gt(_sales(spark, sf), "sales", P.SALES_OVER)


@register("filter_date")
def _filter_date(spark, sf):
    return S.filter_after(_sales(spark, sf), "order_date", P.DATE_AFTER)


@register("sales_totals")
def _sales_totals(spark, sf):
    return S.sales_totals(_sales(spark, sf))


@register("sales_by_region")
def _sales_by_region(spark, sf):
    return S.sum_by(_sales(spark, sf), "region")


@register("avg_by_category")
def _avg_by_category(spark, sf):
    return S.avg_by(_sales(spark, sf), "category")


@register("quantity_by_region")
def _quantity_by_region(spark, sf):
    return S.quantity_by(_sales(spark, sf), "region")


@register("count_by_category")
def _count_by_category(spark, sf):
    return S.count_by(_sales(spark, sf), "category")


@register("having_quantity")
def _having_quantity(spark, sf):
    return S.having_quantity(_sales(spark, sf), P.QUANTITY_OVER)


@register("top10_customers_sales")
def _top10_customers_sales(spark, sf):
    return S.top_n_by_sales(_sales(spark, sf), "customer_name", 10)


@register("profit_by_region")
def _profit_by_region(spark, sf):
    return S.profit_by_region(_sales(spark, sf))


@register("top10_products")
def _top10_products(spark, sf):
    return S.top_n_by_sales(_sales(spark, sf), "product_name", 10)


@register("profile_shape")
def _profile_shape(spark, sf):
    return PR.shape(_sales(spark, sf))


@register("dup_groups")
def _dup_groups(spark, sf):
    return S.duplicate_groups(_sales(spark, sf), ["customer_name", "order_date"])


@register("parse_numeric")
def _parse_numeric(spark, sf):
    return _parsed(spark, sf)


@register("west_avg")
def _west_avg(spark, sf):
    return S.avg_by(S.filter_eq(_parsed(spark, sf), "region", P.REGION), "category")


@register("drop_nulls")
def _drop_nulls(spark, sf):
    return C.drop_nulls(_parsed(spark, sf))


@register("fill_constants")
def _fill_constants(spark, sf):
    return C.fill_constants(_parsed(spark, sf), {"customer_name": "Unknown"})


@register("city_counts")
def _city_counts(spark, sf):
    return S.city_counts(_parsed(spark, sf), P.CITY_COUNT_OVER)


@register("drop_col")
def _drop_col(spark, sf):
    return _parsed(spark, sf).drop("segment")


@register("rename_col")
def _rename_col(spark, sf):
    return _parsed(spark, sf).withColumnRenamed("customer_name", "Customer_Name")


@register("filter_and")
def _filter_and(spark, sf):
    from pyspark.sql import functions as F
    df = _parsed(spark, sf)
    return df.filter((F.col("region") == P.REGION) & (F.col("sales") > P.SALES_OVER_SMALL))


@register("avg_filled_sales")
def _avg_filled_sales(spark, sf):
    return S.avg_after_fill(_parsed(spark, sf))


@register("const_timestamp")
def _const_timestamp(spark, sf):
    from pyspark.sql import functions as F
    df = _parsed(spark, sf).withColumn(
        "raw_timestamp", F.to_timestamp(F.lit("2025-01-01"), "yyyy-MM-dd").cast("timestamp_ntz"))
    return df.withColumnRenamed("raw_timestamp", "event_time").select("order_id", "event_time")


@register("sales_by_category")
def _sales_by_category(spark, sf):
    return S.sum_by(_parsed(spark, sf), "category")


@register("filter_blank")
def _filter_blank(spark, sf):
    return C.filter_blank(_parsed(spark, sf), "customer_name")


@register("sales_statistics")
def _sales_statistics(spark, sf):
    return S.sales_statistics(_parsed(spark, sf))


@register("region_revenue_clean")
def _region_revenue_clean(spark, sf):
    return S.region_revenue_clean(_parsed(spark, sf))


@register("dedup_by_key")
def _dedup_by_key(spark, sf):
    return C.dedup_by_key(_parsed(spark, sf), ["order_id", "customer_name", "category"],
                          S.SURVIVOR_ORDER)


# -- profiling and cleaning ------------------------------------------------------------------

from tillpoint.operators import profile as PR  # noqa: E402

HEAD_ORDER = ["order_id", "product_id", "ship_date", "quantity", "sales", "discount"]
IMPUTE_COLS = ["order_id", "customer_name", "category", "sales", "quantity"]
DUP_COLS = ["customer_name", "category", "region", "segment"]


@register("profile_head")
def _profile_head(spark, sf):
    return PR.head(_sales(spark, sf), 5, HEAD_ORDER)


@register("profile_tail")
def _profile_tail(spark, sf):
    return PR.tail(_sales(spark, sf), 5, HEAD_ORDER)


@register("profile_schema")
def _profile_schema(spark, sf):
    return PR.schema_table(_sales(spark, sf))


@register("profile_nulls")
def _profile_nulls(spark, sf):
    return PR.null_counts(_parsed(spark, sf))


@register("profile_dup_count")
def _profile_dup_count(spark, sf):
    return PR.duplicate_count(_sales(spark, sf).select(*DUP_COLS))


@register("select_cols")
def _select_cols(spark, sf):
    return _sales(spark, sf).select("sales", "quantity")


@register("derive_amount")
def _derive_amount(spark, sf):
    from pyspark.sql import functions as F
    items = V.order_items(_t(spark, sf)).select("order_id", "product_id", "unit_price",
                                                "quantity")
    return C.with_derived(items, "total_amount", F.col("unit_price") * F.col("quantity"))


def _backpack(spark, sf):
    """Product-file stand-in: name, category, price and quantity with gaps and repeats."""
    from pyspark.sql import functions as F
    return _parsed(spark, sf).select("product_name", "category", F.col("sales").alias("price"),
                                     "quantity")


@register("cleaning_summary")
def _cleaning_summary(spark, sf):
    from pyspark.sql import functions as F
    raw = _backpack(spark, sf)
    filled = C.impute(raw, "mean")
    final = C.with_derived(C.dedup_rows(filled), "total_amount",
                           F.col("price") * F.col("quantity"))
    return PR.cleaning_summary(raw, final, filled)


@register("impute_mean")
def _impute_mean(spark, sf):
    return C.impute(_parsed(spark, sf).select(*IMPUTE_COLS), "mean", cols=["customer_name",
                                                                           "sales", "quantity"])


@register("impute_median")
def _impute_median(spark, sf):
    return C.impute(_parsed(spark, sf).select(*IMPUTE_COLS), "median", cols=["customer_name",
                                                                             "sales", "quantity"])


@register("median_approx")
def _median_approx(spark, sf):
    """Sketch medians of the sales columns, and how far their ranks are from the middle."""
    from pyspark.sql import functions as F

    cols, accuracy = ["sales", "quantity", "profit"], 1000
    df = _sales(spark, sf).select(*cols)
    medians = C.approximate_quantiles(df, {c: [0.5] for c in cols}, accuracy)

    def of(c):
        n, x = F.count(c), F.lit(medians[c][0])
        below, upto = F.count_if(F.col(c) < x), F.count_if(F.col(c) <= x)
        near = (below <= (0.5 + 1 / accuracy) * n + 1) & (upto >= (0.5 - 1 / accuracy) * n - 1)
        return F.struct(F.lit(c).alias("column_name"), n.alias("n_values"),
                        near.alias("within_tolerance"))

    return df.agg(F.array(*map(of, cols)).alias("x")).select(F.explode("x").alias("x")).select("x.*")


@register("dedup_rows")
def _dedup_rows(spark, sf):
    return C.dedup_rows(_sales(spark, sf).select(*DUP_COLS))


@register("trim_text")
def _trim_text(spark, sf):
    return C.trim_text(V.products_dirty(_t(spark, sf)))


@register("title_case")
def _title_case(spark, sf):
    return C.normalise_names(V.products_dirty(_t(spark, sf)), "product_name")


@register("convert_types")
def _convert_types(spark, sf):
    return C.convert_types(V.orders_dirty(_t(spark, sf)), {"customer_id": "bigint"})


@register("cap_outliers")
def _cap_outliers(spark, sf):
    df = _sales(spark, sf).select("order_id", "product_id", "sales", "profit")
    return C.cap_outliers(df, ["sales", "profit"], 1.5)


@register("flag_missing")
def _flag_missing(spark, sf):
    return C.clean_orders(V.orders_dirty(_t(spark, sf))).select(
        "order_id", "customer_id", "customer_id_missing")


@register("parse_two_formats")
def _parse_two_formats(spark, sf):
    return C.clean_orders(V.orders_dirty(_t(spark, sf))).select(
        "order_id", "order_date", "order_date_unparseable")


@register("normalise_separators")
def _normalise_separators(spark, sf):
    return C.normalise_date_separators(V.mixed_date_text(_t(spark, sf)), "order_date")


# -- data quality ----------------------------------------------------------------------------

from tillpoint.operators import quality as Q  # noqa: E402

AS_OF = "2001-06-01"


@register("dq_email")
def _dq_email(spark, sf):
    return Q.invalid_emails(V.customers(_t(spark, sf)))


@register("dq_orphans")
def _dq_orphans(spark, sf):
    t = _t(spark, sf)
    return Q.orphans(V.order_items_dirty(t), V.orders(t), "order_id").select(
        "order_id", "product_id", "line_number")


@register("dq_discount")
def _dq_discount(spark, sf):
    return Q.discount_over_100(V.order_items_dirty(_t(spark, sf))).select(
        "order_id", "product_id", "line_number", "discount_percent")


@register("dq_zero_qty")
def _dq_zero_qty(spark, sf):
    return Q.zero_quantity(V.order_items_dirty(_t(spark, sf))).select(
        "order_id", "product_id", "line_number", "quantity")


@register("dq_future")
def _dq_future(spark, sf):
    return Q.future_orders(V.orders(_t(spark, sf)), AS_OF).select("order_id", "order_date")


@register("items_revenue")
def _items_revenue(spark, sf):
    from tillpoint.functions.exprs import money
    return V.order_items_dirty(_t(spark, sf)).select(
        "order_id", "product_id", "line_number", money("revenue", 4).alias("revenue"))


@register("dq_report")
def _dq_report(spark, sf):
    t = _t(spark, sf)
    return Q.dq_report(C.clean_orders(V.orders_dirty(t)), V.customers(t), V.order_items_dirty(t),
                       V.orders(t), AS_OF)


# -- sources and sinks -----------------------------------------------------------------------

from tillpoint.sources import files as FS  # noqa: E402


@register("csv_roundtrip")
def _csv_roundtrip(spark, sf):
    df = V.products_dirty(_t(spark, sf))
    path = FS.write_csv(df, FS.scratch_path(spark, "products-csv"))
    return FS.read_csv(spark, path, schema=df.schema, multi_line=True)  # names with line breaks


@register("csv_inferred")
def _csv_inferred(spark, sf):
    df = V.products(_t(spark, sf)).select("product_id", "category", "cost_price")
    path = FS.write_csv(df, FS.scratch_path(spark, "products-inferred"))
    return FS.read_csv(spark, path, infer=True)


@register("scan_limit")
def _scan_limit(spark, sf):
    return _t(spark, sf).customer.orderBy("c_custkey").limit(100)


@register("csv_null_policy")
def _csv_null_policy(spark, sf):
    df = V.orders_dirty(_t(spark, sf))
    path = FS.write_csv(df, FS.scratch_path(spark, "orders-csv"))
    schema = "order_id bigint, customer_id string, order_date string, status string"
    return FS.read_csv(spark, path, schema=schema, null_value="")


@register("parquet_roundtrip")
def _parquet_roundtrip(spark, sf):
    path = FS.write_parquet(_sales(spark, sf), FS.scratch_path(spark, "sales-parquet"))
    return FS.read_parquet(spark, path)


def bucketed_model(spark, sf, buckets: int | None = None):
    """Order lines and orders as tables bucketed by the order, for reports that join them often."""
    import uuid
    t, run = _t(spark, sf), uuid.uuid4().hex
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (FS.write_bucketed(V.order_items(t), f"order_items_{run}", ["order_id"], buckets),
            FS.write_bucketed(V.orders(t), f"orders_{run}", ["order_id"], buckets))


def status_revenue(items, orders):
    """Lines, orders and revenue of each order status, by a join that moves neither side."""
    from tillpoint.functions.exprs import money
    from pyspark.sql import functions as F
    per_order = items.groupBy("order_id").agg(F.sum("revenue").alias("revenue"),
                                              F.count(F.lit(1)).alias("n"))
    return (per_order.join(orders, "order_id").groupBy("status")
            .agg(F.count(F.lit(1)).alias("orders"), F.sum("n").alias("lines"),
                 money(F.sum("revenue")).alias("revenue")))


@register("bucketed_status_revenue")
def _bucketed_status_revenue(spark, sf):
    return status_revenue(*bucketed_model(spark, sf))


@register("load_counts")
def _load_counts(spark, sf):
    t = _t(spark, sf)
    tables = {"customers": V.customers(t), "products": V.products(t), "orders": V.orders(t),
              "order_items": V.order_items(t)}
    return FS.load_tables(tables, FS.scratch_path(spark, "load"))


@register("canonical_ts")
def _canonical_ts(spark, sf):
    from tillpoint.functions.exprs import canonical_ts
    return V.orders(_t(spark, sf)).select("order_id", canonical_ts("order_date").alias("order_date"))


# -- incremental merge -----------------------------------------------------------------------

from tillpoint.operators import merge as M  # noqa: E402


def _merge(spark, sf):
    target = V.orders(_t(spark, sf))
    batch = M.make_batch(target, "order_id", "total_price")
    return target, batch, M.upsert(target, batch, "order_id")


@register("merge_batch")
def _merge_batch(spark, sf):
    return _merge(spark, sf)[1]


@register("merge_upsert")
def _merge_upsert(spark, sf):
    return M.merged(_merge(spark, sf)[2])


@register("merge_two_columns")
def _merge_two_columns(spark, sf):
    """A batch that revises sales and profit of an order."""
    from tillpoint.functions.exprs import dec, money
    from pyspark.sql import functions as F
    target = _sales(spark, sf).groupBy("order_id").agg(
        *[money(F.sum(dec(c))).alias(c) for c in ("sales", "profit")])
    return M.merged(M.upsert(target, M.make_batch(target, "order_id", ["sales", "profit"]),
                             "order_id"))


@register("merge_changes")
def _merge_changes(spark, sf):
    target, batch, _ = _merge(spark, sf)
    return M.changes(M.feed(target, batch, "order_id"), "order_id", "total_price")


@register("merge_validation")
def _merge_validation(spark, sf):
    target, batch, result = _merge(spark, sf)
    return M.validation(target, result, batch, "order_id", "total_price")


def _loaded(spark, sf):
    target = V.orders(_t(spark, sf))
    table = FS.VersionedTable(spark, FS.scratch_path(spark, "orders-versions"))
    table.write_initial(target, "order_id")
    return table


@register("merge_history")
def _merge_history(spark, sf):
    """The history of a versioned table after one merge, read from its changes."""
    table = _loaded(spark, sf)
    table.merge(M.make_batch(table.read(0), "order_id", "total_price"), "order_id")
    return table.history()


@register("merge_stream")
def _merge_stream(spark, sf):
    """The same upsert, applied by a file stream with foreachBatch onto a versioned table."""
    import os

    from tillpoint.streaming.incremental import run_upserts

    table = _loaded(spark, sf)
    batches = FS.scratch_path(spark, "orders-batches")
    FS.write_parquet(M.make_batch(table.read(0), "order_id", "total_price"),
                     os.path.join(batches, "batch-0001"))
    schema = table.read(0).schema
    version = run_upserts(spark, os.path.join(batches, "*"), table, "order_id", schema)
    return table.read(version)
