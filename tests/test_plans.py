"""Plan shape: no relation-wide single-task window, no null-aware anti join, pushdown."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _single_partition_windows(plan: str) -> int:
    """Count Window operators fed by an Exchange SinglePartition (a whole relation in one task)."""
    lines = plan.splitlines()
    bad = 0
    for i, line in enumerate(lines):
        if "Window [" in line:
            for nxt in lines[i + 1:i + 4]:
                if "Exchange SinglePartition" in nxt:
                    bad += 1
                    break
    return bad


def test_global_windows_do_not_use_one_task(spark):
    q = E.queries()
    for name in ("customer_quartiles", "cumulative_revenue", "customer_sales_rank",
                 "order_row_number", "order_gaps"):
        assert _single_partition_windows(_plan(q[name](spark, SF))) == 0, name


def test_never_delivered_is_not_a_null_aware_anti_join(spark):
    plan = _plan(E.queries()["never_delivered"](spark, SF))
    assert "isNullAware" not in plan and "NestedLoop" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    df = E.queries()["filter_date"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in plan
    monthly = _plan(E.queries()["monthly_orders_12m"](spark, SF))
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in monthly


def test_no_cartesian_products(spark):
    q = E.queries()
    for name in ("bought_together", "above_avg_orders", "customers_above_avg", "period_report",
                 "cumulative_revenue", "merge_validation"):
        plan = _plan(q[name](spark, SF))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_sales_view_without_broadcast_gives_same_rows(spark):
    from tillpoint.sources import tables as TB
    from tillpoint.sources import views as V

    want = sorted(tuple(str(x) for x in r) for r in V.sales(TB.Tables(spark, SF)).collect())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = V.sales(TB.Tables(spark, SF))
        plan = _plan(big)
        got = sorted(tuple(str(x) for x in r) for r in big.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" not in plan
    assert got == want


def test_period_report_reads_lines_once(spark):
    """Lines meet the picked orders once; the report itself reads that written join."""
    from tillpoint.plans import retail as R
    from tillpoint.sources import views as V
    from tillpoint.sources.tables import Tables

    t = Tables(spark, SF)
    plan = _plan(R.period_report(V.order_items(t), V.orders(t), V.products(t),
                                 "2000-01-01", "2000-02-01"))
    assert "lineitem" not in plan and "orders.parquet" not in plan


def test_period_report_never_moves_other_lines(spark):
    """Picked orders go to the lines; beyond the broadcast limit lines are reduced before they move."""
    from tillpoint.operators.joins import join_selected
    from tillpoint.operators.persist import materialize
    from tillpoint.sources import views as V
    from tillpoint.sources.tables import Tables

    t = Tables(spark, SF)
    lines = V.order_items(t).select("order_id", "product_id", "revenue")
    picked = materialize(V.orders(t).filter("order_id % 50 = 7").select("order_id"))
    small = join_selected(lines, picked, "order_id")
    assert "hashpartitioning" not in _plan(small)
    large = join_selected(lines, picked, "order_id", broadcast_rows=0)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(join_selected(lines, picked, "order_id", broadcast_rows=0)).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    at = [k for k, line in enumerate(plan) if "lineitem" in line][0]
    moved = [k for k, line in enumerate(plan[:at]) if "hashpartitioning(order_id" in line][-1]
    reduced = [k for k, line in enumerate(plan[:at]) if "BroadcastHashJoin [_word" in line][-1]
    assert moved < reduced < at
    whole = lines.join(picked, "order_id", "left_semi")
    want = sorted(tuple(r) for r in whole.collect())
    assert want and sorted(tuple(r) for r in small.collect()) == want
    assert sorted(tuple(r) for r in large.collect()) == want


def test_reduced_facts_keep_every_selected_key(spark):
    from pyspark.sql import functions as F

    from tillpoint.operators.joins import reduce_facts

    facts = spark.range(20_000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    keys = facts.filter("k % 100 = 3").select("k")
    left = {r.k for r in reduce_facts(facts, keys, "k", words=1 << 12).collect()}
    assert set(range(3, 20_000, 100)) <= left and len(left) < 1000


def test_bucketed_tables_join_without_a_shuffle(spark):
    from tillpoint.plans.registry import bucketed_model, status_revenue

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items, orders = bucketed_model(spark, SF, 4)
        plan = _plan(status_revenue(items, orders))
        files = items.select("_metadata.file_path").distinct().count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "hashpartitioning(order_id" not in plan
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan  # the sum by status
    assert files == 4


def test_distinct_counts_of_the_cohorts_share_one_aggregation(spark):
    plan = _plan(E.queries()["cohort_retention"](spark, SF))
    assert "Expand" not in plan
    assert plan.count("bitmap_construct_agg") > 0


def test_rows_with_a_fingerprint_of_their_own_are_not_moved(spark):
    """Forced collisions, repeats, nulls by place and both zeros."""
    from pyspark.sql import functions as F

    from tillpoint.operators import clean as C
    from tillpoint.operators import profile as PR

    rows = [(k, "x", None) for k in range(50)] + [(1, None, "x"), (None, "x", "1"), (7, "x", None)] * 3
    df = spark.createDataFrame(rows, "a long, b string, c string")
    for fp in (None, F.lit(1).cast("long"), F.xxhash64("a")):
        alone, others = C.split_by_repeats(df, fp)
        assert alone.count() + others.count() == len(rows)
        assert alone.unionByName(others.dropDuplicates()).count() == len(set(rows))
    assert C.split_by_repeats(df)[0].count() == 49
    assert sorted(map(str, C.dedup_rows(df).collect())) == sorted(map(str, df.distinct().collect()))
    assert PR.duplicate_count(df).first()[0] == len(rows) - len(set(rows))
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),)], "v double")
    assert C.dedup_rows(zeros).count() == zeros.dropDuplicates().count() == 2


def test_only_repeated_keys_are_sorted_and_moved(spark):
    """First row per key: rows of other keys pass by; a hot key and NULL keys are reduced."""
    from tillpoint.operators.clean import dedup_by_key, split_by_repeats

    rows = [(k, None, k * 2.0, f"t{k}") for k in range(200)] + [
        (7, None, 1.0, "first"), (7, None, 1.0, "second"), (None, "x", 5.0, "b"), (None, "x", 5.0, "a"),
        (None, None, 1.0, None)] + [(9, None, 3.0, f"hot {k}") for k in range(100)]
    df = spark.createDataFrame(rows, "k long, j string, v double, t string")
    assert split_by_repeats(df, None)[0].count() == len(rows)
    out = dedup_by_key(df, ["k", "j"], ["v"]).collect()
    want = {}
    for k, j, v, t in rows:
        want[k, j] = min(want.get((k, j), (v, t is not None, t)), (v, t is not None, t))
    assert {(r.k, r.j): (r.v, r.t is not None, r.t) for r in out} == want and len(out) == len(want)
    plan = _plan(dedup_by_key(df, ["k", "j"], ["v"]))
    alone = plan.split("Filter NOT coalesce")[1].split("SortAggregate")[0]  # the branch that passes by
    assert "hashpartitioning" not in alone and "Sort [" not in alone and "hashpartitioning(k" in plan


def test_scratch_tables_are_deleted(spark):
    import os

    from tillpoint.operators.clean import exact_quantiles
    from tillpoint.session import checkpoint_dir

    before = set(os.listdir(checkpoint_dir(spark)))
    assert exact_quantiles(spark.range(100).toDF("v"), {"v": [0.5]}) == {"v": [49.5]}
    assert set(os.listdir(checkpoint_dir(spark))) == before


def test_merge_keeps_the_target_on_the_probe_side(spark):
    for name in ("merge_upsert", "merge_changes"):
        plan = _plan(E.queries()[name](spark, SF))
        assert "FullOuter" not in plan, name


def test_dirty_rules_find_rows(spark):
    for name in ("dq_orphans", "dq_discount", "dq_zero_qty"):
        assert E.queries()[name](spark, SF).count() > 0, name
    bad = {r["rule"]: r["n_bad"] for r in E.queries()["dq_report"](spark, SF).collect()}
    assert all(bad[r] > 0 for r in bad if r != "customers_repeated_key"), bad
