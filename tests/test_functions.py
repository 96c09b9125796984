"""Column functions and cleaning operators on literal edge cases."""

from datetime import datetime

from pyspark.sql import functions as F

from tillpoint.functions import exprs as X
from tillpoint.operators import clean as C
from tillpoint.sources import files as FS


def one(spark, expr, schema="x string", value=None):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_title_case_capitalises_after_every_non_letter(spark):
    df = spark.createDataFrame([("t-shirt",), ("  RED widget\t",), ("3rd item",), (None,), ("",)],
                               "name string")
    out = [r["name"] for r in C.normalise_names(df, "name").collect()]
    assert out == ["T-Shirt", "Red Widget", "3Rd Item", None, ""]


def test_strip_removes_tabs_and_line_breaks(spark):
    assert one(spark, X.strip_ws("x"), value="\t  a b \n") == "a b"


def test_two_date_formats_and_unparseable_flag(spark):
    df = spark.createDataFrame(
        [(1, "", "2020-03-04 05:06:07"), (2, "7", "04-03-2020"), (3, "8", "not a date")],
        "order_id long, customer_id string, order_date string")
    rows = {r["order_id"]: r for r in C.clean_orders(df).collect()}
    assert rows[1]["customer_id"] is None and rows[1]["customer_id_missing"]
    assert rows[1]["order_date"] == datetime(2020, 3, 4, 5, 6, 7)
    assert rows[2]["order_date"] == datetime(2020, 3, 4)
    assert not rows[2]["order_date_unparseable"]
    assert rows[3]["order_date"] is None and rows[3]["order_date_unparseable"]


def test_mixed_separators_are_normalised(spark):
    df = spark.createDataFrame([("1/5/2000",), ("12-25-1999",)], "d string")
    out = [r["d"] for r in C.normalise_date_separators(df, "d").collect()]
    assert out == [datetime(2000, 1, 5), datetime(1999, 12, 25)]


def test_null_tokens_and_bad_numbers_become_null(spark):
    df = spark.createDataFrame([("null",), ("NULL",), ("",), (" 12.5 ",), ("abc",)], "sales string")
    out = [r["sales"] for r in C.parse_numeric(df, "sales").collect()]
    assert out == [None, None, None, 12.5, None]


def test_half_up_rounding_on_decimal_digits(spark):
    assert one(spark, X.round_half_up(F.lit(1.005), 2)) == 1.01
    assert one(spark, X.round_half_up(F.lit(-2.675), 2)) == -2.68


def test_percent_change_null_for_zero_or_null_base(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, None), (15.0, 10.0)], "c double, p double")
    out = [r["x"] for r in df.select(X.pct_change("c", "p").alias("x")).collect()]
    assert out == [None, None, 50.0]


def test_month_offset_is_calendar_months(spark):
    df = spark.createDataFrame([(datetime(2020, 3, 1), datetime(2020, 1, 31))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(X.month_offset("a", "b").alias("m")).first()["m"] == 2


def test_csv_only_empty_is_null_and_NA_survives(spark, scratch):
    df = spark.createDataFrame([(1, "NA", ""), (2, "EU", "5")], "order_id long, region_code string, customer_id string")
    path = FS.write_csv(df, scratch + "/o")
    back = FS.read_csv(spark, path, "order_id long, region_code string, customer_id string",
                       null_value="")
    rows = {r["order_id"]: r for r in back.collect()}
    assert rows[1]["region_code"] == "NA"
    assert rows[1]["customer_id"] is None
    assert rows[2]["customer_id"] == "5"


def test_impute_mean_widens_integers_and_fills_text(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 2, None), (None, 3, "c")], "q int, p int, t string")
    rows = C.impute(df, "mean").collect()
    assert rows[2]["q"] == 1.5
    assert rows[0]["p"] == 2.5
    assert rows[1]["t"] == "Unknown"


def test_exact_quantiles_match_linear_interpolation(spark):
    import numpy as np

    vals = [float(v) for v in [5, 1, 9, 3, 3, 3, 3, 7, 2, 8, 8, 100]]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = C.exact_quantiles(df, {"v": [0.25, 0.5, 0.75, 0.9]}, bins=4, leaf=2)["v"]
    want = np.percentile(vals, [25, 50, 75, 90])
    assert [round(g, 9) for g in got] == [round(w, 9) for w in want]


def test_exact_quantiles_of_awkward_columns(spark):
    """Far outliers, one value on most rows, NULLs and NaN, several columns together."""
    import random

    import numpy as np

    rnd = random.Random(2)
    a = [rnd.choice([-1e300, 1e300, 0.0]) if i < 5 else rnd.gauss(0, 1) for i in range(3000)]
    b = [7.0 if rnd.random() < 0.7 else float(rnd.randint(0, 9)) for _ in range(3000)]
    c = [None if i % 3 == 0 else float("nan") if i % 3 == 1 else float(i) for i in range(3000)]
    df = spark.createDataFrame(list(zip(a, b, c)), "a double, b double, c double").repartition(5)
    qs = [0.0, 0.01, 0.5, 0.75, 1.0]
    got = C.exact_quantiles(df, {x: qs for x in "abc"}, bins=16, leaf=20)
    for name, values in (("a", a), ("b", b), ("c", [x for x in c if x is not None and x == x])):
        low = np.percentile(values, [100 * q for q in qs])
        assert np.allclose(got[name], low, rtol=1e-12), name


def test_amounts_keep_their_small_digits(spark):
    from tillpoint.plans import customer_sales as CS
    from tillpoint.plans import sales as S

    lines = spark.createDataFrame([(i, 1, 1, 1, 0.004) for i in range(100)],
                                  "order_id long, customer_id long, product_id long, quantity int, sales double")
    assert CS.sales_per_customer(lines).first()["total_sales"] == 0.4
    assert S.sales_totals(lines).first()["average_sales"] == 0.004
    two = spark.createDataFrame([(1, 10.001), (2, 10.004)], "order_id long, sales double")
    assert [r["order_id"] for r in CS.orders_above_average(two).collect()] == [2]
    holes = spark.createDataFrame([(0.001,), (0.002,), (None,)], "v double")
    assert sorted(r["v"] for r in C.impute(holes, "mean").collect()) == [0.001, 0.0015, 0.002]


def test_cap_outliers_caps_to_iqr_fence(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]], "v double")
    out = sorted(r["v"] for r in C.cap_outliers(df, ["v"], 1.5).collect())
    assert out == [1.0, 2.0, 3.0, 4.0, 7.0]


def test_dedup_by_key_keeps_first_by_order_with_hot_key(spark):
    rows = [(1, i % 7, float(i)) for i in range(300)] + [(2, 5, 1.0), (2, 3, 9.0)]
    df = spark.createDataFrame(rows, "k long, o long, v double")
    out = {r["k"]: (r["o"], r["v"]) for r in C.dedup_by_key(df, ["k"], ["o"]).collect()}
    assert out == {1: (0, 0.0), 2: (3, 9.0)}


def test_csv_with_inferred_types_and_parquet_round_trip(spark, scratch):
    df = spark.createDataFrame([(1, "a b", 2.5), (2, "  c", None)], "id long, name string, price double")
    path = FS.write_csv(df, scratch + "/c")
    back = FS.read_csv(spark, path, infer=True)
    assert dict(back.dtypes) == {"id": "int", "name": "string", "price": "double"}
    assert sorted(tuple(r) for r in back.collect()) == [(1, "a b", 2.5), (2, "  c", None)]
    p = FS.write_parquet(df, scratch + "/p")
    assert sorted(tuple(r) for r in FS.read_parquet(spark, p).collect()) == \
        sorted(tuple(r) for r in df.collect())


EXTREMES = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.0**-1022, 2.0**-1023, 2.2250738585072011e-308,
            1.7976931348623157e308, -1.7976931348623157e308, float("inf"), float("-inf"), 1e300, 0.1,
            1 - 2.0**-53, 1 + 2.0**-52, 2 - 2.0**-52, 4.0, 3.9999999999999996, 2.0**1023, 1e-300]


def test_order_image_is_the_bits_of_the_double(spark):
    import random
    import struct

    rng = random.Random(2)
    values = list(EXTREMES)
    while len(values) < 20_000:
        v = struct.unpack("<d", rng.randbytes(8))[0]
        if v == v:
            values += [v, 2.0 ** rng.randint(-1074, 1023), rng.uniform(-1e6, 1e6)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for r in C.with_image(frame, "v", "i").collect():
        bits = struct.unpack("<Q", struct.pack("<d", abs(r.v)))[0]
        assert r.i == (-bits if r.v < 0 else bits), r.v
        assert C.double_of(r.i) == r.v


def test_quantiles_of_infinite_and_far_values(spark, monkeypatch):
    inf = float("inf")
    rows = [(-inf, 1e300, 1.0), (inf, 1.0, 2.0), (1.0, 2.0, inf), (2.0, 3.0, inf), (3.0, 4.0, inf),
            (None, None, float("nan"))]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = C.exact_quantiles(df, {c: [0.0, 0.5, 0.75, 1.0] for c in "abc"}, leaf=1)
    assert got == {"a": [-inf, 2.0, 3.0, inf], "b": [1.0, 3.0, 4.0, 1e300], "c": [1.0, inf, inf, inf]}
    filled = C.impute(df, "median", cols=["a", "b"]).filter("isnan(c)").first()
    assert filled.a == 2.0 and filled.b == 3.0
    capped = C.cap_outliers(df, ["a", "b", "c"]).collect()
    assert max(r.b for r in capped if r.b is not None) == 7.0
    assert {r.c for r in capped} >= {inf}


def test_quantile_passes_are_bounded(spark, monkeypatch):
    """Values over the whole range of doubles, every one its own: six passes and the first."""
    import random
    import struct

    from pyspark.sql import DataFrame

    rng = random.Random(3)
    values = [v for v in (struct.unpack("<d", rng.randbytes(8))[0] for _ in range(5000)) if v == v]
    df = spark.createDataFrame([(v,) for v in values + EXTREMES], "v double")
    passes, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: passes.append(1) or collect(self))
    got = C.exact_quantiles(df, {"v": [0.25, 0.5]}, leaf=0)["v"]
    assert len(passes) <= 6 + 1  # first() collects once too
    ordered = sorted(values + EXTREMES)
    for q, x in zip((0.25, 0.5), got):
        low = int((len(ordered) - 1) * q)
        assert ordered[low] <= x <= ordered[low + 1]


def test_approximate_median_is_near_in_rank(spark):
    import random

    rng = random.Random(4)
    values = [rng.gauss(0, 1) ** 3 for _ in range(50_000)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    for accuracy in (100, 10_000):
        got = C.approximate_quantiles(df, {"v": [0.25, 0.5]}, accuracy)["v"]
        for q, x in zip((0.25, 0.5), got):
            assert abs(sum(v <= x for v in values) / len(values) - q) <= 1 / accuracy + 1e-4
    empty = spark.createDataFrame([], "v double")
    assert C.approximate_quantiles(empty, {"v": [0.5]}) == {"v": [None]}
    filled = C.impute(df, "median", accuracy=100).filter("v is null").count()
    assert filled == 0
