"""Cleaning operators: typed parsing, imputation, deduplication, trimming, capping.

All are column expressions or single aggregations; none collects data to the driver
except the handful of statistics an imputation or a capping needs (one value per column).
"""

from __future__ import annotations

import struct

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillpoint.functions.exprs import parse_timestamp, round_half_up, strip_ws, title_case
from tillpoint.operators.joins import filter_words, may_hold
from tillpoint.operators.persist import materialize, scratch

# Text tokens that stand for a missing number; the two order-date formats of
# the raw order file (timestamp text, and day-month-year); the separator style dates are
# normalised to before parsing.
NULL_TOKENS = ("null", "NULL", "")
ORDER_DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "dd-MM-yyyy")
SEPARATED_DATE_FORMAT = "M-d-yyyy"

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def _is_numeric(dt) -> bool:
    return isinstance(dt, _NUMERIC)


def _is_text(dt) -> bool:
    return isinstance(dt, (T.StringType, T.VarcharType, T.CharType))


# C7 / F16
def parse_numeric(df: DataFrame, col: str, tokens=NULL_TOKENS, to: str = "double") -> DataFrame:
    """Text tokens for 'missing' become NULL, anything else is cast (unparseable -> NULL)."""
    c = F.col(col)
    return df.withColumn(col, F.when(F.trim(c).isin(*tokens), F.lit(None).cast(to))
                         .otherwise(c.try_cast(to)))


# C10
def convert_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast named columns; a value that does not convert becomes NULL instead of failing."""
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c)
                       for c in df.columns])


# C9
def trim_text(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Strip leading / trailing white space (tabs, line breaks too) of text columns."""
    todo = cols or [f.name for f in df.schema.fields if _is_text(f.dataType)]
    return df.select(*[strip_ws(c).alias(c) if c in todo else F.col(c) for c in df.columns])


# C15
def normalise_names(df: DataFrame, col: str = "product_name") -> DataFrame:
    return df.withColumn(col, title_case(strip_ws(col)))


# C8
def filter_blank(df: DataFrame, col: str) -> DataFrame:
    c = F.col(col)
    return df.filter(c.isNotNull() & (F.trim(c) != ""))


# C4
def drop_nulls(df: DataFrame, how: str = "any", subset: list[str] | None = None) -> DataFrame:
    return df.na.drop(how=how, subset=subset)


# C3
def fill_constants(df: DataFrame, values: dict) -> DataFrame:
    return df.na.fill(values)


# C5
def row_fingerprint(df: DataFrame) -> Column:
    """A hash of a whole row; nulls count by their place."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    return F.xxhash64(*columns, *[c.isNull() for c in columns])


def split_by_repeats(df: DataFrame, fingerprint: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows that are alone for certain, the others): only narrow fingerprints are counted.

    The fingerprints that repeat fill a filter of fixed size; rows it does not know are alone,
    all others, the few it knows by chance included, are still to be compared.
    """
    fp = row_fingerprint(df) if fingerprint is None else fingerprint
    repeated = (df.select(fp.alias("_fp")).groupBy("_fp").agg(F.count(F.lit(1)).alias("n"))
                .filter("n > 1"))
    known = may_hold(df.withColumn("_fp", fp), materialize(filter_words(repeated, "_fp"), "repeats"),
                     "_fp", "_twice").drop("_fp")
    return known.filter(~F.col("_twice")).drop("_twice"), known.filter("_twice").drop("_twice")


def dedup_rows(df: DataFrame) -> DataFrame:
    """Rows without repeats; only rows whose fingerprint repeats are moved and compared."""
    alone, others = split_by_repeats(df)
    return alone.unionByName(others.dropDuplicates())


# C6
def dedup_by_key(df: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """Keep one row per key: the first by ``order_by`` then by all remaining columns.

    The input is written once.  Rows whose key stands alone, which a count of key fingerprints
    tells, pass without being sorted or moved.  Of the others the first is a ``min`` over a struct,
    so a key holding a third of all rows is reduced map-side by partial aggregation instead of
    being sorted in one task.  NULL sorts first.
    """
    df = materialize(df, "dedup")
    order_by = list(order_by or [])
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    payload = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order_by + rest)])
    names = order_by + rest
    alone, others = split_by_repeats(df, row_fingerprint(df.select(*keys)))
    best = others.groupBy(*keys).agg(F.min(payload).alias("_w"))
    return alone.unionByName(best.select(
        *keys, *[F.col(f"_w._{i}").alias(c) for i, c in enumerate(names)]).select(*df.columns))


# C1 / C2
FILL_DIGITS = 8


def column_means(df: DataFrame, cols: list[str], digits: int = FILL_DIGITS) -> dict:
    """Exact means (sum as DECIMAL with ten digits / count), rounded half-up to ``digits``."""
    row = df.agg(*[
        round_half_up(F.sum(F.col(c).cast("decimal(28,10)")).cast("double")
                      / F.count(c).cast("double"), digits).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


def order_image(v: Column, exponent: Column) -> Column:
    """A long that is ordered as the double ``v``; ``exponent`` is near the one of abs(v).

    Sign and magnitude; the magnitude is the double's own 64 bits, put together from its binary
    exponent and fraction, which scaling by powers of two leaves exact.  Zeros of both signs are 0.
    """
    size = F.abs(v)
    m = size / F.pow(F.lit(2.0), exponent)  # in [1/2, 4), below 1 at the lowest exponent
    lowest = exponent <= -1022
    e = exponent + F.when(m >= 2, 1).when((m < 1) & ~lowest, -1).otherwise(0)
    fraction = F.when(m >= 2, m / 2).when((m < 1) & ~lowest, m * 2).otherwise(m) - 1
    normal = (e + 1023).cast("long") * F.lit(1 << 52) + (fraction * F.lit(2.0**52)).cast("long")
    tiny = (size * F.lit(2.0**537) * F.lit(2.0**537)).cast("long")
    magnitude = (F.when(size == float("inf"), F.lit(2047 << 52))
                 .when(size < 2.0**-1022, tiny).otherwise(normal))
    return F.when(v < 0, -magnitude).otherwise(magnitude)


def with_image(frame: DataFrame, value: str, image: str) -> DataFrame:
    """Adds ``order_image(value)``; null for null and NaN."""
    size = F.abs(value)
    near = F.when((size >= 2.0**-1022) & (size < float("inf")), F.least(F.greatest(
        F.floor(F.log2(size)).cast("int"), F.lit(-1022)), F.lit(1023))).otherwise(-1022)
    return (frame.withColumn("_e", near)
            .withColumn(image, F.when(F.col(value).isNotNull() & ~F.isnan(value),
                                      order_image(F.col(value), F.col("_e")))).drop("_e"))


def double_of(image: int) -> float:
    """The double whose ``order_image`` is ``image``."""
    size = struct.unpack("<d", struct.pack("<Q", abs(image)))[0]
    return -size if image < 0 else size


def exact_quantiles(df: DataFrame, wanted: dict[str, list[float]], bins: int = 2048,
                    leaf: int = 10_000) -> dict[str, list[float | None]]:
    """Exact linear-interpolation quantiles (as ``percentile`` / ``quantile_cont``).

    A radix search over a 64-bit image of the doubles that keeps their order: all columns together,
    one pass counts the values by the next log2(``bins``) bits inside each interval that holds a
    wanted rank, and the next pass looks into the one slice with the rank only.  After the first
    pass over counts and extremes at most 64 / log2(``bins``) follow (six by default), whatever
    the values are: far outliers and infinities cost no more.  A slice of at most ``leaf`` rows is read as (value, count)
    pairs.  The driver sees counts of that bounded size; a value repeated on a third of all
    rows is one pair.  NULL and NaN do not count.
    """
    with scratch(df.sparkSession):
        return _exact_quantiles(df, wanted, bins, leaf)


def _exact_quantiles(df: DataFrame, wanted: dict[str, list[float]], bins: int,
                     leaf: int) -> dict[str, list[float | None]]:
    cols, bits = list(wanted), bins.bit_length() - 1
    values = df.select(*[F.col(c).cast("double").alias(f"v{k}") for k, c in enumerate(cols)])
    for k in range(len(cols)):
        values = with_image(values, f"v{k}", f"i{k}")
    values = materialize(values.select(*[f"i{k}" for k in range(len(cols))]), "quantile")
    stats = values.agg(*[f(f"i{k}").alias(f"{n}{k}") for k in range(len(cols)) for n, f in (
        ("n", F.count), ("lo", F.min), ("hi", F.max))]).first()
    ranks: dict[int, set[int]] = {}
    for k, c in enumerate(cols):
        n = stats[f"n{k}"]
        ranks[k] = {r for q in wanted[c] for r in (int((n - 1) * q), min(int((n - 1) * q) + 1, n - 1))
                    } if n else set()
    found: dict[tuple[int, int], float] = {}
    # (column, lowest image, highest image, rows, rows before) -> ranks to find in it
    open_ = {(k, stats[f"lo{k}"], stats[f"hi{k}"], stats[f"n{k}"], 0): r
             for k, r in ranks.items() if r}
    while open_:
        for (k, lo, hi, _, _), r in open_.items():
            found.update({(k, x): double_of(lo) for x in r if lo == hi})
        open_ = {i: r for i, r in open_.items() if i[1] != i[2]}
        spans = list(open_)
        if not spans:
            break

        def slice_of(image: Column, lo: int, hi: int, n: int) -> Column:
            drop = max(0, (hi - lo).bit_length() - bits)  # bits that this pass leaves open
            return F.shiftright(image, drop) - F.lit(lo >> drop) if n > leaf else F.lit(-1)

        tagged = values.select(F.explode(F.array(*[
            F.when(F.col(f"i{k}").between(lo, hi), F.struct(
                F.lit(j).alias("j"), slice_of(F.col(f"i{k}"), lo, hi, n).cast("int").alias("b"),
                F.col(f"i{k}").alias("i"))) for j, (k, lo, hi, n, _) in enumerate(spans)]))
            .alias("x")).filter("x is not null").select("x.*")
        pairs = (tagged.groupBy("j", "b", F.when(F.col("b") < 0, F.col("i")).alias("leaf"))
                 .agg(F.count(F.lit(1)).alias("n"), F.min("i").alias("lo"), F.max("i").alias("hi"))
                 .collect())
        by_span: dict[int, list] = {}
        for row in pairs:
            by_span.setdefault(row["j"], []).append(row)
        nxt: dict[tuple, set[int]] = {}
        for j, span in enumerate(spans):
            before = span[4]
            for row in sorted(by_span[j], key=lambda x: x["lo"]):
                inside = {r for r in open_[span] if before <= r < before + row["n"]}
                if inside:
                    nxt[(span[0], row["lo"], row["hi"], row["n"], before)] = inside
                before += row["n"]
        open_ = nxt
    out: dict[str, list[float | None]] = {}
    for k, c in enumerate(cols):
        n = stats[f"n{k}"]
        out[c] = []
        for q in wanted[c]:
            at = (n - 1) * float(q)
            low = int(at)
            if not n:
                out[c].append(None)
                continue
            a, b = found[k, low], found[k, min(low + 1, n - 1)]
            # equal neighbours (infinite ones too) are the value itself
            out[c].append(a if a == b or at == low else a + (b - a) * (at - low))
    return out


def approximate_quantiles(df: DataFrame, wanted: dict[str, list[float]],
                          accuracy: int = 10_000) -> dict[str, list[float | None]]:
    """Quantiles from a mergeable sketch: one pass over all columns, rank error 1 / ``accuracy``.

    Values are values of the column, not interpolated.  NULL and NaN do not count.
    """
    cols = list(wanted)
    usable = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols]
    row = df.agg(*[F.percentile_approx(v, F.array(*[F.lit(float(q)) for q in wanted[c]]),
                                       accuracy).alias(f"q{k}")
                   for k, (v, c) in enumerate(zip(usable, cols))]).first()
    return {c: list(row[f"q{k}"]) if row[f"q{k}"] else [None] * len(wanted[c])
            for k, c in enumerate(cols)}


def _rounded(value: float | None, digits: int) -> Column:
    """A fill value; one too large for the decimal that rounds it (infinite ones too) stays."""
    if value is None or abs(value) < 1e27:
        return round_half_up(F.lit(value).cast("double"), digits)
    return F.lit(float(value))


def impute(df: DataFrame, numeric: str = "mean", text: str = "Unknown",
           cols: list[str] | None = None, digits: int = FILL_DIGITS,
           accuracy: int | None = None) -> DataFrame:
    """Fill NULLs: text columns with ``text``, numeric columns with their mean or median.

    Integer columns are widened to DOUBLE first, so a fractional mean is not truncated.  With
    ``accuracy`` the median is one of ``approximate_quantiles``, at a single pass.
    """
    fields = [f for f in df.schema.fields if cols is None or f.name in cols]
    num = [f.name for f in fields if _is_numeric(f.dataType)]
    txt = [f.name for f in fields if _is_text(f.dataType)]
    if numeric == "mean":
        fill = column_means(df, num, digits) if num else {}
        fill_cols = {c: F.lit(v).cast("double") for c, v in fill.items()}
    elif numeric == "median":
        middle = {c: [0.5] for c in num}
        medians = {} if not num else exact_quantiles(df, middle) if accuracy is None else (
            approximate_quantiles(df, middle, accuracy))
        fill_cols = {c: _rounded(m[0], digits) for c, m in medians.items()}
    else:
        raise ValueError("numeric must be 'mean' or 'median'")
    out = []
    for c in df.columns:
        if c in fill_cols:
            out.append(F.coalesce(F.col(c).cast("double"), fill_cols[c]).alias(c))
        elif c in txt:
            out.append(F.coalesce(F.col(c), F.lit(text)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


# C11
def cap_outliers(df: DataFrame, cols: list[str], k: float = 1.5) -> DataFrame:
    """Cap every column to [q1 - k*iqr, q3 + k*iqr] with exact quartiles.

    The input is written once; the quartile passes and the capping pass read that table."""
    df = materialize(df, "cap")
    quartiles = exact_quantiles(df, {c: [0.25, 0.75] for c in cols})
    out = df
    for c in cols:
        q1, q3 = quartiles[c]
        if q1 is None:
            continue
        iqr = 0.0 if q1 == q3 else q3 - q1  # both may be infinite
        lo, hi = F.lit(q1 - k * iqr), F.lit(q3 + k * iqr)
        x = F.col(c).cast("double")
        out = out.withColumn(c, F.when(x.isNull() | F.isnan(x), x).otherwise(
            F.least(F.greatest(x, lo), hi)))
    return out


# C12 / C13
def clean_orders(df: DataFrame, id_col: str = "customer_id", date_col: str = "order_date",
                 formats=ORDER_DATE_FORMATS) -> DataFrame:
    """Empty id -> NULL plus a flag; date in either format, unparseable -> NULL plus a flag."""
    cid = F.nullif(F.col(id_col), F.lit(""))
    parsed = parse_timestamp(date_col, formats)
    cols = [cid.alias(c) if c == id_col else parsed.alias(c) if c == date_col else F.col(c)
            for c in df.columns]
    return df.select(*cols, cid.isNull().alias(f"{id_col}_missing"),
                     parsed.isNull().alias(f"{date_col}_unparseable"))


# C14
def normalise_date_separators(df: DataFrame, col: str,
                              fmt: str = SEPARATED_DATE_FORMAT) -> DataFrame:
    """``M/D/YYYY`` and ``M-D-YYYY`` to one separator, then parse."""
    return df.withColumn(col, parse_timestamp(F.regexp_replace(F.col(col), "/", "-"), [fmt]))


def with_derived(df: DataFrame, name: str, expr: Column) -> DataFrame:
    return df.withColumn(name, expr)
