"""Shared column expressions.

All of them are plain Catalyst expressions (no Python UDF), so they stay inside whole-stage
code generation.  Money is computed as DECIMAL and only turned into DOUBLE at the edge,
after rounding, so that the order in which partial sums are combined across tasks can never
change a digit of a result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec(c: ColumnOrName, precision: int = 24, scale: int = 6) -> Column:
    """An amount as DECIMAL; six digits by default, so that nothing is cut before a sum."""
    return _c(c).cast(f"decimal({precision},{scale})")


def money(c: ColumnOrName, digits: int = 2) -> Column:
    """Round a DECIMAL amount half away from zero and hand it out as DOUBLE."""
    return F.round(_c(c), digits).cast("double")


def round_half_up(c: ColumnOrName, digits: int = 2) -> Column:
    """Round a DOUBLE half away from zero on its decimal digits (not on its binary value).

    The value goes through DECIMAL(38,10) first, so 1.005 rounds to 1.01 as on paper.
    """
    return F.round(_c(c).cast("decimal(38,10)"), digits).cast("double")


def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den as DOUBLE; NULL when the denominator is NULL or zero.

    ``try_divide`` references the denominator once, so a scalar-subquery denominator is
    evaluated once instead of once per test."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def percent(num: ColumnOrName, den: ColumnOrName, digits: int = 2) -> Column:
    """100 * num / den, rounded; NULL for a NULL or zero base."""
    return round_half_up(F.try_divide(F.lit(100.0) * _c(num).cast("double"),
                                      _c(den).cast("double")), digits)


def pct_change(current: ColumnOrName, previous: ColumnOrName, digits: int = 2) -> Column:
    """Percent change from ``previous`` to ``current``; NULL when the base is NULL or 0."""
    prev = _c(previous)
    diff = (_c(current) - prev)
    return percent(diff, prev, digits)


def line_revenue(quantity: ColumnOrName = "quantity", unit_price: ColumnOrName = "unit_price",
                 discount_percent: ColumnOrName = "discount_percent") -> Column:
    """quantity * unit_price * (1 - discount_percent / 100), exact in DECIMAL.

    A negative quantity (a return) gives a negative amount, and a discount over 100 %
    gives a negative one as well; both are left for the quality rules to flag.
    """
    q = _c(quantity).cast("decimal(18,0)")
    p = _c(unit_price).cast("decimal(18,4)")
    d = _c(discount_percent).cast("decimal(9,4)")
    return q * p * (F.lit(1).cast("decimal(1,0)") - d / F.lit(100).cast("decimal(3,0)"))


def strip_ws(c: ColumnOrName) -> Column:
    """Remove leading and trailing white space (tabs and line breaks too, unlike ``trim``)."""
    return F.regexp_replace(_c(c), r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def title_case(c: ColumnOrName) -> Column:
    """Capitalise the first letter after every non-letter and lower-case the rest.

    ``initcap`` only starts a word after white space; here every run of letters is a word,
    so ``t-shirt`` becomes ``T-Shirt``.
    """
    runs = F.regexp_extract_all(_c(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    cap = F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)),
                                               F.lower(F.substring(r, 2, 1 << 30))))
    return F.when(_c(c).isNull(), F.lit(None).cast("string")).otherwise(F.array_join(cap, ""))


def parse_timestamp(c: ColumnOrName, formats: list[str] | tuple[str, ...]) -> Column:
    """First format that parses wins; text no format accepts becomes NULL (no error)."""
    parsed = [F.try_to_timestamp(_c(c), F.lit(f)) for f in formats]
    out = parsed[0] if len(parsed) == 1 else F.coalesce(*parsed)
    return out.cast("timestamp_ntz")


def month_offset(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """Calendar-month distance (y2 - y1) * 12 + (m2 - m1); not ``months_between``."""
    a, b = _c(later), _c(earlier)
    return ((F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b))).cast("bigint")


def fractional_days(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """Day difference with the fraction kept (julian-day arithmetic).

    ``timestamp_diff`` on timestamp_ntz values involves no time zone, so a gap across a
    daylight-saving change is not shifted by the session time zone."""
    micros = F.timestamp_diff("MICROSECOND", _c(earlier), _c(later))
    return micros.cast("double") / F.lit(86400e6)


def day_start(c: ColumnOrName) -> Column:
    """Midnight of the day, kept as timestamp_ntz."""
    return F.to_date(_c(c)).cast("timestamp_ntz")


def year_month(c: ColumnOrName) -> Column:
    return F.date_format(_c(c), "yyyy-MM")


def canonical_ts(c: ColumnOrName) -> Column:
    return F.date_format(_c(c), "yyyy-MM-dd HH:mm:ss")
