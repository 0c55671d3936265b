"""Cleansing rules as Column expressions.

Every rule is a built-in expression, so it stays inside the JVM and inside
whole-stage codegen; none needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code tables of the source warehouse (code -> label).
MARITAL = {"S": "Single", "M": "Married"}
GENDER = {"F": "Female", "M": "Male"}
PRODUCT_LINE = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}
ERP_GENDER = {"F": "Female", "FEMALE": "Female", "M": "Male", "MALE": "Male"}
COUNTRY = {"DE": "Germany", "US": "United States", "USA": "United States"}
UNKNOWN = "n/a"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def map_codes(col: Column | str, mapping: dict[str, str], default: str = UNKNOWN) -> Column:
    """CASE on UPPER(TRIM(col)); first match wins, anything else -> default."""
    key = F.upper(F.trim(_c(col)))
    out = None
    for code, label in mapping.items():
        out = F.when(key == code, label) if out is None else out.when(key == code, label)
    return out.otherwise(default)


def normalize_country(col: Column | str) -> Column:
    """Country codes to names; blank or NULL -> n/a; otherwise trimmed text."""
    t = F.trim(_c(col))
    out = None
    for code, label in COUNTRY.items():
        out = F.when(t == code, label) if out is None else out.when(t == code, label)
    return out.when((t == "") | _c(col).isNull(), UNKNOWN).otherwise(t)


def parse_int_date(col: Column | str, strict: bool = False) -> Column:
    """INT yyyymmdd -> DATE.  0 or not eight characters -> NULL.

    An eight-digit value that is no calendar date gives NULL, or raises with
    ``strict=True`` (the source engine aborted the load in that case).

    The default path is integer arithmetic (year, month, day by division,
    checked against the month's length) and ~30x faster than formatting and
    parsing text; it runs three times per sales row.  Every ``make_date``
    sits behind a guard that short-circuits, so it never sees invalid parts.
    Eight characters means 10000000..99999999: a negative number of eight
    characters is never a date either.
    """
    c = _c(col)
    if strict:
        text = c.cast("string")
        return F.when((c == 0) | (F.length(text) != 8), F.lit(None).cast("date")).otherwise(
            F.to_date(text, "yyyyMMdd"))
    y = F.call_function("div", c, F.lit(10000))
    m = F.call_function("div", c, F.lit(100)) % 100
    d = c % 100
    ok = (c >= 10000000) & (c <= 99999999) & (m >= 1) & (m <= 12) & (d >= 1)
    month_start = F.make_date(y, F.when(ok, m).otherwise(1), F.lit(1))
    ok = ok & (d <= F.dayofmonth(F.last_day(month_start)))
    return F.when(ok, F.make_date(y, m, F.when(ok, d).otherwise(1)))


def int_div(a: Column, b: Column) -> Column:
    """Integer division truncating toward zero; NULL when ``b`` is 0."""
    return F.call_function("div", a, F.nullif(b, F.lit(0)))


def reconcile_sales(sales: Column, qty: Column, price: Column) -> Column:
    """Recompute sales as qty * |price| when missing, non-positive or inconsistent."""
    expected = qty.cast("long") * F.abs(price).cast("long")  # wide before the product
    return F.when(sales.isNull() | (sales <= 0) | (sales != expected), expected).otherwise(sales)


def repair_price(price: Column, sales: Column, qty: Column) -> Column:
    """Derive price from the *raw* sales when missing or non-positive."""
    return F.when(price.isNull() | (price <= 0), int_div(sales, qty).cast("long")).otherwise(price)


def strip_prefix(col: Column | str, prefix: str) -> Column:
    c = _c(col)
    return F.when(c.startswith(prefix), F.substring(c, len(prefix) + 1, 1 << 30)).otherwise(c)


def null_after(col: Column | str, as_of: str) -> Column:
    """NULL for values after ``as_of`` (future dates)."""
    c = _c(col)
    return F.when(c > F.lit(as_of).cast("date"), F.lit(None).cast("date")).otherwise(c)


def round_ratio(num: Column, den: Column, digits: int, scale: int = 100) -> Column:
    """ROUND(scale * num / NULLIF(den, 0), digits) computed exactly.

    Integer arithmetic on decimal(38,0), rounding half away from zero like
    the source engine's numeric ROUND; the result is a double.  Exact so that
    any engine computing the same definition gets the same double.
    """
    n = num.cast("decimal(38,0)")
    d = F.nullif(den, F.lit(0)).cast("decimal(38,0)")
    m = scale * 10 ** digits
    q = F.call_function("div", F.abs(n) * (2 * m) + F.abs(d), F.abs(d) * 2)
    signed = F.when((n < 0) != (d < 0), -q).otherwise(q)
    return signed.cast("double") / F.lit(float(10 ** digits))
