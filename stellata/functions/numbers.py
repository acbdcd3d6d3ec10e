"""Number parsing and exact rounding expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from stellata.functions.text import strip_ws

# ---------------------------------------------------------------------------
# Texts the hourly weather cleaner treats as "no reading".
MISSING_READINGS = ("", "-9999", "-9999.0", "null", "NULL", "-")
# Sentinel used by the weather network for a missing reading, in any spelling.
SENTINEL = -9999.0
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_decimal(c, precision: int, scale: int) -> Column:
    """``TO_NUMBER(TRIM(x))`` into ``decimal(p,s)``; unparsable text gives NULL
    (the row can be routed to a rejects table with :func:`is_bad_number`)."""
    return F.trim(_col(c)).try_cast(f"decimal({precision},{scale})")


def is_bad_number(c, precision: int, scale: int) -> Column:
    """True when a non-blank text does not fit ``decimal(p,s)``."""
    t = F.trim(_col(c))
    return (t.isNotNull() & (t != "")) & t.try_cast(f"decimal({precision},{scale})").isNull()


def dash_to_zero(c, dtype: str = "int") -> Column:
    """Case count text: ``'-'`` or NULL means 0, anything else is ``TO_NUMBER(TRIM(x))``.

    A bad value raises under ANSI (as the source load fails on it)."""
    x = _col(c)
    return F.when((x == "-") | x.isNull(), F.lit(0).cast(dtype)).otherwise(F.trim(x).cast(dtype))


def tolerant_float(c, null_sentinel: bool = True) -> Column:
    """Hourly weather reading: strip, decimal comma -> point; the texts in
    ``MISSING_READINGS`` and unparsable text are NULL. With ``null_sentinel`` any
    value equal to -9999 (``-9999,00`` etc.) is NULL too. NaN/Infinity text is NULL."""
    s = F.replace(strip_ws(c), F.lit(","), F.lit("."))
    v = F.when(~s.isin(*MISSING_READINGS), s).try_cast("double")
    # the number stands in a condition that is always evaluated, so that a text is parsed once
    good = F.abs(v) < float("inf")
    if null_sentinel:
        good &= v != SENTINEL
    return F.when(good, v)


def locale_number(c, precision: int = 10, scale: int = 2) -> Column:
    """``'1.234,56'`` (dot thousands, comma decimals) -> decimal(p,s)."""
    s = F.replace(F.replace(F.trim(_col(c)), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return s.try_cast(f"decimal({precision},{scale})")


# --- exact half-up rounding ---------------------------------------------------
# Oracle NUMBER arithmetic divides exactly and ROUND rounds half away from zero.
# Spark's decimal division keeps only ~6 fractional digits, so ROUND(a/b, 2) on
# it can round twice. These helpers scale both sides to integers and do the
# rounding with integer arithmetic, which is exact for any group size.

def _int_div(num: Column, den: Column) -> Column:
    """Exact floor division of non-negative integral values (the numerator is
    made an exact multiple before dividing)."""
    return (num - F.pmod(num, den)) / den


def _ratio_long(n: Column, d: Column, scale: int) -> Column:
    """Half-up ratio on bigints whose every intermediate stays below 2^53, so
    long and double arithmetic are exact (no per-row BigDecimal work)."""
    an, ad = F.abs(n), F.abs(d)
    q = _int_div(an * (2 * 10 ** scale) + ad, ad * 2)
    signed = F.when((n < 0) != (d < 0), -q).otherwise(q)
    return _shift(signed.cast("bigint"), scale)


def _shift(unscaled: Column, scale: int) -> Column:
    """``unscaled × 10^-scale`` as ``decimal(38, scale)``: a long-backed decimal
    times an exact literal (cheaper than a division or a cast from double)."""
    d = unscaled.cast("decimal(18,0)")
    if scale:
        d = d * F.lit(Decimal(1).scaleb(-scale))
    return d.cast(f"decimal(38,{scale})")


def _ratio_decimal(n: Column, d: Column, scale: int) -> Column:
    an, ad = F.abs(n), F.abs(d)
    q = _int_div(an * (2 * 10 ** scale) + ad, ad * 2).cast("decimal(38,0)")
    signed = F.when((n < 0) != (d < 0), -q).otherwise(q)
    return (signed / (10 ** scale)).cast(f"decimal(38,{scale})")


def ratio_half_up(num, den, scale: int = 2, in_scale: int = 0) -> Column:
    """``ROUND(num / den, scale)`` exactly, half away from zero, as
    ``decimal(38, scale)``. ``num`` and ``den`` hold at most ``in_scale``
    fractional digits. NULL when ``den`` is NULL or 0 (the ``NULLIF`` guard).

    Integral inputs below ``10^(13 - scale)`` take a bigint path; larger ones
    (or fractional inputs) a decimal(38) path — both exact."""
    m = 10 ** in_scale
    n = (_col(num).cast(f"decimal(38,{in_scale})") * m).cast("decimal(38,0)")
    d = (_col(den).cast(f"decimal(38,{in_scale})") * m).cast("decimal(38,0)")
    slow = F.when(d != 0, _ratio_decimal(n, d, scale))
    if in_scale:
        return slow
    limit = 10 ** (13 - scale)
    nl, dl = _col(num).cast("bigint"), _col(den).cast("bigint")
    small = (F.abs(_col(num)) < limit) & (F.abs(_col(den)) < limit)
    return (F.when(_col(den) == 0, F.lit(None).cast(f"decimal(38,{scale})"))
            .when(small, _ratio_long(nl, dl, scale))
            .otherwise(slow))


def units(c, in_scale: int = 0) -> Column:
    """Per-row value in integer units of ``10^-in_scale`` (bigint), for exact
    sums that stay on Spark's fast long arithmetic. Exact for values with at
    most ``in_scale`` decimals and ``|value| * 10^in_scale < 2^50``."""
    x = _col(c)
    if in_scale == 0:
        return x.cast("bigint")
    return F.round(x.cast("double") * (10 ** in_scale)).cast("bigint")


def avg_half_up(c, scale: int = 2, in_scale: int = 0) -> Column:
    """``ROUND(AVG(c), scale)`` exactly (aggregate expression); NULLs skipped,
    NULL for a group with no values. Rows add bigint units; the one division
    per group is exact."""
    x = _col(c)
    return ratio_half_up(F.sum(units(x, in_scale)), F.count(x) * (10 ** in_scale), scale)


def sum_exact(c, in_scale: int = 2) -> Column:
    """``SUM(c)`` exactly as ``decimal(38, in_scale)`` (aggregate expression)."""
    total = F.sum(units(c, in_scale)).cast("decimal(38,0)")
    if not in_scale:
        return total
    return (total * F.lit(Decimal(1).scaleb(-in_scale))).cast(f"decimal(38,{in_scale})")
