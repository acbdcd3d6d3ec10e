"""Text cleaning expressions. All are plain Column expressions (JVM side, codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the source warehouse's for matching names).
# Accented letters folded by the name key, in the source's own order:
ACCENTED = "áàãâäéèêëíìîïóòõôöúùûüçÁÀÃÂÄÉÈÊËÍÌÎÏÓÒÕÔÖÚÙÛÜÇ"
# The source's replacement string. It is 48 characters for 46 accented ones
# (six leading A's for five accented a's), so from "é" on every letter maps to
# the letter one slot to the left. Kept only for the "compat" mode.
COMPAT_PLAIN = "AAAAAAEEEEIIIIOOOOOUUUUCAAAAAAEEEEIIIIOOOOOUUUUC"
# The aligned replacement (one plain letter per accented letter).
CORRECT_PLAIN = "aaaaaeeeeiiiiooooouuuucAAAAAEEEEIIIIOOOOOUUUUC"
# Cell texts that the source's table reader takes for a missing value:
NULL_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
              "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
# ---------------------------------------------------------------------------

ACCENT_MODES = ("correct", "compat")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fold_accents(c, mode: str = "correct") -> Column:
    """Replace accented Latin letters by plain ones (``translate``)."""
    if mode not in ACCENT_MODES:
        raise ValueError(f"mode must be one of {ACCENT_MODES}, got {mode!r}")
    target = CORRECT_PLAIN if mode == "correct" else COMPAT_PLAIN
    return F.translate(_col(c), ACCENTED, target)


def accent_key(c, mode: str = "correct") -> Column:
    """Join key for place names: trim, fold accents, upper-case.

    ``mode="compat"`` reproduces the source's shifted map, so that é becomes A,
    í becomes E and so on; with it about a quarter of the municipalities find no
    region. ``mode="correct"`` is the aligned map.
    """
    return F.upper(fold_accents(F.trim(_col(c)), mode))


def null_text(c) -> Column:
    """The cell, or NULL if it is one of the texts that mean a missing value."""
    return F.when(~_col(c).isin(*NULL_TEXTS), _col(c))


# The ASCII whitespace set (what ``\s`` matches in Java regex).
WHITESPACE = " \t\n\r\x0b\x0c"


def strip_ws(c) -> Column:
    """``str.strip()`` for ASCII whitespace: remove leading/trailing spaces, tabs,
    line breaks, vertical tabs and form feeds (``btrim``, no regex)."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def ibge_code(raw) -> Column:
    """First six characters of ``'410010 ABATIA'`` trimmed (the municipality code)."""
    return F.trim(F.substring(_col(raw), 1, 6))


def ibge_name(raw) -> Column:
    """Characters from position 8 of ``'410010 ABATIA'`` trimmed (the name)."""
    return F.trim(F.substring(_col(raw), 8, 1 << 30))


def starts_with_code(raw, digits: int = 6) -> Column:
    """``REGEXP_LIKE(raw, '^\\d{6}')``."""
    return _col(raw).rlike(f"^[0-9]{{{digits}}}")


def xml_escape(c) -> Column:
    """Escape the five XML special characters (``&`` first)."""
    x = _col(c)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def xml_element(tag: str, value) -> Column:
    """``<tag>escaped value</tag>``; NULL value gives an empty element."""
    return F.concat(F.lit(f"<{tag}>"), F.coalesce(xml_escape(value), F.lit("")), F.lit(f"</{tag}>"))


def number_text(c) -> Column:
    """Render a number the way ``TO_CHAR(number)`` does: no trailing zeros after
    the decimal point, no dangling point (``32.50`` -> ``32.5``, ``7.00`` -> ``7``)
    and no leading zero before the point (``0.5`` -> ``.5``)."""
    s = _col(c).cast("string")
    trimmed = F.when(s.contains("."), F.regexp_replace(s, r"\.?0+$", "")).otherwise(s)
    return F.regexp_replace(trimmed, r"^(-?)0\.", "$1.")


def strip_dot_zero(c) -> Column:
    """Drop one trailing ``.0`` from number text (``'1234.0'`` -> ``'1234'``)."""
    return F.regexp_replace(_col(c), r"\.0$", "")


def clean_clock(c) -> Column:
    """``'1200 UTC'`` -> ``'1200'`` (strip, remove the `` UTC`` suffix)."""
    return F.replace(strip_ws(c), F.lit(" UTC"), F.lit(""))
