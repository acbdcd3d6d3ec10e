"""Rendering of results as XML and JSON documents (SQL/XML and SQL/JSON)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellata.functions.text import xml_element, xml_escape


def xml_rows(df: DataFrame, row_tag: str, fields: Sequence[tuple[str, Column]]) -> Column:
    """``XMLELEMENT(row_tag, XMLELEMENT(tag, value), …)`` for each row."""
    return F.concat(F.lit(f"<{row_tag}>"), *[xml_element(t, v) for t, v in fields],
                    F.lit(f"</{row_tag}>"))


def xml_document(df: DataFrame, root_tag: str, attrs: dict[str, str], element: Column,
                 order: Sequence[Column], k: int, out: str = "xml_resultado") -> DataFrame:
    """``XMLELEMENT(root, XMLATTRIBUTES(…), XMLAGG(element ORDER BY …))`` over the
    first ``k`` rows in ``order`` (``FETCH FIRST k``), as one row with one string.
    The top-k is taken first (each task keeps k rows), so the single aggregate
    that forms the document sees at most k rows."""
    attr_text = "".join(f' {a}="{v}"' for a, v in attrs.items())
    sort_key = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)])
    top = df.select(F.struct(sort_key.alias("k"), element.alias("e")).alias("_x")) \
        .orderBy(F.col("_x.k")).limit(k)
    agg = top.agg(F.array_sort(F.collect_list("_x")).alias("_xs"))
    body = F.array_join(F.transform("_xs", lambda s: s["e"]), "")
    return agg.select(F.concat(F.lit(f"<{root_tag}{attr_text}>"), body,
                               F.lit(f"</{root_tag}>")).alias(out))


def json_number(c: Column) -> Column:
    """A number as JSON text in its shortest decimal form, as Oracle writes
    NUMBER values (``18.50`` -> ``18.5``, ``7.00`` -> ``7``, ``0.50`` -> ``0.5``).
    Give exact decimals or integers (a double's text may use an exponent)."""
    s = c.cast("string")
    return F.when(s.contains("."), F.regexp_replace(s, r"\.?0+$", "")).otherwise(s)


def json_object(fields: Sequence[tuple[str, Column]], numeric: Sequence[str] = ()) -> Column:
    """``JSON_OBJECT(k VALUE v, …)``: keys in the given order, NULL values kept
    as ``null``. Keys listed in ``numeric`` are written as JSON numbers in
    shortest decimal form; other values are written by Spark's JSON writer
    (strings quoted and escaped)."""
    parts = []
    for i, (k, v) in enumerate(fields):
        if k in numeric:
            text = json_number(v)
        else:
            # Spark's writer on a one-element array ('["..."]' or '[null]'), brackets cut
            text = F.regexp_extract(F.to_json(F.array(v)), r"^\[(.*)\]$", 1)
        sep = "{" if i == 0 else ","
        parts += [F.lit(f'{sep}"{k}":'), F.coalesce(text, F.lit("null"))]
    parts.append(F.lit("}"))
    return F.concat(*parts)


__all__ = ["json_object", "xml_document", "xml_escape", "xml_rows"]
