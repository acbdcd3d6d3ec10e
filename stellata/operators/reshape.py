"""Wide <-> long reshaping (one scan, ``Expand``/``Generate`` in the plan)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_years(df: DataFrame, keys: Sequence[str], columns: dict[int, str],
                  year_col: str = "ano", value_col: str = "valor") -> DataFrame:
    """Wide year columns -> (keys…, year, value). ``columns`` maps year -> column.

    Replaces a six-branch ``UNION ALL`` of year slices with a single scan."""
    pairs = [F.struct(F.lit(y).cast("int").alias(year_col), F.col(c).alias(value_col))
             for y, c in columns.items()]
    return df.select(*keys, F.inline(F.array(*pairs)))


def unpivot_measures(df: DataFrame, keys: Sequence[str], measures: dict[str, dict[int, str]],
                     year_col: str = "ano") -> DataFrame:
    """Several measures per year at once: ``measures`` = {measure: {year: column}}.
    Every measure must list the same years. Output: (keys…, year, measure…)."""
    years = sorted(next(iter(measures.values())))
    for m, cols in measures.items():
        if sorted(cols) != years:
            raise ValueError(f"measure {m} lists other years")
    structs = [F.struct(F.lit(y).cast("int").alias(year_col),
                        *[F.col(cols[y]).alias(m) for m, cols in measures.items()])
               for y in years]
    return df.select(*keys, F.inline(F.array(*structs)))


def union_all_slices(df: DataFrame, keys: Sequence[str], columns: dict[int, str],
                     year_col: str = "ano", value_col: str = "valor") -> DataFrame:
    """The ``UNION ALL`` of one slice per year. It is planned as one scan (the slices
    differ in a literal and a column only); same rows as :func:`unpivot_years`."""
    return unpivot_years(df, keys, columns, year_col, value_col)
