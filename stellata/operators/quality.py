"""Data-quality jobs standing in for the constraints the warehouse declared
(primary keys, NOT NULL, foreign keys, JSON/number/length checks). Parquet tables
enforce none of them, so each is a query that returns the offending rows (an
empty result means the constraint holds). All are distributed: group-by,
anti-join or a filter; nothing is collected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Primary key: key values present more than once, with their count.
    Rows with a NULL key part are reported too (a key must be non-NULL)."""
    k = list(key)
    dup = df.groupBy(*k).agg(F.count(F.lit(1)).alias("ocorrencias"))
    null_part = F.lit(False)
    for c in k:
        null_part = null_part | F.col(c).isNull()
    return dup.where((F.col("ocorrencias") > 1) | null_part)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NOT NULL: one row per column with the number of NULLs (single pass)."""
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in columns])
    pairs = [F.struct(F.lit(c).alias("coluna"), F.col(c).alias("nulos")) for c in columns]
    return counts.select(F.inline(F.array(*pairs)))


def orphans(child: DataFrame, fk: Sequence[str], parent: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Foreign key: child rows whose non-NULL key has no parent (anti-join)."""
    cond = None
    for c in fk:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    parent_keys = parent.select(*[F.col(p).alias(c) for p, c in zip(pk, fk)]).distinct()
    return child.where(cond).join(parent_keys, list(fk), "left_anti")


def domain_violations(df: DataFrame, checks: dict[str, Column], keep: Sequence[str]) -> DataFrame:
    """Rows failing any named check (a Column that is True when the row is bad),
    with the list of failed check names — the rejects table."""
    failed = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in checks.items()]))
    return (df.select(*keep, failed.alias("falhas"))
            .where(F.size("falhas") > 0))


def is_json(c: Column) -> Column:
    """``IS JSON`` check: text that parses as JSON."""
    return F.try_parse_json(c).isNotNull() | c.isNull()


def fits_decimal(c: Column, precision: int, scale: int) -> Column:
    """Value fits ``NUMBER(p,s)`` (after half-up rounding to ``s``)."""
    return c.isNull() | c.try_cast(f"decimal({precision},{scale})").isNotNull()


def fits_length(c: Column, n: int) -> Column:
    return c.isNull() | (F.length(c) <= n)
