"""Constraints that a load must meet before its tables become visible.

NOT NULL and domain constraints are counted while a table is written (``observe``, no pass
of their own); unique and foreign keys are counted on the table that was written, by an
aggregate and an anti-join on the keys alone. Only counts reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stellata.operators.quality import duplicate_keys, orphans


@dataclass(frozen=True)
class NotNull:
    column: str

    def name(self) -> str:
        return f"not null: {self.column}"


@dataclass(frozen=True)
class Check:
    """``bad`` is true for a row that breaks the constraint."""
    label: str
    bad: Column

    def name(self) -> str:
        return f"check: {self.label}"


@dataclass(frozen=True)
class Unique:
    """No two rows with the same key, and no null in it."""
    key: Sequence[str]

    def name(self) -> str:
        return f"unique: {', '.join(self.key)}"

    def broken(self, df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
        return duplicate_keys(df, self.key)


@dataclass(frozen=True)
class References:
    """Keys without a null are keys of a table loaded before."""
    key: Sequence[str]
    table: str
    target: Sequence[str]

    def name(self) -> str:
        return f"references: {', '.join(self.key)} -> {self.table}"

    def broken(self, df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
        return orphans(df.select(*self.key), self.key, tables[self.table], self.target)


Constraint = NotNull | Check | Unique | References


class LoadRefused(Exception):
    """A load broke constraints: ``found`` has (table, constraint, offending rows or keys)."""

    def __init__(self, found: list[tuple[str, str, int]], version: str | None = None):
        super().__init__("; ".join(f"{t}: {c} ({n})" for t, c, n in found))
        self.found, self.version = found, version


def observed(df: DataFrame, constraints: Sequence[Constraint]) -> tuple[DataFrame, Observation | None, list[str]]:
    """``df`` with counters of the constraints that a row breaks by itself, to be read from the
    observation after the write, and their names."""
    own = [c for c in constraints if isinstance(c, (NotNull, Check))]
    if not own:
        return df, None, []
    bad = [F.col(c.column).isNull() if isinstance(c, NotNull) else c.bad for c in own]
    watch = Observation()
    return (df.observe(watch, *[F.count(F.when(b, F.lit(1))).alias(f"c{i}") for i, b in enumerate(bad)]), watch,
            [c.name() for c in own])


def write_gated(df: DataFrame, path: str, table: str, constraints: Sequence[Constraint],
                tables: dict[str, DataFrame]) -> list[tuple[str, str, int]]:
    """Write ``df`` and count what breaks its constraints: (table, constraint, offenders). The
    keys that offend a key constraint are written beside the table, in ``_rejected``."""
    spark = df.sparkSession
    watched, watch, names = observed(df, constraints)
    watched.write.parquet(path)
    counts = watch.get if watch else {}
    found = [(table, name, counts[f"c{i}"]) for i, name in enumerate(names) if counts[f"c{i}"]]
    back = spark.read.schema(df.schema).parquet(path)
    head, _, last = path.rstrip("/").rpartition("/")
    for i, c in enumerate(c for c in constraints if isinstance(c, (Unique, References))):
        broken = c.broken(back, tables)
        if n := broken.count():
            found.append((table, c.name(), n))
            broken.write.parquet(f"{head}/_rejected/{last}-{i}")
    return found
