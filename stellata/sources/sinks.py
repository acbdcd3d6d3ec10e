"""Sinks: CSV files, the GDP XML document, staging/star tables.

All writes are Spark writes (one file per task, or ``single_file=True`` to
coalesce to one writer when a downstream tool wants exactly one file — only for
small outputs). ``mode="overwrite"`` keeps re-runs idempotent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellata.functions.text import strip_dot_zero
from stellata.operators.aggregates import observed_counts


def write_csv(df: DataFrame, path: str, sep: str = ";", header: bool = True,
              single_file: bool = False, sort_by: Sequence[str] = ()) -> None:
    """CSV without an index column. ``sort_by`` gives a globally sorted output
    (range-partitioned, sorted within partitions — no single-task sort)."""
    out = df
    if sort_by:
        cols = [F.col(c).asc_nulls_last() for c in sort_by]
        out = out.repartitionByRange(*cols).sortWithinPartitions(*cols)
    if single_file:
        out = out.coalesce(1)
    (out.write.mode("overwrite").option("sep", sep).option("header", header)
     .option("encoding", "UTF-8").csv(path))


def write_daily_weather(daily: DataFrame, path: str) -> dict:
    """Daily weather as ``,``-separated CSV with header, ordered by (station,
    date text); returns the row count observed during the write (one pass)."""
    cols = [F.col(c).asc_nulls_last() for c in ("codigo_estacao", "data")]
    ordered = daily.repartitionByRange(*cols).sortWithinPartitions(*cols)
    # observed above the range exchange: the boundary-sampling job runs only
    # the part below it, so every row is counted once
    counted, obs = observed_counts(ordered, "daily")
    write_csv(counted, path, sep=",")
    return obs.get


def write_gdp_xml(df: DataFrame, path: str, root_tag: str = "pib_municipios",
                  row_tag: str = "municipio", single_document: bool = False) -> None:
    """``<pib_municipios><municipio>…</municipio>…``: every column as a child
    element; NULL becomes an empty element; number text loses a trailing ``.0``;
    ``&`` and ``<`` are escaped by the XML writer. One document per partition by
    default; ``single_document=True`` has one writer make one document, for a table of
    bounded size (an administrative set)."""
    cols = [F.coalesce(strip_dot_zero(F.col(c).cast("string")), F.lit("")).alias(c)
            for c in df.columns]
    out = df.select(*cols)
    if single_document:
        out = out.coalesce(1)
    (out.write.mode("overwrite").format("xml")
     .option("rootTag", root_tag).option("rowTag", row_tag).save(path))


def _write_document(df: DataFrame, path: str, value: Column, sort_by: Sequence[str],
                    head: str, tail: str | None) -> None:
    """Part files that, one after the other in the order of their names, are one document:
    ``head``, the rows' texts by ``sort_by``, ``tail``. Head and tail are rows that sort
    first and last, so a range partition places them and no task sees the whole."""
    if not sort_by:
        raise ValueError("a document needs an order: give sort_by")
    keys = [f"k{i}" for i in range(len(sort_by))]
    body = df.select(F.lit(1).alias("place"), value.alias("value"),
                     *[F.col(c).alias(k) for c, k in zip(sort_by, keys)])
    ends = [(0, head)] + ([] if tail is None else [(2, tail)])
    ends = df.sparkSession.createDataFrame(ends, "place int, value string")
    order = [F.col("place"), *[F.col(k).asc_nulls_last() for k in keys]]
    (body.unionByName(ends, allowMissingColumns=True).repartitionByRange(*order)
     .sortWithinPartitions(*order).select("value").write.mode("overwrite").text(path))


def write_csv_document(df: DataFrame, path: str, sort_by: Sequence[str], sep: str = ";") -> None:
    """One ordered CSV written by many tasks: the part files joined in the order of their
    names (``hadoop fs -getmerge``) are the file that ``write_csv`` makes with one task, its
    header once at the top. An empty table gives the header alone."""
    head = df.sparkSession.range(1).select(
        F.to_csv(F.struct(*[F.lit(c).alias(c) for c in df.columns]), {"sep": sep})).first()[0]
    _write_document(df, path, F.to_csv(F.struct(*[F.col(c) for c in df.columns]), {"sep": sep}),
                    sort_by, head, None)


def write_xml_document(df: DataFrame, path: str, sort_by: Sequence[str], root_tag: str = "pib_municipios",
                       row_tag: str = "municipio") -> None:
    """One ordered XML document written by many tasks, values as in ``write_gdp_xml``: the part
    files joined in the order of their names are the document that one task writes, with a
    line break after it; declaration and root are at its ends only. An empty table gives an
    empty root."""
    def element(c):
        value = F.coalesce(strip_dot_zero(F.col(c).cast("string")), F.lit(""))
        for mark, entity in (("&", "&amp;"), ("<", "&lt;"), ("]]>", "]]&gt;")):  # as the XML writer does
            value = F.replace(value, F.lit(mark), F.lit(entity))
        return F.concat(F.lit(f"        <{c}>"), value, F.lit(f"</{c}>\n"))

    row = F.concat(F.lit(f"    <{row_tag}>\n"), *[element(c) for c in df.columns], F.lit(f"    </{row_tag}>"))
    _write_document(df, path, row, sort_by,
                    f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n<{root_tag}>', f"</{root_tag}>")


def write_table(df: DataFrame, path: str | None = None, table: str | None = None,
                partition_by: Sequence[str] = ()) -> None:
    """Load a staging or star table (``INSERT INTO … SELECT`` / bulk insert):
    Parquet at ``path`` or a catalog ``table``; overwrite, so a re-run replaces
    the previous load instead of appending duplicates."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if table:
        w.saveAsTable(table)
    elif path:
        w.parquet(path)
    else:
        raise ValueError("give a path or a table name")
