"""Appending loads: a table made of batches, each of which counts once.

A batch is written to a folder of its own and committed by one empty marker file, whose name
says everything: the batch's name, its rows and its folder. The name is the fingerprint of
the batch's rows unless the caller gives one. A batch that is loaded again, after a failure or
by two loads at the same time, may have several markers; readers take one folder for each name,
so no order of events adds rows twice. A load that dies leaves a folder that nobody reads.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MARKER = re.compile(r"batch-([0-9a-f]{64})-([0-9]+)-([0-9a-f]{32})$")
#: Hex digits of a row's digest that one sum takes (52 bits, so sums of any table fit).
_DIGITS = 13


@dataclass(frozen=True)
class Batch:
    name: str
    rows: int
    folder: str


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def fingerprint(df: DataFrame) -> tuple[str, int]:
    """(hex digest, rows) of the rows of ``df`` as a bag: equal for equal rows in any order and
    any partitioning, with the columns' names and types. One aggregate, combined in every task."""
    row = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}), 256)
    pieces = [F.conv(F.substring(row, 1 + i * _DIGITS, _DIGITS), 16, 10).cast("decimal(38,0)") for i in range(4)]
    sums = df.agg(F.count(F.lit(1)), *[F.sum(p) for p in pieces]).first()
    whole = ";".join([df.schema.simpleString(), *map(str, sums)])
    return hashlib.sha256(whole.encode()).hexdigest(), sums[0]


def batches(spark: SparkSession, root: str) -> list[Batch]:
    """The committed batches under ``root``, one for each name."""
    fs, pattern = _fs(spark, f"{root.rstrip('/')}/batch-*")
    found = {}
    for status in fs.globStatus(pattern) or []:
        if m := _MARKER.search(status.getPath().toString()):
            name, rows, folder = m.groups()
            folder = f"{root.rstrip('/')}/rows-{folder}"
            if name not in found or folder < found[name].folder:
                found[name] = Batch(name, int(rows), folder)
    return sorted(found.values(), key=lambda b: b.name)


def append_batch(df: DataFrame, root: str, batch: str | None = None) -> bool:
    """Append the rows of ``df`` to the table under ``root``, unless this batch is in it already;
    whether they were added. Two batches are the same if their rows are (as bags) or, where ``batch``
    names them, if the names are; a caller who loads equal rows on purpose names the batches.
    ``df`` is computed once; a named batch that is known is not computed at all. A batch without
    rows adds nothing."""
    spark = df.sparkSession
    named = hashlib.sha256(f"name:{batch}".encode()).hexdigest() if batch is not None else None
    if named in {b.name for b in batches(spark, root)}:
        return False
    own = uuid.uuid4().hex
    folder = f"{root.rstrip('/')}/rows-{own}"
    df.write.parquet(folder)
    name, rows = fingerprint(spark.read.schema(df.schema).parquet(folder))
    name = named or name
    if not rows or name in {b.name for b in batches(spark, root)}:
        fs, path = _fs(spark, folder)
        fs.delete(path, True)
        return False
    fs, path = _fs(spark, f"{root.rstrip('/')}/batch-{name}-{rows}-{own}")
    fs.create(path, False).close()
    return True


def read_batches(spark: SparkSession, root: str) -> DataFrame:
    """The rows of all committed batches."""
    found = batches(spark, root)
    if not found:
        raise FileNotFoundError(f"no committed batch under {root}")
    return spark.read.parquet(*[b.folder for b in found])
