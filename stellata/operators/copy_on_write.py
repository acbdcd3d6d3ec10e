"""Tables kept by parts (years), of which an update rewrites only those that it changes.

A version is a folder with the parts that it wrote and a marker that commits it. A reader
takes, for every part, the folder of the newest committed version that holds it: parts that
an update does not touch stay where they are, readers see all of an update or nothing, and
an update that dies leaves a version that nobody reads.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellata.operators.joins import update_where_exists
from stellata.plans.warehouse import _hadoop, commit, new_version, versions

#: The folder level that holds a copy of the part's value; the files hold the column itself.
_PART = "_parte"


def parts(spark: SparkSession, root: str) -> dict[str, str]:
    """Folder of every part, by its name, in the newest version that has it."""
    found = {}
    for version in versions(spark, root):
        fs, pattern = _hadoop(spark, f"{version}/{_PART}=*")
        for status in fs.globStatus(pattern) or []:
            found[status.getPath().getName().partition("=")[2]] = status.getPath().toString()
    return found


def write_parts(df: DataFrame, root: str, part: str) -> str:
    """Write the rows of ``df`` as a version of the parts that they belong to (all of those
    parts' rows must be there) and commit it; returns the version. ``part`` is a column of
    few values without nulls. A hot part is written by many tasks: rows stay where they are."""
    version = new_version(root)
    df.withColumn(_PART, F.col(part).cast("string")).write.partitionBy(_PART).parquet(version)
    commit(df.sparkSession, version)
    return version


def read_parts(spark: SparkSession, root: str, only: Iterable | None = None) -> DataFrame:
    """The table, or some of its parts."""
    found = parts(spark, root)
    wanted = list(found) if only is None else [str(v) for v in only]
    return spark.read.parquet(*[found[v] for v in wanted])


def update_parts(spark: SparkSession, root: str, part: str, values: DataFrame, value_keys: Sequence[str],
                 column: str, guard: DataFrame, guard_keys: Sequence[str]) -> list[str]:
    """``UPDATE … SET column = (SELECT …) WHERE EXISTS (…)`` (see ``update_where_exists``) on the
    table under ``root``, as a new version of the parts with a guarded row; returns their names.

    Two passes: a semi-join on the keys alone, of which only the parts' values (one per part)
    reach the driver, then the update of those parts. Without a guarded row nothing is written."""
    keys = guard.select(*guard_keys).distinct()
    touched = sorted(str(r[0]) for r in read_parts(spark, root).select(part, *[k for k in guard_keys if k != part])
                     .join(keys, list(guard_keys), "left_semi").select(part).distinct().collect())
    if touched:
        rows = read_parts(spark, root, touched)
        new = update_where_exists(rows, values, value_keys, column, guard, guard_keys)
        kept = new.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in rows.schema])
        write_parts(kept, root, part)
    return touched
