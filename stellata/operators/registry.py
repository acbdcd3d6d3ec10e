"""Surrogate keys that survive the next load.

A registry holds the key of every natural key ever loaded. A load joins its rows with the
registry; natural keys that are new get numbers above the largest one given so far, in
their order, by ``dense_key`` (no sort in one task). What a load adds is a generation of
the registry: a folder of its own, made visible by creating one marker exclusively. Of two
loads that number the same generation one commits; the other reads its generation and
numbers what is still new.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellata.operators.keys import dense_key

_GENERATION = re.compile(r"g-([0-9]{8})$")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def generations(spark: SparkSession, root: str) -> list[tuple[str, int]]:
    """(folder, largest key) of the committed generations, oldest first."""
    fs, pattern = _fs(spark, f"{root.rstrip('/')}/g-*")
    out = []
    for found in sorted((f.getPath() for f in fs.globStatus(pattern) or []), key=lambda p: p.toString()):
        if _GENERATION.search(found.toString()):
            stream = fs.open(found)
            folder, last = bytes(stream.readAllBytes()).decode().split("\n")
            stream.close()
            out.append((f"{root.rstrip('/')}/{folder}", int(last)))
    return out


def known_keys(spark: SparkSession, root: str, natural: Sequence[str], key: str = "sk",
               like: DataFrame | None = None) -> DataFrame:
    """The registry: one row per natural key. ``like`` gives the columns' types while it is empty."""
    found = generations(spark, root)
    if found:
        return spark.read.parquet(*[folder for folder, _ in found]).select(*natural, key)
    return like.select(*natural, F.lit(0).cast("bigint").alias(key)).limit(0)


def register_keys(incoming: DataFrame, root: str, natural: Sequence[str], key: str = "sk") -> DataFrame:
    """Add the natural keys of ``incoming`` that the registry under ``root`` lacks; returns the
    registry. Keys given before never change, a repeated load adds nothing, and null is a
    value of a natural key like any other. Rows that repeat a natural key get one key."""
    spark = incoming.sparkSession
    distinct = incoming.select(*natural).distinct()
    while True:
        found = generations(spark, root)
        last = max([0, *[n for _, n in found]])
        known = known_keys(spark, root, natural, key, distinct).drop(key)
        same = None
        for c in natural:
            one = F.col(f"i.{c}").eqNullSafe(F.col(f"k.{c}"))
            same = one if same is None else same & one
        new = distinct.alias("i").join(known.alias("k"), same, "left_anti")
        folder = f"keys-{uuid.uuid4().hex}"
        target = f"{root.rstrip('/')}/{folder}"
        dense_key(new, natural, key, start=last + 1).write.parquet(target)
        written = spark.read.parquet(target).agg(F.max(key)).first()[0]
        fs, marker = _fs(spark, f"{root.rstrip('/')}/g-{len(found):08d}")
        if written is None:
            fs.delete(_fs(spark, target)[1], True)
            return known_keys(spark, root, natural, key, distinct)
        try:
            out = fs.create(marker, False)
        except Exception as error:  # another load committed this generation first
            if not fs.exists(marker):
                raise error
            fs.delete(_fs(spark, target)[1], True)
            continue
        out.write(bytearray(f"{folder}\n{written}".encode()))
        out.close()
        return known_keys(spark, root, natural, key, distinct)


def with_keys(rows: DataFrame, registry: DataFrame, natural: Sequence[str], key: str = "sk") -> DataFrame:
    """``rows`` with the registered key of their natural key (null if it is not registered)."""
    same = None
    for c in natural:
        one = F.col(f"i.{c}").eqNullSafe(F.col(f"k.{c}"))
        same = one if same is None else same & one
    return rows.alias("i").join(registry.alias("k"), same, "left").select("i.*", F.col(f"k.{key}").alias(key))
