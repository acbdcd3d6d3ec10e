"""Surrogate keys.

* :func:`grain_key` — a key computed from the natural key of a row (no global
  ordering, no shuffle). Used for dimensions whose natural key is integral.
* :func:`dense_key` — ``ROW_NUMBER() OVER (ORDER BY keys)`` without a single-task
  sort: range-partition, sort within partitions, materialise with a reliable
  checkpoint, then add per-partition offsets computed from per-partition counts
  (one row per partition, so that table's size is bounded by the partition count).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stellata.session import checkpoint_dir


def grain_key(*parts: tuple[str | Column, int]) -> Column:
    """Mixed-radix key from integral parts: ``grain_key((a, 1), (b, 10000))`` =
    ``a * 10000 + b``. Each part's radix must exceed the next part's range."""
    key = None
    for col, radix in parts:
        c = (F.col(col) if isinstance(col, str) else col).cast("bigint")
        key = c if key is None else key * F.lit(radix).cast("bigint") + c
    return key


def dense_key(df: DataFrame, order_cols: Sequence[str], key_name: str = "sk",
              start: int = 1, num_partitions: int | None = None) -> DataFrame:
    """Add ``key_name`` = 1..N in ``order_cols`` order (ties in arbitrary order).

    The ordered data is checkpointed (to the shared ``spark.checkpoint.dir``) so
    that partition ids and positions are fixed facts of stored data, not of a plan
    that could be recomputed differently after a lost executor.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c).asc_nulls_last() for c in order_cols]
    ordered = (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
               .withColumn("_pid", F.spark_partition_id())
               .withColumn("_pos", F.monotonically_increasing_id()))
    stored = ordered.checkpoint(eager=True)
    # _pos = (partition id << 33) + index within the partition
    local = F.col("_pos") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    counts = stored.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    keyed = stored.join(F.broadcast(offsets), "_pid")  # one row per partition
    return (keyed.withColumn(key_name, (F.col("_off") + local + F.lit(start)).cast("bigint"))
            .drop("_pid", "_pos", "_off"))
