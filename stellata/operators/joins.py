"""Join operators: nearest-row lookup, update-as-join, semi-join to a top-k.

Broadcast policy: a side is hinted for broadcast only when its size has a proven
bound (calendar years, a literal mapping, one row per partition, a top-k result).
Sides that grow with the data are joined plainly; adaptive execution measures
them at run time and broadcasts only those under
``spark.sql.adaptive.autoBroadcastJoinThreshold``, otherwise it keeps the shuffle
join and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nearest_lookup(df: DataFrame, group_cols: Sequence[str], value: str | Column,
                   target: float, pick: Sequence[str], tiebreak: Sequence[str]) -> DataFrame:
    """Per group, the row whose ``value`` is nearest to ``target``
    (``ORDER BY ABS(value - target) … FETCH FIRST 1 ROW``), NULL values last and
    ties broken by ``tiebreak``. Without groups it returns one row overall.

    Uses ``min_by`` (a partial aggregate: each task keeps one candidate per group),
    never a sort of the whole input."""
    v = F.col(value) if isinstance(value, str) else value
    dist = F.abs(v - F.lit(target))
    order = F.struct(dist.isNull().alias("_null"), dist.alias("_d"),
                     *[F.col(c).alias(f"_t{i}") for i, c in enumerate(tiebreak)])
    best = F.min_by(F.struct(*[F.col(c) for c in pick]), order).alias("_best")
    agg = df.groupBy(*group_cols).agg(best) if group_cols else df.agg(best)
    return agg.select(*group_cols, "_best.*")


def update_where_exists(target: DataFrame, values: DataFrame, value_keys: Sequence[str],
                        column: str, guard: DataFrame, guard_keys: Sequence[str]) -> DataFrame:
    """``UPDATE target SET column = (SELECT value … WHERE value_keys match)
    WHERE EXISTS (SELECT 1 FROM guard WHERE guard_keys match)`` as a join.

    ``values`` has ``value_keys`` + ``column``, one row per key: a second one fails the
    query, as a scalar subquery with two rows does. A guarded row with no value becomes
    NULL, an unguarded row keeps its old value. Returns a new version of ``target``
    (tables are rewritten, not updated in place)."""
    once = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("two values for one key"))).otherwise(
        F.max(column))
    vals = values.groupBy(*value_keys).agg(once.alias("_new"))
    flag = guard.select(*guard_keys).distinct().withColumn("_guarded", F.lit(True))
    out = target.join(vals, list(value_keys), "left").join(flag, list(guard_keys), "left")
    return (out.withColumn(column, F.when(F.col("_guarded"), F.col("_new")).otherwise(F.col(column)))
            .drop("_new", "_guarded").select(*target.columns))


def semi_join_top(df: DataFrame, top: DataFrame, on: Sequence[str]) -> DataFrame:
    """``WHERE key IN (top-k subquery)``; the top-k side is bounded by k."""
    return df.join(F.broadcast(top.select(*on)), list(on), "left_semi")
