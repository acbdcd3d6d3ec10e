"""Window-style operators, planned so that no step puts an unbounded set of rows
into one task.

* previous-period change: a window over an already aggregated series (one row
  per period, bounded by the calendar);
* rank / quartile / share of a top-k report: ranks of the first k rows are exact
  from the k rows themselves plus two global scalars (row count and grand total),
  so the whole input is never sorted in one partition;
* moving average / running sum: windows partitioned by entity (a handful of
  periods per entity);
* group mean beside each row: aggregate + join instead of a partition window
  (a group holding a third of the rows would otherwise be one task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stellata.functions.numbers import avg_half_up, ratio_half_up
from stellata.session import checkpoint_dir


def change_vs_previous(series: DataFrame, period: str, value: str, prefix: str = "") -> DataFrame:
    """LAG(value) over period: previous value, absolute change and % change
    rounded to 2 (NULL when the previous value is NULL or 0)."""
    w = Window.orderBy(period)
    prev = F.lag(value).over(w)
    return series.select(
        "*",
        prev.alias(f"{prefix}casos_ano_anterior"),
        (F.col(value) - prev).alias(f"{prefix}variacao_absoluta"),
        ratio_half_up((F.col(value) - prev) * 100, prev, 2).alias(f"{prefix}variacao_pct"))


def top_k_rank_quartile_share(totals: DataFrame, value: str, tiebreak: Sequence[str], k: int,
                              buckets: int = 4) -> DataFrame:
    """First ``k`` rows by ``value`` DESC (ties by ``tiebreak``) with
    RANK(), NTILE(buckets) and ROUND(value / SUM(value) OVER () * 100, 2).

    ``totals`` is scanned twice: once for (row count, grand total), once for the
    top-k (``TakeOrderedAndProject``: each task keeps only k rows)."""
    order = [F.col(value).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in tiebreak]
    top = totals.orderBy(*order).limit(k)
    scalars = totals.agg(F.count(F.lit(1)).alias("_n"),
                         F.sum(value).alias("_total"))
    w = Window.orderBy(*order)  # over k rows only
    ranked = (top.crossJoin(F.broadcast(scalars))  # one row
              .withColumn("ranking", F.rank().over(Window.orderBy(order[0])))
              .withColumn("_pos", F.row_number().over(w)))
    # NTILE over N rows: the first N % b buckets hold q+1 rows, the rest q rows.
    n, p = F.col("_n"), F.col("_pos")
    q, r = F.floor(n / buckets), F.pmod(n, F.lit(buckets))
    big = r * (q + 1)
    tile = F.when(p <= big, F.floor((p - 1) / (q + 1)) + 1).otherwise(
        r + F.floor((p - big - 1) / q) + 1)
    return (ranked.withColumn("quartil", tile.cast("int"))
            .withColumn("pct_do_total", ratio_half_up(F.col(value) * 100, F.col("_total"), 2))
            .drop("_n", "_total", "_pos"))


def moving_average_running_sum(df: DataFrame, entity: str, period: str, value: str) -> DataFrame:
    """Centred 3-period moving average (ROWS 1 PRECEDING..1 FOLLOWING, edge rows
    average 2 values) rounded to 2, and the running sum, per entity."""
    w = Window.partitionBy(entity).orderBy(period)
    centred = w.rowsBetween(-1, 1)
    s = F.sum(F.col(value).cast("bigint")).over(centred)
    c = F.count(F.col(value)).over(centred)
    return df.select(
        "*",
        ratio_half_up(s, c, 2).alias("media_movel_3anos"),
        F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("acumulado"))


def with_group_mean(df: DataFrame, group: Sequence[str], value: str, name: str,
                    in_scale: int = 0, means_of: DataFrame | None = None) -> DataFrame:
    """``ROUND(AVG(value) OVER (PARTITION BY group), 2)`` beside every row, computed
    as a group-by (partial aggregation) joined back on the group keys: a group
    holding a third of the rows is combined inside each task instead of being
    sorted in one. ``means_of``: a narrower table with the same rows of (group, value),
    when ``df`` carries joins that the means do not need."""
    means = (df if means_of is None else means_of).groupBy(*group).agg(avg_half_up(value, 2, in_scale).alias(name))
    return df.join(means, list(group), "left")


def rank_quartile_share_all(totals: DataFrame, value: str, tiebreak: Sequence[str], buckets: int = 4) -> DataFrame:
    """RANK(), NTILE(buckets) and the share of the total for every row, by ``value`` DESC (nulls
    last, ties in the order of ``tiebreak``), without a sort in one task.

    The rows are dealt by ranges of that order and stored once in the shared checkpoint
    folder. Each part numbers its own rows; what it adds to them, and where a run of equal
    values that began in an earlier part started, follows from one row per part."""
    spark = totals.sparkSession
    checkpoint_dir(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(value).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in tiebreak]
    placed = (totals.repartitionByRange(parts, *order).sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    inside = Window.partitionBy("_pid").orderBy("_at")
    place = (F.col("_at") - F.shiftleft(F.col("_pid").cast("bigint"), 33) + 1).alias("_place")
    local = placed.select("*", place, F.lag("_at").over(inside).isNull().alias("_first"),
                          F.lag(value).over(inside).alias("_before"))
    local = local.withColumn("_start", F.max(F.when(F.col("_first") | ~F.col(value).eqNullSafe(F.col("_before")),
                                                    F.col("_place"))).over(inside))
    per = local.groupBy("_pid").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_sum"),
        F.min_by(F.struct(value), "_at").alias("_head"), F.max_by(F.struct(value, "_start"), "_at").alias("_tail"))
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    whole = Window.partitionBy()
    per = per.withColumn("_off", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    follows = F.lag("_pid").over(Window.orderBy("_pid")).isNotNull() & F.col(f"_head.{value}").eqNullSafe(
        F.lag(f"_tail.{value}").over(Window.orderBy("_pid")))
    per = per.withColumn("_follows", follows)
    begun = F.when((F.col("_tail._start") > 1) | ~F.col("_follows"), F.col("_off") + F.col("_tail._start"))
    per = per.withColumn("_begun", begun).select(
        "_pid", "_off", "_follows", F.last("_begun", ignorenulls=True).over(earlier).alias("_carried"),
        F.sum("_n").over(whole).alias("_n"), F.sum("_sum").over(whole).alias("_total"))
    ranked = local.join(F.broadcast(per), "_pid")
    p, n = F.col("_off") + F.col("_place"), F.col("_n")
    q, r = F.floor(n / buckets), F.pmod(n, F.lit(buckets))
    big = r * (q + 1)
    # fewer rows than buckets leave q at 0; then every row lies below `big`
    tile = F.when(p <= big, F.floor((p - 1) / (q + 1)) + 1).otherwise(
        r + F.floor((p - big - 1) / F.greatest(q, F.lit(1))) + 1)
    rank = F.when((F.col("_start") == 1) & F.col("_follows"), F.col("_carried")).otherwise(F.col("_off") + F.col("_start"))
    return ranked.select(
        *[F.col(c) for c in totals.columns], rank.cast("bigint").alias("ranking"), tile.cast("int").alias("quartil"),
        ratio_half_up(F.col(value) * 100, F.col("_total"), 2).alias("pct_do_total"))
