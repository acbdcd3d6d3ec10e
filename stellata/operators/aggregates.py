"""Aggregation operators: hourly -> daily -> yearly weather, row counts, load counts.

All are hash aggregates with a partial (map-side) step, so a hot key is combined
inside each task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellata.functions.numbers import avg_half_up, sum_exact

#: Readings below the bound that have at most four fractional digits are summed as whole
#: numbers of their last digit; 9e9 of them fit into a long.
_UNIT, _BOUND = 10_000, 1e5


def _sum_of_readings(df: DataFrame, name: str) -> Column:
    """Sum of a column as decimal(38,18), each reading as the decimal that it is written as."""
    x = F.col(name)
    if not isinstance(df.schema[name].dataType, T.DoubleType):
        return F.sum(x.cast("decimal(38,18)"))
    units = F.rint(x * _UNIT)
    short = (F.abs(x) < _BOUND) & (units / float(_UNIT) == x)
    whole = F.sum(F.when(short, units.cast("bigint"))).cast("decimal(20,0)") * F.lit(Decimal(1) / _UNIT)
    rest = F.sum(F.when(~short, x.cast("decimal(38,18)")))
    # the sum of two decimals of 37 digits keeps all 18 fractional ones
    both = F.coalesce(whole.cast("decimal(37,18)") + rest.try_cast("decimal(37,18)"),
                      (whole + rest).cast("decimal(38,18)"))
    return F.when(rest.isNull(), whole.cast("decimal(38,18)")).when(whole.isNull(), rest).otherwise(both)


def hourly_to_daily(hourly: DataFrame, station: str = "codigo_estacao", day: str = "data",
                    first_seen: Sequence[str] = ("ano", "nome_estacao", "latitude", "longitude", "altitude"),
                    seen_order: Sequence[str] = ("ano", "arquivo", "linha")) -> DataFrame:
    """Per (station, day text): max of maxima, min of minima, mean of air
    temperature and humidity and total rain (mean/sum rounded to 2). NULL readings
    are ignored; an all-NULL measure is NULL. Station metadata comes from the
    first reading seen in (year, file, line) order — deterministic, unlike
    ``first()``. Readings are summed as decimals with 18 fractional digits, more than a
    double of this size holds, so sums do not depend on the order of the rows; the mean
    is divided to 18 digits and rounded half-up to 2 (the source rounds binary
    floats half-even, which differs only on exact ties)."""
    total = lambda c: _sum_of_readings(hourly, c)
    # the least of one struct: what orders the readings stands first
    meta = F.min(F.struct(*seen_order, *[c for c in first_seen if c not in seen_order])).alias("_m")
    daily = hourly.groupBy(station, day).agg(
        meta,
        F.max("temp_max_c").alias("temp_max_c"),
        F.min("temp_min_c").alias("temp_min_c"),
        F.round(total("temp_med_c") / F.count("temp_med_c"), 2).alias("temp_med_c"),
        F.round(total("umidade_pct") / F.count("umidade_pct"), 2).alias("umidade_med_pct"),
        F.round(total("precipitacao_mm"), 2).alias("precipitacao_mm"))
    return daily.select(
        F.col("_m.ano").alias("ano"), station, "_m.nome_estacao", "_m.latitude", "_m.longitude",
        "_m.altitude", day, "temp_max_c", "temp_min_c", "temp_med_c", "umidade_med_pct",
        "precipitacao_mm")


def yearly_summary(daily: DataFrame, keys: Sequence[str], t_max: str, t_min: str, t_med: str,
                   humidity: str, rain: str, in_scale: int = 2) -> DataFrame:
    """Daily -> yearly: MAX, MIN, ROUND(AVG,2) ×2, ROUND(SUM(NVL(rain,0)),2) (an
    all-NULL year sums to 0, not NULL) and the count of days with rain > 0."""
    return daily.groupBy(*keys).agg(
        F.max(t_max).alias("temp_max_anual"),
        F.min(t_min).alias("temp_min_anual"),
        avg_half_up(t_med, 2, in_scale).alias("temp_med_anual"),
        avg_half_up(humidity, 2, in_scale).alias("umidade_med_anual"),
        F.round(F.coalesce(sum_exact(rain, in_scale), F.lit(0).cast(f"decimal(38,{in_scale})")), 2)
        .alias("precipitacao_total"),
        F.count(F.when(F.col(rain) > 0, F.lit(1))).alias("dias_chuva"))


def rows_per_group(df: DataFrame, key: str, label: str, names: DataFrame | None = None) -> DataFrame:
    """Rows per station and a name for it (the smallest, so the result is stable).

    With ``names`` (key, label) the rows are counted first and the names joined
    to the counts, so the big side is never shuffled for the join."""
    if names is None:
        return df.groupBy(key).agg(F.count(F.lit(1)).alias("linhas"), F.min(label).alias(label))
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("linhas"))
    named = names.groupBy(key).agg(F.min(label).alias(label))
    return counts.join(named, key, "left")


def observed_counts(df: DataFrame, name: str = "load", **conditions) -> tuple[DataFrame, Observation]:
    """Attach row counters computed during the one pass that writes ``df``
    (``df.observe``). ``conditions`` map a counter name to a boolean Column.
    Read ``observation.get`` after the action."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count(F.when(c, F.lit(1))).alias(k) for k, c in conditions.items()]
    return df.observe(obs, *metrics), obs
