"""Incremental refresh of the region x year summary from stored, mergeable states.

A state holds, per region, year and pandemic flag, the exact sum and count of every measure
and the municipalities as bitmaps (32,768 of them to a bitmap, so a group's states stay
small rows however many it has). Sums add up, bitmaps are or-ed: any coarser grouping
follows from the states without the fact, distinct municipalities included.

The states of a year are a folder. A refresh computes the years that changed from the fact
rows of these years only, writes them into a new version and commits a manifest that names
the version of every year; the years that did not change stay where they are.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellata.functions.numbers import ratio_half_up, units
from stellata.plans import olap
from stellata.plans.star import Star
from stellata.plans.warehouse import _hadoop, commit, new_version, versions

KEYS = ("regiao", "ano", "pandemia")
#: measure -> (its decimals, name of its mean in the summary)
MEASURES = {"casos_tb": (0, "media_casos"), "pib_per_capita": (2, "pib_medio"), "dens_demografica": (2, "dens_media"),
            "temp_med_anual": (2, "temp_media"), "umidade_med_anual": (2, "umidade_media"),
            "precipitacao_total": (2, "precipitacao_media")}
_MANIFEST = "anos.json"


def of_years(star: Star, years: Iterable[int]) -> Star:
    """The star with the fact and socio-economic rows of some years only; the filter is on
    their year keys, so a store partitioned or sorted by them reads those years."""
    tempo = star.tempo.where(F.col("ano").isin(*years))
    keys = [r[0] for r in tempo.select("sk_tempo").collect()]  # calendar years
    return replace(star, tempo=tempo, fato=star.fato.where(F.col("sk_tempo").isin(*keys)),
                   socio=star.socio.where(F.col("sk_tempo").isin(*keys)))


def states(star: Star) -> tuple[DataFrame, DataFrame]:
    """(sums and counts, bitmaps of municipalities) per region, year and pandemic flag."""
    f = olap.summary_rows(star).withColumn("regiao", F.coalesce("nm_regiao", F.lit(olap.NO_REGION)))
    sums = f.groupBy(*KEYS).agg(
        *[F.sum(units(F.col(c), scale)).alias(f"s_{c}") for c, (scale, _) in MEASURES.items()],
        *[F.count(c).alias(f"n_{c}") for c in MEASURES])
    place = F.col("sk_municipio")
    maps = f.groupBy(*KEYS, F.bitmap_bucket_number(place).alias("faixa")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("municipios"))
    return sums, maps


def manifest(spark: SparkSession, root: str) -> dict[int, str]:
    """year -> version folder that holds its states, as last committed."""
    found = versions(spark, root)
    if not found:
        return {}
    fs, path = _hadoop(spark, f"{found[-1]}/{_MANIFEST}")
    stream = fs.open(path)
    try:
        return {int(k): v for k, v in json.loads(bytes(stream.readAllBytes()).decode()).items()}
    finally:
        stream.close()


def refresh(star: Star, root: str, years: Iterable[int] | None = None) -> str:
    """Recompute the states of ``years`` (all of the calendar when None) into a new version and
    commit it; returns the version. A year that lost all its rows loses its states."""
    spark = star.fato.sparkSession
    calendar = {r[0] for r in star.tempo.select("ano").collect()}
    chosen = sorted(calendar if years is None else set(years))
    kept = {} if years is None else {y: v for y, v in manifest(spark, root).items() if y not in chosen}
    version = new_version(root)
    sums, maps = states(star if years is None else of_years(star, chosen))
    sums.write.partitionBy("ano").parquet(f"{version}/somas")
    maps.write.partitionBy("ano").parquet(f"{version}/mapas")
    there = {y for y in chosen if _hadoop(spark, version)[0].exists(_hadoop(spark, f"{version}/somas/ano={y}")[1])}
    fs, path = _hadoop(spark, f"{version}/{_MANIFEST}")
    out = fs.create(path, False)
    out.write(bytearray(json.dumps({**kept, **{y: version for y in there}}).encode()))
    out.close()
    commit(spark, version)
    return version


def _read(spark: SparkSession, root: str, kind: str) -> DataFrame:
    by_version: dict[str, list[int]] = {}
    for year, version in sorted(manifest(spark, root).items()):
        by_version.setdefault(version, []).append(year)
    if not by_version:
        raise FileNotFoundError(f"no states under {root}")
    parts = [spark.read.option("basePath", f"{v}/{kind}").parquet(*[f"{v}/{kind}/ano={y}" for y in ys])
             for v, ys in by_version.items()]
    return reduce(DataFrame.unionByName, parts)


def summary(spark: SparkSession, root: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """The summary by ``keys`` (some of region, year, pandemic flag) from the stored states:
    number of distinct municipalities, total of cases and the exact means."""
    sums, maps = _read(spark, root, "somas"), _read(spark, root, "mapas")
    whole = sums.groupBy(*keys).agg(*[F.sum(f"{p}_{c}").alias(f"{p}_{c}") for c in MEASURES for p in ("s", "n")])
    places = (maps.groupBy(*keys, "faixa").agg(F.bitmap_or_agg("municipios").alias("m"))
              .groupBy(*keys).agg(F.sum(F.bitmap_count("m")).alias("qtd_municipios")))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    both = whole.alias("a").join(places.alias("b"), reduce(lambda x, y: x & y, same)) if keys else whole.crossJoin(places)
    return both.select(
        *[F.col(f"a.{k}") for k in keys], "qtd_municipios", F.col("s_casos_tb").alias("total_casos"),
        *[ratio_half_up(F.col(f"s_{c}"), F.col(f"n_{c}") * 10 ** scale, 2).alias(name)
          for c, (scale, name) in MEASURES.items()])
