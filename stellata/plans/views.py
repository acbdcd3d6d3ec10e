"""Views and the refreshed summary table.

``register_views`` exposes the star and the wide view to SQL; ``refresh_summary``
is the complete refresh of the materialized region × year summary: recompute and
commit a new version (Parquet tables have no MATERIALIZED VIEW), so readers see either
the old or the new one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stellata.plans import olap
from stellata.plans.star import Star

VIEW_NAME = "vw_municipio_tb"
SUMMARY_NAME = "mv_regiao_ano"


def register_views(spark: SparkSession, star: Star) -> None:
    for name, df in star.tables().items():
        df.createOrReplaceTempView(name)
    for name, df in star.extras.items():
        if isinstance(df, DataFrame):
            df.createOrReplaceTempView(name)
    olap.wide_view(star).createOrReplaceTempView(VIEW_NAME)


def refresh_summary(spark: SparkSession, star: Star, root: str) -> DataFrame:
    """Complete refresh of the summary: recompute it into a new committed version under
    ``root`` (readers of older versions are not disturbed); returns the stored result."""
    from stellata.plans.warehouse import build_stages

    version = build_stages(spark, root, [(SUMMARY_NAME, lambda d: olap.region_year_summary(star))])
    out = spark.read.parquet(f"{version}/{SUMMARY_NAME}")
    out.createOrReplaceTempView(SUMMARY_NAME)
    return out
