"""Plan checks: the physical plans keep the properties the design relies on at
scale (map-side combining before shuffles, co-located star joins, pruned scans,
a map-only weather reader, no single-partition sort of a whole input)."""

from __future__ import annotations

import contextlib
import io
import os
import re
import tempfile

import pytest

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@contextlib.contextmanager
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.fixture(scope="module")
def bench(spark):
    if not os.path.exists(f"{SF}/orders.parquet"):
        pytest.skip("benchmark tables not available")
    from stellata.plans.benchstar import NO_CLIMATE, bench_star
    return bench_star(spark, SF, NO_CLIMATE)


def test_aggregates_combine_before_the_shuffle(spark):
    from stellata.plans.benchstar import bench_daily, customer_year_orders, read_tables
    t = read_tables(spark, SF, ["orders", "lineitem"])
    for df in (customer_year_orders(t["orders"]), bench_daily(t["lineitem"])):
        p = plan_of(df).split("\n\n")[0]
        # bottom-up: partial HashAggregate, then the hash exchange, then the final one
        lines = [ln for ln in p.splitlines() if "HashAggregate" in ln or "Exchange" in ln]
        assert [("Exchange" in ln) for ln in lines] == [False, True, False], p


def test_star_joins_meet_where_they_are(spark, bench):
    """With broadcasting off, customers and orders are dealt once by the customer; the
    joins of a statement with its dimensions find their rows there."""
    from stellata.plans import olap
    with no_broadcast(spark):
        for statement in (olap.place_totals, olap.risk_and_income_bands, olap.cube_period_band):
            head = plan_of(statement(bench)).split("\n\n")[0]
            assert "SortMergeJoin" in head
            # exchanges on one key only, besides those of the report itself
            keys = set(re.findall(r"hashpartitioning\((\w+)", plan_of(statement(bench))))
            assert keys <= {"c_custkey", "sk_municipio", "o_custkey", "nm_municipio", "periodo"}, keys


def test_no_fact_rows_are_dealt_by_a_station(spark):
    from stellata.plans.benchstar import ALL_CLIMATE, bench_star
    from stellata.plans.star import remap_climate
    star = bench_star(spark, SF, ALL_CLIMATE)
    with no_broadcast(spark):
        p = plan_of(remap_climate(star.fato, star.municipio, star.extras["aux_regiao_estacao"], star.estacao,
                                  star.clima))
    fact_side = [blk for blk in p.split("\n\n") if "Exchange" in blk and re.search(
        r"hashpartitioning\((cd_estacao|sk_estacao|nm_regiao)", blk)]
    assert not any("casos_tb" in blk for blk in fact_side), fact_side


def test_statements_read_what_they_need(spark, bench):
    from stellata.plans import olap
    p = plan_of(olap.yearly_totals(bench))
    assert "lineitem.parquet" not in p and "supplier.parquet" not in p
    orders = [blk for blk in p.split("\n\n") if "orders.parquet" in blk and "ReadSchema" in blk][0]
    schema = re.search(r"ReadSchema: (.*)", orders).group(1)
    assert "o_totalprice" not in schema and "o_custkey" in schema


def test_weather_reader_is_map_only(spark, scratch):
    from weather_files import write_weather_folder

    from stellata.sources.weather import read_weather_hourly
    root = write_weather_folder(os.path.join(tempfile.mkdtemp(dir=scratch), "horarios"))
    p = plan_of(read_weather_hourly(spark, root)).split("\n\n")[0]
    assert "Exchange" not in p and "Generate" in p


def test_top_k_report_has_no_global_sort(spark, bench):
    from stellata.plans import olap
    p = plan_of(olap.rank_quartile_share(bench)).split("\n\n")[0]
    assert "TakeOrderedAndProject" in p
    # the only single-partition step works on the k rows after TakeOrderedAndProject
    singles = p.count("SinglePartition")
    assert singles <= 2, p
