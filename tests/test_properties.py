"""Property tests: column expressions against plain-Python models of the same
rules, and invariants of the analytic statements on the benchmark star."""

from __future__ import annotations

import datetime as dt
import math
import os
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stellata.functions import parse_mixed_date, ratio_half_up, tolerant_float

SETTINGS = settings(max_examples=40, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def model_reading(text):
    """The reading rule in plain Python: strip, comma -> point, the missing
    texts, unparsable, NaN/Infinity and any -9999 are None."""
    if text is None:
        return None
    s = text.strip().replace(",", ".")
    if s in ("", "-9999", "-9999.0", "null", "NULL", "-"):
        return None
    try:
        v = float(s)
    except ValueError:
        return None
    if math.isnan(v) or math.isinf(v) or v == -9999.0:
        return None
    return v


readings = st.one_of(
    st.none(),
    st.sampled_from(["", " ", "-9999", "-9999,0", "-9999.00", "null", "NULL", "-", "abc", "NaN",
                     "1,5", " 20.25 ", "0", "-3", "1e3", "12,", ",5"]),
    st.decimals(min_value=-100, max_value=2000, places=2, allow_nan=False)
    .map(lambda d: str(d).replace(".", ",") if d % 2 else str(d)),
)


@SETTINGS
@given(st.lists(readings, min_size=1, max_size=30))
def test_tolerant_float_matches_model(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r[0] for r in df.select(tolerant_float("x")).collect()]
    assert got == [model_reading(t) for t in texts]


def model_date(text):
    s = (text or "").strip()
    for fmt in ("%Y-%m-%d", "%Y/%m/%d", "%d/%m/%Y"):
        try:
            d = dt.datetime.strptime(s, fmt).date()
        except ValueError:
            continue
        # strptime accepts 1-digit fields; the Spark patterns want 2 (4 for years)
        if len(s) == 10:
            return d
    return None


dates = st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2030, 12, 31))


@SETTINGS
@given(st.lists(st.tuples(dates, st.sampled_from(["%Y-%m-%d", "%Y/%m/%d", "%d/%m/%Y", "bad"])),
                min_size=1, max_size=30))
def test_mixed_dates_match_model(spark, items):
    texts = [d.strftime(f) if f != "bad" else d.strftime("%d.%m.%Y") for d, f in items]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r[0] for r in df.select(parse_mixed_date("x")).collect()]
    assert got == [model_date(t) for t in texts]


@SETTINGS
@given(st.lists(st.tuples(st.integers(-10 ** 15, 10 ** 15), st.integers(-10 ** 6, 10 ** 6)),
                min_size=1, max_size=30),
       st.integers(0, 4))
def test_ratio_half_up_matches_decimal(spark, pairs, scale):
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    got = [r[0] for r in df.select(ratio_half_up("n", "d", scale)).collect()]
    q = Decimal(1).scaleb(-scale)
    want = [None if d == 0 else (Decimal(n) / Decimal(d)).quantize(q, rounding=ROUND_HALF_UP)
            for n, d in pairs]
    assert got == want


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bench(spark):
    if not os.path.exists(f"{SF}/orders.parquet"):
        pytest.skip("benchmark tables not available")
    from stellata.plans.benchstar import bench_star
    return bench_star(spark, SF)


def test_star_invariants_on_benchmark(bench):
    from stellata.operators import quality
    from stellata.plans import olap
    star = bench
    total = star.fato.agg(F.sum("casos_tb")).first()[0]
    # one fact row per (place, year); keys resolve
    assert quality.duplicate_keys(star.fato, ["sk_municipio", "sk_tempo"]).count() == 0
    assert quality.orphans(star.fato, ["sk_municipio"], star.municipio, ["sk_municipio"]).count() == 0
    assert quality.orphans(star.fato, ["sk_clima"], star.clima, ["sk_clima"]).count() == 0
    # ROLLUP: grand total = sum of leaves = sum of region subtotals; NULL region kept apart
    rows = olap.rollup_region_year(star).collect()
    grand = [r for r in rows if r["grp_regiao"] == 1]
    leaves = [r for r in rows if r["grp_regiao"] == 0 and r["grp_ano"] == 0]
    subs = [r for r in rows if r["grp_regiao"] == 0 and r["grp_ano"] == 1]
    assert grand[0]["total_casos"] == total == sum(r["total_casos"] for r in leaves) \
        == sum(r["total_casos"] for r in subs)
    assert sum(1 for r in subs if r["regiao"] == "TOTAL GERAL") == 1  # the NULL-region group
    # CUBE: both margins add up to the grand total
    cube = {(r["periodo_pandemia"], r["faixa_pib"]): r["total_casos"]
            for r in olap.cube_period_band(star).collect()}
    assert cube[("TODOS", "TODAS")] == total
    assert sum(v for (p, b), v in cube.items() if p == "TODOS" and b != "TODAS") == total
    assert sum(v for (p, b), v in cube.items() if p != "TODOS" and b == "TODAS") == total
    # GROUPING SETS: the year set and the region set each add up to the total
    gs = olap.grouping_sets_year_region(star).collect()
    assert sum(r["total_casos"] for r in gs if r["grp_ano"] == 0) == total
    assert sum(r["total_casos"] for r in gs if r["grp_regiao"] == 0) == total
    # year over year: absolute change chains back to the first year
    yoy = olap.year_over_year(star).collect()
    for a, b in zip(yoy, yoy[1:]):
        assert b["variacao_absoluta"] == b["total_casos"] - a["total_casos"]
    # summary table: per-region totals equal the period split
    ratio = olap.period_ratio(olap.region_year_summary(star)).collect()
    assert all(r["casos_pandemia"] + r["casos_fora_pandemia"] == r["total_geral"] for r in ratio)
    assert sum(r["total_geral"] for r in ratio) == total
