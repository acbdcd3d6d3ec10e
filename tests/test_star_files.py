"""End to end on synthetic files of the real ones' shape: goldens in plain Python."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile
import threading
from collections import Counter

import pytest
from conftest import FOLD, YEARS, synthetic_places

from stellata.functions.text import ACCENTED, COMPAT_PLAIN
from stellata.plans import olap
from stellata.plans.star import REGION_STATION, cases_long, dim_municipio

STATION_OF = dict(REGION_STATION)
COMPAT = str.maketrans(ACCENTED, COMPAT_PLAIN[:len(ACCENTED)])


def matched(mode):
    """Places with a region found by name, as the given accent map finds it."""
    fold = (lambda n: n.translate(FOLD).upper()) if mode == "correct" else (lambda n: n.translate(COMPAT).upper())
    regions = {fold(name): region for _, name, region, _ in synthetic_places() if region}
    return [(code, name.translate(FOLD).upper(), regions.get(fold(name.translate(FOLD).upper())), counts)
            for code, name, _, counts in synthetic_places()]


def in_fact(mode):
    return [p for p in matched(mode) if p[2] in STATION_OF]


def test_cases(star_inputs):
    long = cases_long(star_inputs["cases"]).collect()
    want = Counter()
    for code, _, _, counts in synthetic_places():
        for y, n in zip(YEARS, counts):
            want[code, y] = n
    assert {(r["cd_ibge"], r["ano"]): r["casos_tb"] for r in long} == dict(want)


@pytest.mark.parametrize("mode", ["correct", "compat"])
def test_regions_by_name(star_inputs, mode):
    dim = dim_municipio(star_inputs["cases"], star_inputs["density"], mode).collect()
    assert sorted((r["cd_ibge"], r["nm_municipio"], str(r["nm_regiao"])) for r in dim) == \
        sorted((c, n, str(r)) for c, n, r, _ in matched(mode))
    assert len(in_fact("compat")) < len(in_fact("correct"))  # the shifted map loses names


@pytest.mark.parametrize("mode", ["correct", "compat"])
def test_statements(request, mode):
    star = request.getfixturevalue("synthetic_" + mode)
    places = in_fact(mode)
    assert star.fato.count() == 6 * len(places)
    per_year = {y: (sum(p[3][i] for p in places), sum(p[3][i] > 0 for p in places)) for i, y in enumerate(YEARS)}
    assert {r["ano"]: (r["total_casos"], r["municipios_com_casos"]) for r in olap.yearly_totals(star).collect()} == per_year
    totals = sorted(((-sum(p[3]), p[1], p[2]) for p in places))[:10]
    assert [(-r["total_casos"], r["nm_municipio"], r["nm_regiao"]) for r in olap.top_places(star).collect()] == totals
    ratio = {r["regiao"]: (r["casos_pandemia"], r["total_geral"])
             for r in olap.period_ratio(olap.region_year_summary(star)).collect()}
    want = {}
    for _, _, region, counts in places:
        a, b = want.get(region, (0, 0))
        want[region] = (a + sum(counts[2:5]), b + sum(counts))
    assert ratio == want
    lean = olap.period_ratio(olap.region_year_cases(star)).collect()
    assert {r["regiao"]: (r["casos_pandemia"], r["total_geral"]) for r in lean} == want
    region = REGION_STATION[15][0]
    rows = olap.with_region_mean(star, region).collect()
    inside = [p for p in places if p[2] == region]
    for r in rows:
        i = r["ano"] - 2018
        assert float(r["media_regiao"]) == pytest.approx(sum(p[3][i] for p in inside) / len(inside), abs=0.005)
    assert len(rows) == 6 * len(inside)


@pytest.fixture(scope="module")
def synthetic_correct(spark, star_inputs):
    return _star(spark, star_inputs, "correct")


@pytest.fixture(scope="module")
def synthetic_compat(spark, star_inputs):
    return _star(spark, star_inputs, "compat")


def _star(spark, i, mode):
    from stellata.plans.star import build_star
    return build_star(spark, i["cases"], i["density"], i["stations"], i["daily"], i["gdp"], mode=mode)


# --- the stored warehouse -----------------------------------------------------------------

def test_warehouse_versions(spark, star_inputs, scratch):
    from stellata.plans import warehouse as w
    root = os.path.join(tempfile.mkdtemp(dir=scratch), "dw")
    with pytest.raises(FileNotFoundError):
        w.load_star(spark, root)
    first = w.load_warehouse(spark, out_root=root, **star_inputs["paths"])
    assert first.fato.count() == 6 * len(in_fact("correct"))
    # a load that died: written, not committed
    first.fato.write.parquet(f"{w.new_version(root)}/fato_tuberculose")
    assert len(w.versions(spark, root)) == 1
    with pytest.raises(Exception, match="already exists"):
        w.commit(spark, w.versions(spark, root)[0])
    # two loads at once: both commit, the newest is read
    threads = [threading.Thread(target=w.load_warehouse, args=(spark,), kwargs={
        "out_root": root, "mode": m, **star_inputs["paths"]}) for m in ("compat", "compat")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(w.versions(spark, root)) == 3
    assert w.load_star(spark, root).fato.count() == 6 * len(in_fact("compat"))
    assert first.fato.count() == 6 * len(in_fact("correct"))  # older readers are not disturbed
    assert len(w.drop_old_versions(spark, root, keep=1)) == 2 and len(w.versions(spark, root)) == 1
    # a new input is seen by the next load
    rejects = w.load_star(spark, root, ("rejeitos",)).extras["rejeitos"].collect()
    assert ("pib", "Município Sem Número") in {(r["carga"], r["chave"]) for r in rejects}


def test_rejects_of_every_loader(spark, scratch):
    from stellata.plans import warehouse as w
    from stellata.sources import tables as tb
    folder = tempfile.mkdtemp(dir=scratch)
    with open(f"{folder}/d.csv", "w", encoding="utf-8") as f:
        f.write(",".join(tb.DAILY_WEATHER_COLUMNS) + "\n")
        f.write("2018,A1,x,-24.1,-51,600,2018-01-01,1.5,1.5,1.5,50,0\n")
        f.write("2018,A1,NA,NaN,null,N/A,2018-01-02,nan,,NULL,NA,None\n")  # missing, not bad
        f.write("2018,A1,x,-24.1,-51,600,31/02/2018,1.5,1.5,\"1,5\",50,123456789\n")
    got = w.daily_weather_rejects(tb.daily_weather_text(spark, f"{folder}/d.csv")).collect()
    assert [(r["chave"], r["falhas"]) for r in got] == [("A1 31/02/2018", ["data", "temp_med_c", "precipitacao_mm"])]
    rows = tb.read_daily_weather(spark, f"{folder}/d.csv").orderBy("data_medicao").collect()
    assert all(rows[-1][c] is None for c in tb.DAILY_WEATHER_TYPES) and rows[-1]["nome_estacao"] is None
    with open(f"{folder}/raw.csv", "w", encoding="utf-16") as f:
        f.write("Titulo\nMunicípio/Estado\tRegião" + "".join(f"\t{y}" for y in YEARS) + "\n"
                "Bom\tr" + "\t1.234,56" * 6 + "\nRuim\tr\tn/d" + "\t1,0" * 5 + "\n")
    text = tb.density_raw_text(spark, f"{folder}/raw.csv")
    assert [(r["chave"], r["falhas"]) for r in w.raw_density_rejects(text).collect()] == [("Ruim", ["dens_2018"])]
    stations = spark.createDataFrame([("A1", None, "PR", None, None, "24S", "-51", "1e9")], ", ".join(
        f"{c} string" for c in tb.STATION_FIELDS))
    assert [r["falhas"] for r in w.station_rejects(stations).collect()] == [["VL_LATITUDE", "VL_ALTITUDE"]]


# --- statements that run at once ----------------------------------------------------------

SF = "/root/testdata/sf0.001"
TOGETHER = ("yearly_totals", "top10_places", "wide_view", "json_rows")


def test_queries_from_two_threads(spark):
    import __spark_entry__ as entry
    queries = entry.queries()
    alone = {n: sorted(map(str, queries[n](spark, SF).collect())) for n in TOGETHER}
    found, errors = {}, []

    def run(k):
        try:
            for n in TOGETHER:
                found[k, n] = sorted(map(str, queries[n](spark, SF).collect()))
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=run, args=(k,)) for k in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and all(found[k, n] == alone[n] for k, n in found) and len(found) == 2 * len(TOGETHER)


def test_queries_from_two_processes(scratch):
    """Two applications that start at once share nothing that one could take from the other."""
    code = ("import __spark_entry__ as e\nfrom stellata.session import get_spark\n"
            "s = get_spark('local[2]', shuffle_partitions=2)\n"
            f"print('ROWS', [e.queries()[n](s, '{SF}').count() for n in {TOGETHER}])")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    running = [subprocess.Popen([sys.executable, "-c", code], cwd=tempfile.mkdtemp(dir=scratch), text=True,
                                env=os.environ | {"PYTHONPATH": root}, stdout=subprocess.PIPE,
                                stderr=subprocess.DEVNULL) for _ in range(2)]
    said = [p.communicate(timeout=300)[0] for p in running]
    rows = [s[s.index("ROWS"):].strip() for s in said]
    assert rows[0] == rows[1]
