"""End to end on the two real files (+ synthetic station/weather/GDP inputs),
against the goldens counted from the files (FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stellata.plans import olap
from stellata.plans.star import cases_long, dim_municipio


def test_cases_read_and_total_line(spark, real_star_inputs):
    cases = real_star_inputs["cases"]
    assert cases.count() == 384
    long = cases_long(cases)
    per_year = {r["ano"]: r["s"] for r in long.groupBy("ano").agg(F.sum("casos_tb").alias("s")).collect()}
    # the file's own total line
    assert per_year == {2018: 2727, 2019: 2656, 2020: 2621, 2021: 2489, 2022: 2797, 2023: 2938}
    assert sum(per_year.values()) == 16228


def test_dim_municipio_region_match(real_star_inputs):
    i = real_star_inputs
    correct = dim_municipio(i["cases"], i["density"], "correct")
    compat = dim_municipio(i["cases"], i["density"], "compat")
    assert correct.count() == 384 and compat.count() == 384
    assert correct.where(F.col("nm_regiao").isNotNull()).count() == 384
    assert compat.where(F.col("nm_regiao").isNotNull()).count() == 285


def test_fact_rows_and_total(star_correct, star_compat):
    assert star_correct.fato.count() == 2304
    assert star_correct.fato.agg(F.sum("casos_tb")).first()[0] == 16228
    assert star_compat.fato.count() == 1710
    assert star_compat.fato.agg(F.sum("casos_tb")).first()[0] == 13327


def test_query1_goldens(star_correct, star_compat):
    got = {r["ano"]: (r["total_casos"], r["municipios_com_casos"])
           for r in olap.yearly_totals(star_correct).collect()}
    assert got == {2018: (2727, 264), 2019: (2656, 269), 2020: (2621, 261), 2021: (2489, 268),
                   2022: (2797, 258), 2023: (2938, 281)}
    got = {r["ano"]: (r["total_casos"], r["municipios_com_casos"])
           for r in olap.yearly_totals(star_compat).collect()}
    assert got == {2018: (2240, 201), 2019: (2112, 205), 2020: (2173, 201), 2021: (2073, 204),
                   2022: (2313, 194), 2023: (2416, 209)}
    flags = {r["ano"]: r["pandemia"] for r in olap.yearly_totals(star_correct).collect()}
    assert [flags[y] for y in range(2018, 2024)] == ["N", "N", "S", "S", "S", "N"]


def test_query2_top10(star_correct, star_compat):
    rows = [(r["nm_municipio"], r["total_casos"]) for r in olap.top_places(star_correct).collect()]
    assert rows == [("CURITIBA", 2525), ("LONDRINA", 1275), ("FOZ DO IGUACU", 794),
                    ("PARANAGUA", 701), ("PONTA GROSSA", 684), ("MARINGA", 475),
                    ("CASCAVEL", 460), ("SAO JOSE DOS PINHAIS", 407), ("COLOMBO", 373),
                    ("PIRAQUARA", 309)]
    rows = [(r["nm_municipio"], r["total_casos"]) for r in olap.top_places(star_compat).collect()]
    assert rows == [("CURITIBA", 2525), ("LONDRINA", 1275), ("PARANAGUA", 701),
                    ("PONTA GROSSA", 684), ("MARINGA", 475), ("CASCAVEL", 460),
                    ("COLOMBO", 373), ("PIRAQUARA", 309), ("PINHAIS", 233), ("ARAPONGAS", 206)]


def test_query3_bands(star_correct, star_compat):
    for star, want in ((star_correct, (129, 157, 98, 0)), (star_compat, (90, 117, 78, 0))):
        bands = {r["categoria_risco"]: r["n"] for r in
                 olap.risk_and_income_bands(star).groupBy("categoria_risco").agg(F.count("*").alias("n")).collect()}
        got = (bands.get("Baixo (1-5)", 0), bands.get("Moderado (6-20)", 0),
               bands.get("Alto (>20)", 0), bands.get("Sem casos", 0))
        assert got == want


def test_query4_change(star_correct):
    pct = [r["variacao_pct"] for r in olap.year_over_year(star_correct).collect()]
    assert pct[0] is None
    assert [float(x) for x in pct[1:]] == [-2.60, -1.32, -5.04, 12.37, 5.04]


def test_region_totals_tie(star_correct):
    s = olap.region_year_summary(star_correct)
    totals = dict(olap.period_ratio(s).select("regiao", "total_geral").collect())
    assert totals["RGI de Curitiba"] == 4881
    assert totals["RGI de Londrina"] == 2159
    assert totals["RGI de Paranaguá"] == 1200
    assert totals["RGI de Ponta Grossa"] == 978 and totals["RGI de Maringá"] == 978
    assert totals["RGI de Foz do Iguaçu"] == 927


def test_query5_rank_quartile_share(star_correct):
    rows = olap.rank_quartile_share(star_correct).collect()
    assert len(rows) == 20
    top = rows[0]
    assert (top["nm_municipio"], top["ranking"], top["quartil"]) == ("CURITIBA", 1, 1)
    assert str(top["pct_do_total"]) == "15.56"  # 2525 / 16228


def test_query6_moving_average(star_correct):
    rows = olap.moving_avg_running_sum(star_correct).collect()
    names = sorted({r["nm_municipio"] for r in rows})
    assert names == ["CURITIBA", "FOZ DO IGUACU", "LONDRINA", "PARANAGUA", "PONTA GROSSA"]
    assert len(rows) == 30
    last = {r["nm_municipio"]: r["acumulado"] for r in rows if r["ano"] == 2023}
    assert last["CURITIBA"] == 2525 and last["LONDRINA"] == 1275


def test_query7_rollup(star_correct):
    rows = olap.rollup_region_year(star_correct).collect()
    grand = [r for r in rows if r["grp_regiao"] == 1]
    assert len(grand) == 1 and grand[0]["total_casos"] == 16228
    assert (grand[0]["regiao"], grand[0]["ano"]) == ("TOTAL GERAL", "TODOS OS ANOS")
    leaves = [r for r in rows if r["grp_regiao"] == 0 and r["grp_ano"] == 0]
    assert sum(r["total_casos"] for r in leaves) == 16228 and len(leaves) == 29 * 6
    sub = {r["regiao"]: r["total_casos"] for r in rows if r["grp_regiao"] == 0 and r["grp_ano"] == 1}
    assert sub["RGI de Curitiba"] == 4881
    assert rows[-1]["grp_regiao"] == 1  # ordered: grand total last


def test_query8_cube(star_correct):
    rows = {(r["periodo_pandemia"], r["faixa_pib"]): r for r in olap.cube_period_band(star_correct).collect()}
    assert rows[("TODOS", "TODAS")]["total_casos"] == 16228
    assert rows[("TODOS", "TODAS")]["municipios"] == 384
    assert rows[("Pandemia (2020-2022)", "TODAS")]["total_casos"] == 2621 + 2489 + 2797
    assert rows[("Pre/Pos-Pandemia", "TODAS")]["total_casos"] == 2727 + 2656 + 2938
    bands = sum(r["total_casos"] for (p, b), r in rows.items() if p == "TODOS" and b != "TODAS")
    assert bands == 16228


def test_query9_grouping_sets(star_correct):
    rows = olap.grouping_sets_year_region(star_correct).collect()
    years = [r for r in rows if r["grp_ano"] == 0]
    regions = [r for r in rows if r["grp_regiao"] == 0]
    assert len(years) == 6 and len(regions) == 29 and len(rows) == 35
    assert sum(r["total_casos"] for r in years) == sum(r["total_casos"] for r in regions) == 16228
    assert all(r["regiao"] == "---" for r in years)


def test_views_summary_and_view_queries(spark, star_correct, scratch):
    import os
    import tempfile

    from stellata.plans.views import SUMMARY_NAME, VIEW_NAME, refresh_summary, register_views
    register_views(spark, star_correct)
    wide = spark.table(VIEW_NAME)
    assert wide.count() == 2304 and len(wide.columns) == 16
    n = spark.sql("SELECT count(*) FROM fato_tuberculose f JOIN dim_tempo t USING (sk_tempo)").first()[0]
    assert n == 2304
    path = os.path.join(tempfile.mkdtemp(dir=scratch), SUMMARY_NAME)
    mv = refresh_summary(spark, star_correct, path)
    assert mv.count() == 29 * 6
    mv = refresh_summary(spark, star_correct, path)  # a second refresh replaces, not appends
    assert mv.count() == 29 * 6
    ratio = {r["regiao"]: r for r in olap.period_ratio(spark.table(SUMMARY_NAME)).collect()}
    assert ratio["RGI de Curitiba"]["total_geral"] == 4881
    lon = olap.with_region_mean(star_correct).collect()
    assert len(lon) % 6 == 0 and lon
    above = olap.above_region_mean(star_correct).collect()
    assert 0 < len(above) < len(lon)
    assert all(r["casos_tb"] > r["media_regiao"] for r in above)


def test_query12_xml_and_query13_json(star_correct):
    doc = olap.xml_report(star_correct).first()[0]
    assert doc.startswith('<relatorio_tb titulo="Tuberculose Parana 2018-2023"><municipio>'
                          "<nome>CURITIBA</nome><regiao>RGI de Curitiba</regiao>"
                          "<total_casos>2525</total_casos><pib_medio>")
    assert doc.count("<municipio>") == 10 and doc.endswith("</municipio></relatorio_tb>")
    rows = [r[0] for r in olap.json_rows(star_correct).collect()]
    assert len(rows) == 6
    assert rows[0].startswith('{"ano":2018,"pandemia":"N","total_casos":2727,"municipios_afetados":264,')


def test_remap_and_nearest_and_quality(spark, star_correct):
    from stellata.operators import quality
    from stellata.plans.star import nearest_climate, region_station_map, remap_climate
    s = star_correct
    near = nearest_climate(s.clima, s.estacao).collect()
    assert len(near) == 6
    v1 = s.fato.drop("sk_clima").join(
        spark.createDataFrame([(r["sk_tempo"], r["sk_clima"]) for r in near], "sk_tempo bigint, sk_clima bigint"),
        "sk_tempo", "left")
    v2 = remap_climate(v1, s.municipio, region_station_map(spark), s.estacao, s.clima)
    assert sorted(map(tuple, v2.select("sk_fat", "sk_clima").collect())) == \
        sorted(map(tuple, s.fato.select("sk_fat", "sk_clima").collect()))
    assert quality.duplicate_keys(s.fato, ["sk_fat"]).count() == 0
    assert quality.duplicate_keys(s.municipio, ["sk_municipio"]).count() == 0
    assert quality.orphans(s.fato, ["sk_municipio"], s.municipio, ["sk_municipio"]).count() == 0
    assert quality.orphans(s.fato, ["sk_clima"], s.clima, ["sk_clima"]).count() == 0
    assert quality.orphans(s.fato, ["sk_socioeconomico"], s.socio, ["sk_socioeconomico"]).count() == 0
    nulls = {r["coluna"]: r["nulos"] for r in quality.null_counts(
        s.fato, ["sk_municipio", "sk_tempo", "sk_estacao"]).collect()}
    assert nulls == {"sk_municipio": 0, "sk_tempo": 0, "sk_estacao": 0}


def test_load_warehouse_from_files(spark, real_star_inputs, scratch):
    import os
    import tempfile

    from stellata.plans.warehouse import load_warehouse
    out = os.path.join(tempfile.mkdtemp(dir=scratch), "dw")
    star = load_warehouse(spark, out_root=out, mode="compat", **real_star_inputs["paths"])
    assert star.fato.count() == 1710
    assert star.extras["mv_regiao_ano"].agg(F.sum("total_casos")).first()[0] == 13327
    assert star.clima.count() == 20 * 6
    rejects = star.extras["rejeitos"].where("carga = 'pib'").collect()
    assert [(r["chave"], len(r["falhas"])) for r in rejects] == [("Município Sem Número", 6)]
    # the climate year with no rain readings sums to 0 and has no rainy days
    dry = star.clima.join(star.estacao.where(F.col("cd_estacao") == "A875"), "sk_estacao") \
        .where(F.col("sk_tempo") == 2).first()
    assert str(dry["precipitacao_total"]) == "0.00" and dry["dias_chuva"] == 0


def test_bounded_climate_lookup_equals_full_join(star_correct):
    from dataclasses import replace
    plain = replace(star_correct, extras={})  # no region map: whole climate table joined
    for fn in (olap.wide_view, olap.region_year_summary, olap.json_rows):
        a = sorted(map(tuple, fn(star_correct).collect()), key=repr)
        b = sorted(map(tuple, fn(plain).collect()), key=repr)
        assert a == b, fn.__name__
