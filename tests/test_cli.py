"""The command line on the synthetic inputs (in-process, shared session)."""

from __future__ import annotations

import os
import tempfile

from stellata.cli import main
from weather_files import write_weather_folder


def test_cli_weather_load_and_query(spark, scratch, star_inputs):
    base = tempfile.mkdtemp(dir=scratch)
    root = write_weather_folder(os.path.join(base, "horarios"))
    assert main(["weather", "--pasta", root, "--saida", os.path.join(base, "diario")], spark)["rows"] == 6
    assert main(["weather", "--pasta", root, "--saida", os.path.join(base, "horario"),
                 "--granularidade", "horario"], spark) == {"registros_horarios": 10}
    p = star_inputs["paths"]
    dw = os.path.join(base, "dw")
    counts = main(["load", "--casos", p["cases_csv"], "--densidade", p["density_csv"],
                   "--estacoes", p["stations_json"], "--clima", p["daily_weather_csv"],
                   "--pib", p["gdp_xml"], "--dw", dw], spark)
    assert counts["fato_tuberculose"] == 53 * 6 and counts["dim_municipio"] == 60
    out = os.path.join(base, "q2")
    main(["query", "top_places", "--dw", dw, "--saida", out, "--formato", "csv"], spark)
    rows = spark.read.option("header", True).csv(out).collect()
    assert len(rows) == 10
    main(["query", "period_ratio", "--dw", dw, "--saida", os.path.join(base, "q15")], spark)
    main(["query", "with_region_mean", "--dw", dw, "--saida", os.path.join(base, "q14"),
          "--regiao", "RGI de Londrina"], spark)
    assert spark.read.parquet(os.path.join(base, "q14")).count() > 0


def test_cli_density_and_gdp(spark, scratch):
    base = tempfile.mkdtemp(dir=scratch)
    raw = os.path.join(base, "dens.csv")
    with open(raw, "w", encoding="utf-16") as f:
        f.write("Titulo\r\nMunicípio/Estado\tRegião\t2018\t2019\t2020\t2021\t2022\t2023\r\n"
                "Estado do Paraná\t\t1,0\t1,0\t1,0\t1,0\t1,0\t1,0\r\n"
                "Curitiba\tRGI de Curitiba\t4.406,96\t1,0\t1,0\t1,0\t1,0\t1,0\r\n"
                "Redondo\tRGI de Irati\t1200\t1210\t1220\t1230\t1240\t1250\r\n"  # like a header, is data
                "Vazio\t\t\t\t\t\t\t\r\n")  # a name without values is kept
    assert main(["density", "--entrada", raw, "--saida", os.path.join(base, "d")], spark) == {"municipios": 3}
    sheet = os.path.join(base, "pib.csv")
    with open(sheet, "w", encoding="utf-8") as f:
        f.write("PRODUTO INTERNO BRUTO,,,,,,,,,,,,,,\n")
        f.write("MUNICÍPIOS" + ",2017,2018,2019,2020,2021,2022,2023" * 2 + "\n")
        f.write("Abatiá" + ",1.0" * 14 + "\n")
    assert main(["gdp", "--entrada", sheet, "--saida", os.path.join(base, "x")], spark) == {"municipios": 1}


def test_cli_every_query(spark, scratch, star_inputs):
    from stellata.cli import QUERIES
    base = tempfile.mkdtemp(dir=scratch)
    p = star_inputs["paths"]
    dw = os.path.join(base, "dw")
    main(["load", "--casos", p["cases_csv"], "--densidade", p["density_csv"],
          "--estacoes", p["stations_json"], "--clima", p["daily_weather_csv"],
          "--pib", p["gdp_xml"], "--dw", dw, "--modo", "compat"], spark)
    for name in QUERIES:
        out = os.path.join(base, name)
        main(["query", name, "--dw", dw, "--saida", out], spark)
        # one place a region: nothing is above its own mean
        assert spark.read.parquet(out).count() > 0 or name == "above_region_mean", name
