"""Readers and sinks on small synthetic files written in the layouts the
source project expects."""

from __future__ import annotations

import json
import os
import tempfile
from decimal import Decimal
from xml.etree import ElementTree

from pyspark.sql import functions as F

from stellata.plans.star import dim_estacao
from stellata.sources.sinks import (write_csv, write_csv_document, write_gdp_xml, write_table,
                                    write_xml_document)
from stellata.sources.tables import (GDP_SHEET_COLUMNS, clean_gdp_sheet, explode_json_column,
                                     read_cases, read_density, read_density_raw, read_gdp_xml,
                                     read_stations)


def _tmp(scratch):
    return tempfile.mkdtemp(dir=scratch)


def test_density_raw_utf16(spark, scratch):
    path = os.path.join(_tmp(scratch), "densidade.csv")
    lines = ["Densidade Demográfica (hab/km²)",
             "Município/Estado\tRegião\t2018\t2019\t2020\t2021\t2022\t2023",
             "Estado do Paraná\t\t57,39\t57,70\t58,00\t58,30\t57,48\t57,80",
             "Curitiba\tRGI de Curitiba\t4.406,96\t4.427,49\t4.447,94\t4.468,38\t3.734,97\t3.753,40",
             "Abatiá\tRGI de Santo Antônio da Platina\t32,93\t32,71\t32,50\t32,29\t31,76\t32,04",
             "Município/Estado\tRegião\t2018\t2019\t2020\t2021\t2022\t2023"]
    with open(path, "w", encoding="utf-16") as f:
        f.write("\r\n".join(lines) + "\r\n")
    rows = {r["municipio"]: r for r in read_density_raw(spark, path).collect()}
    assert set(rows) == {"Curitiba", "Abatiá"}
    assert rows["Curitiba"]["dens_2018"] == Decimal("4406.96")
    assert rows["Abatiá"]["regiao"] == "RGI de Santo Antônio da Platina"
    assert rows["Abatiá"]["dens_2023"] == Decimal("32.04")
    # and back out as the processed ';' file, read by the processed-file reader
    out = os.path.join(_tmp(scratch), "densidade")
    write_csv(read_density_raw(spark, path), out, sep=";", single_file=True)
    again = {r["municipio"]: r["dens_2018"] for r in read_density(spark, out).collect()}
    assert again == {"Curitiba": Decimal("4406.96"), "Abatiá": Decimal("32.93")}


def test_cases_reader_keeps_dash_and_drops_total(spark, scratch):
    path = os.path.join(_tmp(scratch), "casos.csv")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write('"Município de residência";"2018";"2019";"2020";"2021";"2022";"2023";"Total"\r\n'
                '"410010 ABATIA";-;2;-;1;-;2;5\r\n"410020 ADRIANOPOLIS";-;-;-;-;2;1;3\r\n'
                '"Total";2;2;-;1;2;3;8\r\n')
    rows = read_cases(spark, path).orderBy("municipio_raw").collect()
    assert [r["municipio_raw"] for r in rows] == ["410010 ABATIA", "410020 ADRIANOPOLIS"]
    assert rows[0]["casos_2018"] == "-" and rows[0]["total"] == "5"


def test_gdp_sheet_xml_round_trip(spark, scratch):
    header = ["PRODUTO INTERNO BRUTO DOS MUNICÍPIOS"] + [None] * 14
    colhdr = ["MUNICÍPIOS"] + [str(y) for y in range(2017, 2024)] * 2
    rows = [header, colhdr,
            ["Abatiá"] + [f"{20000 + i}.0" for i in range(7)] + [f"{100000 + i}.0" for i in range(7)],
            ["Curitiba & Região"] + [f"{50000 + i}.5" for i in range(7)] + [f"{9000000 + i}.0" for i in range(7)],
            ["Sem Total"] + ["1.0"] * 8 + [None] + ["1.0"] * 5,
            [None] + ["2.0"] * 14,
            ["Ortigueira"] + ["3.0"] * 7 + ["4.0", "5.0"] + [None] * 5]
    sheet = spark.createDataFrame(rows, ", ".join(f"c{i} string" for i in range(15)))
    clean = clean_gdp_sheet(sheet)
    assert clean.columns == [c for c in GDP_SHEET_COLUMNS if not c.endswith("2017")]
    got = {r["municipio"]: r for r in clean.collect()}
    assert set(got) == {"Abatiá", "Curitiba & Região", "Ortigueira"}
    assert got["Abatiá"]["per_capita_2018"] == "20001" and got["Curitiba & Região"]["per_capita_2018"] == "50001.5"
    out = os.path.join(_tmp(scratch), "pib")
    write_gdp_xml(clean, out, single_document=True)
    docs = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(docs) == 1  # one document, as the source writes
    back = {r["municipio"]: r for r in read_gdp_xml(spark, out).collect()}
    assert set(back) == set(got)
    assert back["Curitiba & Região"]["pib_total_2023"] == "9000006"
    assert back["Ortigueira"]["pib_total_2023"] in ("", None)  # NULL -> empty element


def test_stations_json_and_dimension(spark, scratch):
    path = os.path.join(_tmp(scratch), "estacoes.json")
    data = [{"CD_ESTACAO": "A807", "DC_NOME": "CURITIBA", "SG_ESTADO": "PR", "TP_ESTACAO": "Automatica",
             "CD_SITUACAO": "Operante", "VL_LATITUDE": "-25.44805555", "VL_LONGITUDE": "-49.23055555",
             "VL_ALTITUDE": "923.5"},
            {"CD_ESTACAO": "A701", "DC_NOME": "SAO PAULO", "SG_ESTADO": "SP", "TP_ESTACAO": "Automatica",
             "CD_SITUACAO": "Operante", "VL_LATITUDE": "-23.5", "VL_LONGITUDE": "-46.6", "VL_ALTITUDE": "760"},
            {"CD_ESTACAO": "A842", "DC_NOME": "LONDRINA", "SG_ESTADO": "PR", "TP_ESTACAO": "Automatica",
             "CD_SITUACAO": "Pane", "VL_LATITUDE": None, "VL_LONGITUDE": "x", "VL_ALTITUDE": None}]
    with open(path, "w", encoding="utf-8") as f:
        json.dump(data, f)
    st = read_stations(spark, path)
    assert st.count() == 3
    dim = {r["cd_estacao"]: r for r in dim_estacao(st).collect()}
    assert set(dim) == {"A807", "A842"}
    assert dim["A807"]["latitude"] == Decimal("-25.44805555")  # negative accepted
    assert dim["A842"]["latitude"] is None and dim["A842"]["longitude"] is None
    assert sorted(r["sk_estacao"] for r in dim.values()) == [1, 2]
    doc = spark.createDataFrame([(json.dumps(data),)], "conteudo string")
    rows = explode_json_column(doc, "conteudo", ["CD_ESTACAO", "SG_ESTADO"])
    assert sorted(r["CD_ESTACAO"] for r in rows.collect()) == ["A701", "A807", "A842"]


def test_write_table_is_idempotent(spark, scratch):
    df = spark.range(5).withColumn("ano", F.lit(2018))
    out = os.path.join(_tmp(scratch), "t")
    write_table(df, out, partition_by=["ano"])
    write_table(df, out, partition_by=["ano"])
    assert spark.read.parquet(out).count() == 5


def _joined(path):
    """(part files with bytes, their bytes joined in the order of the names)."""
    names = sorted(n for n in os.listdir(path) if n.startswith("part-"))
    texts = [open(os.path.join(path, n), "rb").read() for n in names]
    return sum(map(bool, texts)), b"".join(texts)


def _places(spark, n):
    """Rows in no order, with nulls, empty texts, separators, quotes, markup and ties."""
    odd = ["São José; d'Oeste", 'a "b" c', "x & y <z>", "", None, "line\nbreak", "7.0"]
    return spark.createDataFrame([((i * 7919) % n // 2 if i % 50 else None, i, odd[i % len(odd)], i / 4) for i in range(n)],
                                 "chave int, n int, nome string, valor double").repartition(6)


def test_csv_document_equals_the_file_of_one_task(spark, scratch):
    whole, parts = os.path.join(_tmp(scratch), "um"), os.path.join(_tmp(scratch), "varios")
    df = _places(spark, 3000)
    with_aqe = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_csv_document(df, parts, ["chave", "n"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", with_aqe)
    one_task = df.coalesce(1).sortWithinPartitions(F.col("chave").asc_nulls_last(), F.col("n").asc_nulls_last())
    write_csv(one_task, whole)
    files, text = _joined(parts)
    assert files > 3
    assert _joined(whole) == (1, text)
    write_csv_document(df.limit(0), parts, ["chave"])
    assert _joined(parts)[1] == b"chave;n;nome;valor\n"


def test_xml_document_from_many_tasks(spark, scratch):
    parts = os.path.join(_tmp(scratch), "pib")
    df = _places(spark, 400)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_xml_document(df, parts, ["n"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files, text = _joined(parts)
    assert files > 3 and text.count(b"<pib_municipios>") == text.count(b"</pib_municipios>") == 1
    rows = ElementTree.fromstring(text).findall("municipio")
    assert [int(r.findtext("n")) for r in rows] == list(range(400))
    told = {r["n"]: r["nome"] for r in df.collect()}
    assert all((r.findtext("nome") or "") == (told[int(r.findtext("n"))] or "").removesuffix(".0") for r in rows)
    whole = os.path.join(_tmp(scratch), "um")
    write_gdp_xml(df.coalesce(1).sortWithinPartitions("n"), whole, single_document=True)
    assert text == _joined(whole)[1] + b"\n"
    write_xml_document(df.limit(0), parts, ["n"])
    assert len(ElementTree.fromstring(_joined(parts)[1])) == 0
