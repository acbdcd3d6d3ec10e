"""Hourly weather folder -> hourly readings -> daily rows -> yearly climate."""

from __future__ import annotations

import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stellata.operators.aggregates import hourly_to_daily, yearly_summary
from stellata.sources.sinks import write_daily_weather
from stellata.sources.tables import read_daily_weather
from stellata.sources.weather import read_weather_hourly
from weather_files import write_weather_folder


@pytest.fixture(scope="module")
def folder(scratch):
    return write_weather_folder(os.path.join(tempfile.mkdtemp(dir=scratch), "horarios"))


@pytest.fixture(scope="module")
def hourly(spark, folder):
    return read_weather_hourly(spark, folder).cache()


@pytest.fixture(scope="module")
def daily(hourly):
    return {(r["codigo_estacao"], r["data"]): r for r in hourly_to_daily(hourly).collect()}


def test_files_kept_and_skipped(hourly):
    files = {os.path.basename(r[0]) for r in hourly.select("arquivo").distinct().collect()}
    assert files == {"INMET_S_PR_A807_CURITIBA_01-01-2018_A_31-12-2018.CSV",
                     "inmet_s_pr_A807_curitiba.csv", "INMET_S_PR_A842_LONDRINA.CSV"}
    per_file = {os.path.basename(r[0]): r[1] for r in hourly.groupBy("arquivo").count().collect()}
    assert per_file["INMET_S_PR_A807_CURITIBA_01-01-2018_A_31-12-2018.CSV"] == 4  # empty first cell skipped
    assert per_file["inmet_s_pr_A807_curitiba.csv"] == 3
    assert per_file["INMET_S_PR_A842_LONDRINA.CSV"] == 3


def test_metadata_and_year(hourly):
    rows = {r["ano"]: r for r in hourly.select("ano", "codigo_estacao", "nome_estacao", "latitude",
                                               "altitude").distinct().collect()}
    assert rows[2018]["codigo_estacao"] == "A807" and rows[2018]["nome_estacao"] == "CURITIBA"
    assert rows[2018]["latitude"] == pytest.approx(-25.44805555)
    assert rows[2018]["altitude"] == pytest.approx(923.5)
    assert rows[2020]["codigo_estacao"] == "A842"


def test_hour_text(hourly):
    hours = {r[0] for r in hourly.where(F.col("ano") == 2018).select("hora_utc").collect()}
    assert hours == {"0000", "0100", "0200"}


def test_daily_values(daily):
    d = daily[("A807", "2018/01/01")]
    assert (d["temp_max_c"], d["temp_min_c"]) == (21.0, 19.1)
    assert d["temp_med_c"] == Decimal("20.00") and d["umidade_med_pct"] == Decimal("82.50")
    assert d["precipitacao_mm"] == Decimal("1.20")
    d = daily[("A807", "2018/01/02")]
    assert d["umidade_med_pct"] is None and d["precipitacao_mm"] is None
    assert d["temp_med_c"] == Decimal("18.00")
    d = daily[("A807", "2019-01-01")]
    assert d["umidade_med_pct"] is None  # -9999.00 and NaN are missing readings
    assert d["temp_med_c"] == Decimal("20.60") and d["precipitacao_mm"] == Decimal("0.60")
    assert daily[("A807", "2019-01-02")]["precipitacao_mm"] == Decimal("1.50")
    d = daily[("A842", "2020-03-01")]  # every reading missing: the day exists, all NULL
    assert all(d[k] is None for k in ("temp_max_c", "temp_min_c", "temp_med_c",
                                      "umidade_med_pct", "precipitacao_mm"))
    assert daily[("A842", "2020-03-02")]["temp_med_c"] == Decimal("25.25")


def test_first_seen_metadata(daily):
    assert daily[("A807", "2019-01-01")]["ano"] == 2019
    assert daily[("A807", "2018/01/01")]["latitude"] == pytest.approx(-25.44805555)


def test_daily_csv_round_trip_and_yearly(spark, hourly, scratch):
    out = os.path.join(tempfile.mkdtemp(dir=scratch), "clima_pr")
    counts = write_daily_weather(hourly_to_daily(hourly), out)
    assert counts["rows"] == 6
    staged = read_daily_weather(spark, out)
    dates = {r[0] for r in staged.select(F.col("data_medicao").cast("string")).collect()}
    assert {"2018-01-01", "2018-01-02", "2019-01-01", "2020-03-01"} <= dates
    yearly = {(r["codigo_estacao"], r["ano"]): r for r in yearly_summary(
        staged, ["codigo_estacao", "ano"], "temp_max_c", "temp_min_c", "temp_med_c",
        "umidade_med_pct", "precipitacao_mm").collect()}
    y = yearly[("A807", 2018)]
    assert y["temp_max_anual"] == Decimal("21.00") and y["temp_min_anual"] == Decimal("17.00")
    assert y["temp_med_anual"] == Decimal("19.00") and y["precipitacao_total"] == Decimal("1.20")
    assert y["dias_chuva"] == 1
    y = yearly[("A842", 2020)]
    assert y["precipitacao_total"] == Decimal("0.00") and y["dias_chuva"] == 0


def test_stream_matches_batch(spark, folder, daily, scratch):
    from stellata.streaming.weather_stream import start_daily_ingest
    base = tempfile.mkdtemp(dir=scratch)
    q = start_daily_ingest(spark, folder, os.path.join(base, "daily"), os.path.join(base, "ckpt"))
    assert q.awaitTermination(300), "stream did not finish"
    assert q.exception() is None, q.exception()
    got = spark.read.parquet(os.path.join(base, "daily"))
    assert sorted((r["codigo_estacao"], r["data"]) for r in got.collect()) == sorted(daily)
    # a second run over the same files commits nothing new
    q = start_daily_ingest(spark, folder, os.path.join(base, "daily"), os.path.join(base, "ckpt"))
    assert q.awaitTermination(300), "stream did not finish"
    assert q.exception() is None, q.exception()
    assert spark.read.parquet(os.path.join(base, "daily")).count() == len(daily)


def test_load_report(spark, folder):
    from stellata.sources.weather import load_report
    rep = load_report(spark, folder)
    # 6 csv files under 2018-2023 (the 2017 one is outside), 3 read, 10 hourly, 6 daily
    assert rep == {"arquivos_encontrados": 6, "arquivos_lidos": 3, "registros_horarios": 10,
                   "registros_diarios": 6, "anos_sem_arquivos": [2021, 2022, 2023]}


def test_broken_file_is_skipped(spark, scratch):
    import shutil
    root = os.path.join(tempfile.mkdtemp(dir=scratch), "horarios")
    write_weather_folder(root)
    bad = os.path.join(root, "2021", "INMET_S_PR_A807_QUEBRADO.CSV")
    os.makedirs(os.path.dirname(bad), exist_ok=True)
    with open(bad, "wb") as f:
        f.write(b"\xff\xfe\x00garbage;;\r\n\x00\x01")
    assert read_weather_hourly(spark, root).count() == 10
    shutil.rmtree(os.path.dirname(bad))


def test_copies_of_a_file_merge_into_the_same_days(spark, scratch):
    import shutil
    root = os.path.join(tempfile.mkdtemp(dir=scratch), "horarios")
    write_weather_folder(root)
    src = os.path.join(root, "2018", "INMET_S_PR_A807_CURITIBA_01-01-2018_A_31-12-2018.CSV")
    os.makedirs(os.path.join(root, "2018", "copia"))
    shutil.copy(src, os.path.join(root, "2018", "copia", os.path.basename(src)))
    daily = {(r["codigo_estacao"], r["data"]): r
             for r in hourly_to_daily(read_weather_hourly(spark, root)).collect()}
    d = daily[("A807", "2018/01/01")]
    # both copies read: extremes and means unchanged, the rain total counts twice
    assert (d["temp_max_c"], d["temp_med_c"]) == (21.0, Decimal("20.00"))
    assert d["precipitacao_mm"] == Decimal("2.40")
    assert len(daily) == 6


def test_stream_one_file_per_batch(spark, folder, daily, scratch):
    from stellata.streaming.weather_stream import start_daily_ingest
    base = tempfile.mkdtemp(dir=scratch)
    q = start_daily_ingest(spark, folder, os.path.join(base, "daily"), os.path.join(base, "ckpt"),
                           max_files_per_trigger=1)
    assert q.awaitTermination(300), "stream did not finish"
    assert q.exception() is None, q.exception()
    got = spark.read.parquet(os.path.join(base, "daily"))
    assert got.select("lote").distinct().count() >= 3  # several micro-batches
    assert sorted((r["codigo_estacao"], r["data"]) for r in got.collect()) == sorted(daily)


def test_header_after_a_long_block_of_notes(spark, scratch):
    """The header is searched in a bounded prefix first and in the whole text
    when it is not there."""
    from weather_files import _pre, _write
    root = os.path.join(tempfile.mkdtemp(dir=scratch), "horarios")
    notes = [f"nota {i};" + "x" * 120 for i in range(300)]  # ~38 KB before the header
    _write(root, "2018/INMET_S_PR_A807_LONGO.CSV", _pre() + notes + [
        "Data;Hora UTC;Temp. (°C)", "2018-01-01;0000 UTC;10,5", "2018-01-01;0100 UTC;11,5"])
    rows = read_weather_hourly(spark, root).collect()
    assert sorted((r["data"], r["hora_utc"], r["temp_med_c"]) for r in rows) == \
        [("2018-01-01", "0000", 10.5), ("2018-01-01", "0100", 11.5)]


# --- files of any shape --------------------------------------------------------------------

def _rows(spark, scratch, name, lines, year=2018):
    from weather_files import _write
    root = os.path.join(tempfile.mkdtemp(dir=scratch), "horarios")
    _write(root, f"{year}/INMET_S_PR_{name}.CSV", lines)
    return root


def test_any_number_of_columns(spark, scratch):
    from weather_files import _pre
    filler = [f"X{i}" for i in range(40)]
    root = _rows(spark, scratch, "LARGO", _pre() + [
        ";".join(["Data", *filler, "Temp. (°C)"]), ";".join(["2018-01-01", *["1"] * 40, "10,5"])])
    assert [r["temp_med_c"] for r in read_weather_hourly(spark, root).collect()] == [10.5]


def test_long_preamble_line_and_late_header(spark, scratch):
    from weather_files import _pre
    pre = _pre(name="N" * 100_000)
    root = _rows(spark, scratch, "TARDE", pre + [f"nota {i}" for i in range(5000)] + [
        "Data;Temp. (°C)", "2018-01-01;10,5"])
    [row] = read_weather_hourly(spark, root).collect()
    assert row["codigo_estacao"] == "A807" and len(row["nome_estacao"]) == 100_000
    assert row["linha"] == 8 + 5000 + 1


def test_file_without_a_header_is_reported(spark, scratch):
    from weather_files import _pre

    from stellata.sources.weather import file_report, read_files
    root = _rows(spark, scratch, "SEMCABECALHO", _pre() + ["2018-01-01;1;2"] * 20_000)
    write_weather_folder(root)
    assert read_weather_hourly(spark, root).count() == 10  # the other files are read
    got = {os.path.basename(r["arquivo"]): (r["situacao"], r["registros"])
           for r in file_report(read_files(spark, root)).collect()}
    assert got["INMET_S_PR_SEMCABECALHO.CSV"] == ("sem cabecalho", 0)
    assert got["INMET_S_PR_A999_OUTRO.CSV"] == ("outra uf", 0)
    assert got["INMET_S_PR_B000_SEMDATA.CSV"] == ("sem coluna de data", 0)
    assert got["INMET_S_PR_A842_LONDRINA.CSV"][0] == "lido"


def test_quoted_cells(spark, scratch):
    """Line breaks, separators and doubled quotes inside quotes; a quote inside a cell."""
    from weather_files import _pre
    root = _rows(spark, scratch, "ASPAS", _pre() + [
        'Data;OBS;Temp. (°C)', '2018-01-01;"a;b', 'c ""d"" e";10,5', '"2018-01-02";5"x;"11,5"', '2018-01-03;"";12,5'])
    rows = read_weather_hourly(spark, root).collect()
    assert sorted((r["data"], r["temp_med_c"]) for r in rows) == [
        ("2018-01-01", 10.5), ("2018-01-02", 11.5), ("2018-01-03", 12.5)]


def test_readings_are_rounded_once(spark):
    cols = "ano int, codigo_estacao string, nome_estacao string, latitude double, longitude double, altitude double, " \
           "data string, temp_max_c double, temp_min_c double, temp_med_c double, umidade_pct double, " \
           "precipitacao_mm double, arquivo string, linha int"
    one = lambda v, n: (2018, "A", "x", 0.0, 0.0, 0.0, "d", v, v, v, v, v, "f", n)
    got = hourly_to_daily(spark.createDataFrame([one(0.0049999996, 1)], cols)).collect()[0]
    assert got["temp_med_c"] == got["precipitacao_mm"] == Decimal("0.00")
    got = hourly_to_daily(spark.createDataFrame([one(0.005, 1), one(0.005, 2), one(0.005, 3)], cols)).collect()[0]
    assert got["temp_med_c"] == Decimal("0.01") and got["precipitacao_mm"] == Decimal("0.02")


def test_a_report_takes_no_cells_apart_and_a_reading_is_parsed_once(spark):
    from stellata.functions.numbers import tolerant_float
    from stellata.sources.weather import file_facts, file_report
    text = "\r\n".join(["UF:;PR"] + ["X:;1"] * 7 + ["Data;Temp. (°C)", "2020-01-01;1,5", '2020-01-02;"2;5"', ""])
    files = spark.createDataFrame([("f", 2020, text), ("n", 2020, None)], "arquivo string, ano int, texto string")
    assert dict(file_facts(files).dtypes)["registros"] == "array<string>"
    assert sorted(map(tuple, file_report(files).collect())) == [("f", 2020, "lido", 3), ("n", 2020, "outra uf", 0)]
    plan = spark.createDataFrame([("1,5",)], "x string").select(tolerant_float("x"))._jdf.queryExecution().analyzed()
    assert plan.toString().count("as double") <= 3
