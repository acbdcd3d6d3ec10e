"""Command line: the source project's workflows as Spark jobs.

    python -m stellata weather --pasta DIR --saida OUT [--granularidade diario|horario]
    python -m stellata density --entrada RAW_UTF16.csv --saida OUT
    python -m stellata gdp --entrada SHEET.csv --saida OUT_XML
    python -m stellata load --casos … --densidade … --estacoes … --clima … --pib … --dw OUT [--modo correct|compat]
    python -m stellata query NAME --dw OUT [--saida OUT] [--formato csv|parquet|json] [--mostrar N]

Every command runs under spark-submit as well (``--master`` etc. come from there).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

QUERIES = ("yearly_totals", "top_places", "risk_and_income_bands", "year_over_year",
           "rank_quartile_share", "moving_avg_running_sum", "rollup_region_year",
           "cube_period_band", "grouping_sets_year_region", "wide_view", "region_year_summary",
           "xml_report", "json_rows", "with_region_mean", "above_region_mean", "period_ratio")


def _spark(master: str | None) -> SparkSession:
    from stellata.session import get_spark
    return get_spark(master)


def cmd_weather(spark: SparkSession, a) -> dict:
    from stellata.operators.aggregates import hourly_to_daily
    from stellata.sources.sinks import write_csv, write_daily_weather
    from stellata.sources.weather import read_weather_hourly
    hourly = read_weather_hourly(spark, a.pasta)
    if a.granularidade == "horario":
        write_csv(hourly.drop("arquivo", "linha"), a.saida, sep=",",
                  sort_by=("codigo_estacao", "data", "hora_utc"))
        return {"registros_horarios": spark.read.option("header", True).csv(a.saida).count()}
    return write_daily_weather(hourly_to_daily(hourly), a.saida)


def cmd_density(spark: SparkSession, a) -> dict:
    from stellata.sources.sinks import write_csv
    from stellata.sources.tables import read_density_raw
    df = read_density_raw(spark, a.entrada)
    write_csv(df, a.saida, sep=";")
    return {"municipios": spark.read.option("sep", ";").option("header", True).csv(a.saida).count()}


def cmd_gdp(spark: SparkSession, a) -> dict:
    from stellata.sources.sinks import write_gdp_xml
    from stellata.sources.tables import GDP_SHEET_COLUMNS, clean_gdp_sheet
    sheet = (spark.read.option("header", False).option("sep", a.sep)
             .schema(", ".join(f"c{i} string" for i in range(len(GDP_SHEET_COLUMNS)))).csv(a.entrada))
    clean = clean_gdp_sheet(sheet)
    write_gdp_xml(clean, a.saida)
    return {"municipios": clean.count()}


def cmd_load(spark: SparkSession, a) -> dict:
    from stellata.plans.warehouse import load_warehouse
    star = load_warehouse(spark, cases_csv=a.casos, density_csv=a.densidade, stations_json=a.estacoes,
                          daily_weather_csv=a.clima, gdp_xml=a.pib, out_root=a.dw, mode=a.modo)
    return {name: df.count() for name, df in star.tables().items()}


def cmd_query(spark: SparkSession, a) -> dict:
    from stellata.plans import olap
    from stellata.plans.views import SUMMARY_NAME, register_views
    from stellata.plans.warehouse import load_star
    star = load_star(spark, a.dw, ("aux_regiao_estacao", SUMMARY_NAME))
    register_views(spark, star)
    if a.nome in ("with_region_mean", "above_region_mean"):
        df = getattr(olap, a.nome)(star, a.regiao)
    elif a.nome == "period_ratio":
        df = olap.period_ratio(star.extras[SUMMARY_NAME])
    else:
        df = getattr(olap, a.nome)(star)
    if a.saida:
        df.write.mode("overwrite").format(a.formato).option("header", True).save(a.saida)
    if a.mostrar:
        df.show(a.mostrar, truncate=False)
    return {"consulta": a.nome}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="stellata", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    sub = p.add_subparsers(dest="comando", required=True)

    w = sub.add_parser("weather", help="hourly weather folder -> daily (or hourly) CSV")
    w.add_argument("--pasta", required=True, help="root with 2018/, 2019/, … folders")
    w.add_argument("--saida", required=True)
    w.add_argument("--granularidade", choices=["horario", "diario"], default="diario")
    w.set_defaults(run=cmd_weather)

    d = sub.add_parser("density", help="raw UTF-16 density table -> ';' CSV")
    d.add_argument("--entrada", required=True)
    d.add_argument("--saida", required=True)
    d.set_defaults(run=cmd_density)

    g = sub.add_parser("gdp", help="wide GDP sheet (CSV export) -> XML")
    g.add_argument("--entrada", required=True)
    g.add_argument("--saida", required=True)
    g.add_argument("--sep", default=",")
    g.set_defaults(run=cmd_gdp)

    ld = sub.add_parser("load", help="files -> star schema + summary table")
    for opt in ("casos", "densidade", "estacoes", "clima", "pib", "dw"):
        ld.add_argument(f"--{opt}", required=True)
    ld.add_argument("--modo", choices=["correct", "compat"], default="correct")
    ld.set_defaults(run=cmd_load)

    q = sub.add_parser("query", help="run one analytic statement on a loaded warehouse")
    q.add_argument("nome", choices=QUERIES)
    q.add_argument("--dw", required=True)
    q.add_argument("--regiao", default="RGI de Londrina")
    q.add_argument("--saida", default=None)
    q.add_argument("--formato", choices=["csv", "parquet", "json"], default="parquet")
    q.add_argument("--mostrar", type=int, default=0)
    q.set_defaults(run=cmd_query)
    return p


def main(argv=None, spark: SparkSession | None = None) -> dict:
    args = parser().parse_args(argv)
    result = args.run(spark or _spark(args.master), args)
    print(json.dumps(result, ensure_ascii=False))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
