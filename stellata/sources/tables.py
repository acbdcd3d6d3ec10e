"""Readers for the tabular raw inputs: case counts, density, daily weather,
station catalogue (JSON), GDP (XML and the wide sheet export)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellata.functions.dates import parse_mixed_date
from stellata.functions.numbers import locale_number
from stellata.functions.text import null_text, strip_dot_zero
from stellata.sources.json_arrays import read_json_array

YEARS = (2018, 2019, 2020, 2021, 2022, 2023)

CASES_COLUMNS = ["municipio_raw"] + [f"casos_{y}" for y in YEARS] + ["total"]
# Names of the raw density export that are no municipalities.
DENSITY_EXCLUDED_NAMES = ("Estado do Paraná", "Município/Estado")
DENSITY_COLUMNS = ["municipio", "regiao"] + [f"dens_{y}" for y in YEARS]
DAILY_WEATHER_COLUMNS = [
    "ano", "codigo_estacao", "nome_estacao", "latitude", "longitude", "altitude", "data",
    "temp_max_c", "temp_min_c", "temp_med_c", "umidade_med_pct", "precipitacao_mm",
]
#: precision and scale of the numbers of the daily weather staging table
DAILY_WEATHER_TYPES = {"latitude": (12, 8), "longitude": (12, 8), "altitude": (8, 2), "temp_max_c": (6, 2),
                       "temp_min_c": (6, 2), "temp_med_c": (6, 2), "umidade_med_pct": (6, 2),
                       "precipitacao_mm": (8, 2)}
STATION_FIELDS = ["CD_ESTACAO", "DC_NOME", "SG_ESTADO", "TP_ESTACAO", "CD_SITUACAO",
                  "VL_LATITUDE", "VL_LONGITUDE", "VL_ALTITUDE"]
GDP_FIELDS = ["municipio"] + [f"per_capita_{y}" for y in YEARS] + [f"pib_total_{y}" for y in YEARS]
GDP_SHEET_COLUMNS = (["municipio"] + [f"per_capita_{y}" for y in (2017,) + YEARS]
                     + [f"pib_total_{y}" for y in (2017,) + YEARS])


def _strings(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def _null_texts(df: DataFrame) -> DataFrame:
    """Every (text) column with the texts for a missing value as NULL."""
    return df.select(*[null_text(c).alias(c) for c in df.columns])


def read_cases(spark: SparkSession, path: str) -> DataFrame:
    """Case-count file: ``;`` separated UTF-8, header line, every cell kept as
    text (``-`` stays ``-``). Columns are renamed by position; the ``Total`` line
    is dropped (a NULL name is kept, as a pandas ``!=`` filter keeps it)."""
    df = (spark.read.option("sep", ";").option("header", True).option("encoding", "UTF-8")
          .schema(_strings(CASES_COLUMNS)).csv(path))
    return _null_texts(df).where(~F.col("municipio_raw").eqNullSafe("Total"))


def read_density(spark: SparkSession, path: str) -> DataFrame:
    """Processed density file: ``;`` separated, dot decimals."""
    schema = T.StructType(
        [T.StructField("municipio", T.StringType()), T.StructField("regiao", T.StringType())]
        + [T.StructField(f"dens_{y}", T.DecimalType(10, 2)) for y in YEARS])
    return spark.read.option("sep", ";").option("header", True).schema(schema).csv(path)


def density_text(spark: SparkSession, path: str) -> DataFrame:
    """The processed density file with every cell as text (for its rejects)."""
    return _null_texts(
        spark.read.option("sep", ";").option("header", True).schema(_strings(DENSITY_COLUMNS)).csv(path))


def density_raw_text(spark: SparkSession, path: str) -> DataFrame:
    """Raw density export, cells as text: UTF-16, tab-separated. The title is the first
    line of a file, by position; the header and the state's total are dropped by name.

    UTF-16 has no splittable line ends, so a file is one row here (``binaryFile``); an
    export holds one state's municipalities."""
    names = ["municipio", "regiao"] + [f"dens_{y}" for y in YEARS]
    text = (spark.read.format("binaryFile").load(path)
            .select(F.decode("content", "UTF-16").alias("_t")))
    lines = F.split(F.col("_t"), "\r?\n")
    rows = text.select(F.posexplode(F.transform(lines, lambda x: F.split(x, "\t"))).alias("_n", "_c"))
    rows = rows.where((F.col("_n") > 0) & (F.array_join("_c", "") != ""))
    unquoted = lambda c: F.replace(F.regexp_replace(c, '^"|"$', ""), F.lit('""'), F.lit('"'))
    cell = [F.nullif(unquoted(F.get("_c", F.lit(i))), F.lit("")).alias(n) for i, n in enumerate(names)]
    return rows.select(*cell).where(~F.coalesce(F.trim("municipio").isin(*DENSITY_EXCLUDED_NAMES), F.lit(False)))


def read_density_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw density export with its numbers (``1.234,56``) as decimal(10,2)."""
    nums = [f"dens_{y}" for y in YEARS]
    return density_raw_text(spark, path).select(
        "municipio", "regiao", *[locale_number(c).alias(c) for c in nums])


def daily_weather_text(spark: SparkSession, path: str) -> DataFrame:
    """The daily weather CSV with every cell as text."""
    return _null_texts(spark.read.option("header", True).schema(_strings(DAILY_WEATHER_COLUMNS)).csv(path))


def read_daily_weather(spark: SparkSession, path: str) -> DataFrame:
    """Daily weather CSV written by the hourly aggregation, loaded into the
    staging types (see :func:`typed_daily_weather`)."""
    return typed_daily_weather(daily_weather_text(spark, path))


def typed_daily_weather(text: DataFrame) -> DataFrame:
    """Mixed date layouts parsed, measures as decimals; what does not fit is NULL here
    and listed by ``warehouse.daily_weather_rejects``."""
    number = {c: F.trim(F.col(c)).try_cast(f"decimal({p},{s})").alias(c)
              for c, (p, s) in DAILY_WEATHER_TYPES.items()}
    return text.select(
        F.col("ano").try_cast("int").alias("ano"),
        F.trim("codigo_estacao").alias("codigo_estacao"), "nome_estacao",
        *[number[c] for c in ("latitude", "longitude", "altitude")],
        parse_mixed_date("data").alias("data_medicao"),
        *[number[c] for c in list(DAILY_WEATHER_TYPES)[3:]])


def read_stations(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Station catalogue. A top-level JSON array gives one row per object, whatever its size:
    it is split over many tasks (``json_arrays``). JSON Lines input: ``multi_line=False``."""
    if multi_line:
        return read_json_array(spark, path, _strings(STATION_FIELDS))
    return spark.read.schema(_strings(STATION_FIELDS)).json(path)


def read_gdp_xml(spark: SparkSession, path: str) -> DataFrame:
    """GDP document ``<pib_municipios><municipio><municipio>name</municipio>…``.
    Each row element carries a child with the same name; every field is text."""
    return (spark.read.format("xml").option("rowTag", "municipio")
            .schema(_strings(GDP_FIELDS)).load(path))


def explode_xml_column(df: DataFrame, column: str, row_tag: str, fields) -> DataFrame:
    """Rows from XML documents held in a string column (``XMLTABLE``): the column
    is parsed with ``from_xml`` into an array of row structs and inlined."""
    schema = T.StructType([T.StructField(row_tag, T.ArrayType(_strings(fields)))])
    parsed = df.select(F.from_xml(F.col(column), schema).alias("_doc"))
    return parsed.select(F.inline(F.col(f"_doc.{row_tag}")))


def explode_json_column(df: DataFrame, column: str, fields, keep=()) -> DataFrame:
    """Rows from JSON arrays of objects held in a string column (``JSON_TABLE``)."""
    schema = T.ArrayType(_strings(fields))
    return df.select(*keep, F.inline(F.from_json(F.col(column), schema)))


def clean_gdp_sheet(sheet: DataFrame) -> DataFrame:
    """Wide GDP sheet (15 columns by position, e.g. a CSV export of the
    spreadsheet read as text): name 2017..2023 per-capita and totals, drop rows
    with no name, the ``PRODUTO INTERNO…`` caption, repeated ``MUNICÍPIOS``
    headers and rows without a 2018 total, then drop the 2017 columns. Number
    text loses a trailing ``.0``."""
    df = sheet.toDF(*GDP_SHEET_COLUMNS)
    name = F.col("municipio")
    df = df.where(name.isNotNull()
                  & ~F.coalesce(name.cast("string").contains("PRODUTO INTERNO"), F.lit(False))
                  & ~name.eqNullSafe("MUNICÍPIOS")
                  & F.col("pib_total_2018").isNotNull())
    df = df.drop("per_capita_2017", "pib_total_2017")
    return df.select(*[strip_dot_zero(F.col(c).cast("string")).alias(c) for c in df.columns])
