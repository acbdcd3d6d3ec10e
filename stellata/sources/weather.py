"""Folder of hourly weather files -> hourly readings DataFrame.

Input layout: ``<root>/<year>/**/<name>_PR_<…>.CSV`` in ISO-8859-1. Each file has
eight ``KEY:;value`` preamble lines (UF, ESTACAO, CODIGO (WMO), LATITUDE, …), then a
header line (the first line from the ninth on whose text contains ``DATA``), then
rows separated by ``;`` or ``,`` (whichever the header uses).

Spark plan: one ``binaryFile`` scan (name filter applied in the file listing), bytes
decoded as Latin-1 (one file = one station-year, a few MB). The header is found by its
place in the text; what follows is split into records, quotes honoured, and each record
into its cells, of any number, after the records have become rows.
Map-only: no shuffle, no second scan, no Python per row.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellata.functions.numbers import tolerant_float
from stellata.functions.text import clean_clock, strip_ws
from stellata.sources.tables import YEARS

# ---------------------------------------------------------------------------
# Header aliases for each logical column, in priority order.
HEADER_ALIASES = {
    "data": ["Data", "DATA (YYYY-MM-DD)", "DATA"],
    "hora": ["Hora UTC", "HORA (UTC)", "HORA"],
    "temp_max": ["TEMPERATURA MAXIMA NA HORA ANT. (AUT) (°C)",
                 "TEMPERATURA MÁXIMA NA HORA ANT. (AUT) (°C)",
                 "Temp. Máx. (°C)"],
    "temp_min": ["TEMPERATURA MINIMA NA HORA ANT. (AUT) (°C)",
                 "TEMPERATURA MÍNIMA NA HORA ANT. (AUT) (°C)",
                 "Temp. Mín. (°C)"],
    "temp_med": ["TEMPERATURA DO AR - BULBO SECO, HORARIA (°C)",
                 "Temp. (°C)"],
    "umidade_med": ["UMIDADE RELATIVA DO AR, HORARIA (%)",
                    "Umidade (%)"],
    "precipitacao": ["PRECIPITACAO TOTAL, HORARIO (mm)",
                     "PRECIPITAÇÃO TOTAL, HORÁRIO (mm)",
                     "Precipitação (mm)"],
}
PREAMBLE_LINES = 8
STATE = "PR"
NAME_GLOB = "*_[Pp][Rr]_*.{csv,CSV}"
# ---------------------------------------------------------------------------

# Characters that stand for cell and record ends and for quotes inside a cell while a
# text is taken apart; the files are Latin-1 text, where they do not occur.
_CELL, _RECORD, _QUOTE = "\x02", "\x03", "\x04"

HOURLY_COLUMNS = ["ano", "codigo_estacao", "nome_estacao", "latitude", "longitude", "altitude",
                  "data", "hora_utc", "temp_max_c", "temp_min_c", "temp_med_c", "umidade_pct",
                  "precipitacao_mm", "arquivo", "linha"]


def _once(df: DataFrame, **columns) -> DataFrame:
    """``df`` with more columns, computed once: the optimizer does not move filters below
    a generator nor repeat its expressions."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))))


def csv_records(text, sep):
    """The records of a CSV text as an array of texts (null: null), which ``csv_cells``
    takes apart.

    A cell in quotes may hold separators, line breaks and doubled quotes; a quote
    between two other characters of a cell is an ordinary character. The text is cut
    at its quotes: pieces at even places lie outside quoted cells, an empty one between
    two quoted pieces is a doubled quote. A text without quotes is marked as it is."""
    text = F.replace(text, F.lit("\r\n"), F.lit("\n"))
    # the pattern begins with the quote: other characters are passed over at once
    pieces = F.split(F.regexp_replace(text, '"(?=[^;,\n"])(?<=[^;,\n"]")', _QUOTE), '"')
    last = F.size(pieces) - 1
    outside = lambda x: F.replace(F.replace(x, sep, F.lit(_CELL)), F.lit("\n"), F.lit(_RECORD))
    marked = F.transform(pieces, lambda x, i: F.when(i % 2 == 1, x)
                         .when((x == "") & (i > 0) & (i < last), F.lit(_QUOTE)).otherwise(outside(x)))
    whole = F.when(text.contains('"'), F.array_join(marked, "")).otherwise(outside(text))
    return F.split(whole, _RECORD)


def csv_cells(record):
    """The cells of a record of ``csv_records``; ``csv_text`` gives what a cell says."""
    return F.split(record, _CELL)


def csv_text(cell):
    return F.replace(cell, F.lit(_QUOTE), F.lit('"'))


def read_files(spark: SparkSession, root: str, years=YEARS) -> DataFrame:
    """(arquivo, ano, texto) — one row per matching file, decoded from Latin-1.

    The name filter runs in the file listing; the year is the folder right under
    the root. Unreadable files are skipped (``ignoreCorruptFiles``)."""
    files = _listed(spark, root, years, "content")
    return files.select("arquivo", "ano", F.decode("content", "ISO-8859-1").alias("texto"))


def _listed(spark: SparkSession, root: str, years, *columns: str) -> DataFrame:
    files = (spark.read.format("binaryFile")
             .option("recursiveFileLookup", True)
             .option("pathGlobFilter", NAME_GLOB)
             .option("ignoreCorruptFiles", True)  # a broken file is skipped, not fatal
             .load(root)
             .select(F.col("path").alias("arquivo"), *columns))
    tail = re.escape(root.rstrip("/").split("/")[-1])
    year = F.regexp_extract("arquivo", f"{tail}/([0-9]{{4}})/", 1)
    return (files.withColumn("ano", F.when(year != "", year.cast("int")))
            .where(F.col("ano").isin(*years)))


#: What became of a file (column ``situacao``).
READ, OTHER_STATE, NO_HEADER, NO_DATE = "lido", "outra uf", "sem cabecalho", "sem coluna de data"
UNREADABLE = "ilegivel"


def file_facts(files: DataFrame) -> DataFrame:
    """Per file: station metadata, ``situacao``, the records from the header on (texts for
    ``csv_cells``, null unless the file is read) and the position of every logical column."""
    head = F.substring_index("texto", "\n", PREAMBLE_LINES)
    df = _once(files, _pre=F.transform(F.split(head, "\n"), strip_ws),
               _body=F.substr("texto", F.length(head) + 2)).drop("texto")
    kv = F.transform(F.filter("_pre", lambda x: x.contains(";")), lambda x: F.split(x, ";"))
    kv = F.transform(kv, lambda p: F.struct(
        F.upper(F.trim(F.replace(p[0], F.lit(":"), F.lit("")))).alias("k"),
        F.coalesce(F.trim(F.get(p, 1)), F.lit("")).alias("v")))
    df = _once(df, _kv=F.reverse(kv), _upper=F.upper("_body"))
    df = _once(df, _k=F.col("_kv")["k"], _v=F.col("_kv")["v"]).drop("_kv")

    def meta(key):  # the last line with the key wins; without one, place -1 gives null
        return F.get("_v", (F.array_position("_k", key) - 1).cast("int"))

    # the header: the first line from the ninth on with DATA in it (any case)
    found = F.when(F.col("_upper").contains("DATA"), F.size(F.split(F.substring_index("_upper", "DATA", 1), "\n")))
    df = _once(df, _state=F.upper(F.trim(F.coalesce(meta("UF"), F.lit("")))) == STATE,
               _at=F.coalesce(found, F.lit(0)), _latitude=F.coalesce(meta("LATITUDE"), F.lit("")),
               _longitude=F.coalesce(meta("LONGITUDE"), F.lit("")), _altitude=F.coalesce(meta("ALTITUDE"), F.lit("")),
               codigo_estacao=F.trim(F.coalesce(meta("CODIGO (WMO)"), meta("CODIGO"), F.lit(""))),
               nome_estacao=F.trim(F.coalesce(meta("ESTACAO"), F.lit("")))).drop("_k", "_v", "_upper")
    usable = F.col("_state") & (F.col("_at") > 0)
    above = F.expr("substring_index(_body, '\n', _at - 1)")
    rest = F.when(F.col("_at") > 1, F.substr("_body", F.length(above) + 2)).otherwise(F.col("_body"))
    df = _once(
        df.select(*[c for c in df.columns if c not in ("_latitude", "_longitude", "_altitude")],
                  *[tolerant_float(f"_{c}", null_sentinel=False).alias(c) for c in ("latitude", "longitude", "altitude")]),
        h_linha=F.when(usable, F.col("_at") + PREAMBLE_LINES - 1),
        _rest=F.when(usable, F.replace(rest, F.lit("\r\n"), F.lit("\n")))).drop("_body")
    sep = F.when(F.substring_index("_rest", "\n", 1).contains(";"), F.lit(";")).otherwise(F.lit(","))
    df = _once(_once(df, _sep=sep), registros=csv_records(F.col("_rest"), F.col("_sep"))).drop("_rest", "_sep")
    names = F.transform(csv_cells(F.get("registros", F.lit(0))), lambda c: F.upper(F.trim(csv_text(c))))
    df = _once(df, _norm=names)

    def position(aliases):  # first alias (in priority order) present; its first position
        at = [F.array_position("_norm", a.strip().upper()) for a in aliases]
        return F.coalesce(*[F.when(x > 0, x - 1) for x in at]).cast("int")

    df = _once(df, **{f"p_{k}": position(a) for k, a in HEADER_ALIASES.items()})
    status = (F.when(~F.col("_state"), F.lit(OTHER_STATE)).when(F.col("_at") == 0, F.lit(NO_HEADER))
              .when(F.col("p_data").isNull(), F.lit(NO_DATE)).otherwise(F.lit(READ)))
    return df.withColumn("situacao", status).drop("_norm", "_at", "_state")


def file_report(files: DataFrame) -> DataFrame:
    """What became of each file: (arquivo, ano, situacao, registros), registros being the
    lines after the header. One pass; a file that is not read is a row here, not an error."""
    return file_facts(files).select(
        "arquivo", "ano", "situacao",
        F.when(F.col("situacao") == READ, F.size("registros") - 1).otherwise(F.lit(0)).alias("registros"))


def folder_report(spark: SparkSession, root: str, years=YEARS) -> DataFrame:
    """``file_report`` of a folder, with a row for each listed file that could not be read
    (``situacao`` UNREADABLE): the listing, which reads no contents, without what was read.
    The contents are read once; files that are broken now may be read by a later load."""
    read = file_report(read_files(spark, root, years))
    # the length keeps the scan to the listing
    listed = _listed(spark, root, years, "length").select("arquivo", "ano")
    whole = listed.join(read.withColumnRenamed("ano", "_ano"), "arquivo", "left")
    return whole.select("arquivo", "ano", F.coalesce("situacao", F.lit(UNREADABLE)).alias("situacao"),
                        F.coalesce("registros", F.lit(0)).alias("registros"))


def read_weather_hourly(spark: SparkSession, root: str, years=YEARS) -> DataFrame:
    return hourly_from_files(read_files(spark, root, years))


def hourly_from_files(files: DataFrame) -> DataFrame:
    """Hourly readings: every record after the header; records with an empty first cell
    or an empty date are skipped. ``linha`` is the record's place, counted in lines from
    the top of the file (a quoted line break does not count)."""
    facts = file_facts(files).where(F.col("situacao") == READ)
    body = facts.select("*", F.posexplode("registros").alias("_n", "_r")).drop("registros").where("_n > 0")
    body = _once(body, linha=F.col("h_linha") + F.col("_n"), _c=csv_cells(F.col("_r"))).drop("_r")

    def cell(logical):
        return csv_text(F.get("_c", F.col(f"p_{logical}")))

    date_text = strip_ws(cell("data"))
    body = body.where((F.coalesce(F.length(strip_ws(csv_text(F.col("_c")[0]))), F.lit(0)) > 0)
                      & (F.coalesce(F.length(date_text), F.lit(0)) > 0))
    return body.select(
        "ano", "codigo_estacao", "nome_estacao", "latitude", "longitude", "altitude",
        date_text.alias("data"),
        F.coalesce(clean_clock(cell("hora")), F.lit("")).alias("hora_utc"),
        tolerant_float(cell("temp_max")).alias("temp_max_c"),
        tolerant_float(cell("temp_min")).alias("temp_min_c"),
        tolerant_float(cell("temp_med")).alias("temp_med_c"),
        tolerant_float(cell("umidade_med")).alias("umidade_pct"),
        tolerant_float(cell("precipitacao")).alias("precipitacao_mm"),
        "arquivo", "linha",
    )


def load_report(spark: SparkSession, root: str, years=YEARS) -> dict:
    """Counts the source tool printed: files found under the year folders, files of the
    state that produced readings, hourly readings, daily rows, and the years without
    files. The files' contents are read once: readings are counted per (station, day,
    file) and everything else is a sum over that; the listing is metadata only (one row
    per year)."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.{csv,CSV}").load(root).select("path"))
    tail = re.escape(root.rstrip("/").split("/")[-1])
    year = F.regexp_extract("path", f"{tail}/([0-9]{{4}})/", 1)
    per_year = {int(r[0]): r[1] for r in found.select(year.alias("y"))
                .where(F.col("y").isin(*[str(y) for y in years])).groupBy("y").count().collect()}
    counts = read_weather_hourly(spark, root, years).groupBy("codigo_estacao", "data", "arquivo").count()
    n = counts.agg(F.count_distinct("arquivo").alias("files"), F.sum("count").alias("hours"),
                   F.count_distinct(F.struct("codigo_estacao", "data")).alias("days")).first()
    return {"arquivos_encontrados": sum(per_year.values()), "arquivos_lidos": n["files"],
            "registros_horarios": n["hours"] or 0, "registros_diarios": n["days"],
            # the source warns about a year folder that is missing
            "anos_sem_arquivos": [y for y in years if y not in per_year]}
