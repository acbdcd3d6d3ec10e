"""Raw inputs of the loaders, written as text from the benchmark tables by fixed rules, so
that the readers run on data that grows with them; and the queries over those texts.

Rules use the row's key, so SQL over the tables can say what must come out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellata.operators.aggregates import hourly_to_daily
from stellata.operators.joins import update_where_exists
from stellata.functions.text import accent_key
from stellata.plans import warehouse
from stellata.plans.benchstar import read_tables
from stellata.plans.star import (GDP_EXCLUDED_NAMES, TIME_SEED, cases_long, dim_socioeconomico, dim_tempo)
from stellata.sources.tables import (DAILY_WEATHER_COLUMNS, DENSITY_COLUMNS, GDP_FIELDS, STATION_FIELDS, YEARS,
                                     explode_json_column)
from stellata.sources.weather import HEADER_ALIASES, file_report, hourly_from_files

# Fixed values of the rules: which orders make files without a header, of another state,
# and files with this many more columns.
NO_HEADER_EVERY, OTHER_STATE_EVERY, WIDE_EVERY, EXTRA_COLUMNS = 17, 19, 5, 30
FIRST_ORDER_YEAR = 1992


def weather_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(arquivo, ano, texto): one small weather file per order, its line items (seven at
    most) as hours. Separator, spelling and order of the header, decimal marks, quotes,
    notes before the header and extra columns vary with the order's key."""
    t = read_tables(spark, sf_dir, ["orders", "lineitem"])
    k = F.col("o_orderkey")
    semicolon = k % 2 == 0
    number = lambda c: c.cast("decimal(12,2)").cast("string")

    def marked(text):  # decimal comma; where the separator is a comma, in quotes
        comma = F.replace(text, F.lit("."), F.lit(","))
        return F.when(semicolon, comma).when(k % 3 == 0, F.concat(F.lit('"'), comma, F.lit('"'))).otherwise(text)

    n, quantity, discount = F.col("l_linenumber"), F.col("l_quantity"), F.col("l_discount")
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    cells = {
        "data": F.when(semicolon, day).otherwise(F.replace(day, F.lit("-"), F.lit("/"))),
        "hora": F.concat(F.lpad((n * 100).cast("string"), 4, "0"), F.lit(" UTC")),
        "temp_max": marked(number(quantity)), "temp_min": marked(number(discount)),
        "temp_med": marked(number(F.col("l_tax"))),
        "umidade_med": F.when(n % 3 == 0, F.lit("-9999")).otherwise(marked(number(quantity))),
        "precipitacao": F.when(n % 4 == 0, F.lit("")).otherwise(marked(number(discount))),
    }
    names = list(HEADER_ALIASES)

    def turned(values):  # the columns rotated by the key, after the extra ones if any
        ways = [F.array(*values[i:], *values[:i]) for i in (0, 2, 4)]
        return F.when(k % 3 == 0, ways[0]).when(k % 3 == 1, ways[1]).otherwise(ways[2])

    def line(values, filler):
        extra = F.when(k % WIDE_EVERY == 0, F.array_repeat(F.lit(filler), EXTRA_COLUMNS)).otherwise(
            F.array().cast("array<string>"))
        return F.call_function("concat_ws", F.when(semicolon, F.lit(";")).otherwise(F.lit(",")), extra, turned(values))

    def spelled(logical):
        spellings = HEADER_ALIASES[logical]
        name = F.element_at(F.array(*[F.lit(a) for a in spellings]), (k % len(spellings) + 1).cast("int"))
        return F.when(name.contains(",") & ~semicolon, F.concat(F.lit('"'), name, F.lit('"'))).otherwise(name)

    rows = t["lineitem"].join(t["orders"], F.col("l_orderkey") == k)
    own = ["o_orderkey", "o_custkey", F.year("o_orderdate").alias("ano")]
    # the cells first: a line names each of them in every order of the columns
    lines = rows.select(*own, "l_linenumber", *[cells[c].alias(c) for c in names]).select(
        "o_orderkey", "o_custkey", "ano", "l_linenumber", line([F.col(c) for c in names], "x").alias("_line"))
    files = lines.groupBy("o_orderkey", "o_custkey", "ano").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "_line"))), lambda s: s["_line"]).alias("_body"))
    c = F.col("o_custkey")
    pre = F.array(
        F.lit("REGIAO:;S"),
        F.concat(F.lit("UF:;"), F.when(k % OTHER_STATE_EVERY == 0, F.lit("SC")).otherwise(F.lit("PR"))),
        F.concat(F.lit("ESTACAO:;E"), c.cast("string")),
        F.concat(F.lit("CODIGO (WMO):;A"), (c % 900 + 100).cast("string")),
        F.concat(F.lit("LATITUDE:;-"), (c % 30).cast("string"), F.lit(",5")),
        F.concat(F.lit("LONGITUDE:;-"), (c % 50).cast("string"), F.lit(",25")),
        F.concat(F.lit("ALTITUDE:;"), (c % 1000).cast("string")), F.lit("FUNDACAO:;22/05/06"))
    notes = F.array_repeat(F.lit("nota;"), (k % 4).cast("int"))
    header = F.when(k % NO_HEADER_EVERY == 0, F.array().cast("array<string>")).otherwise(
        F.array(line([F.col(x) for x in names], "EXTRA")))
    files = files.select("*", *[spelled(x).alias(x) for x in names])
    return files.select(F.concat(F.lit("pedido-"), k.cast("string")).alias("arquivo"), "ano",
                        F.array_join(F.concat(pre, notes, header, "_body"), "\r\n").alias("texto"))


def weather_hourly(spark, sf_dir):
    # without the place of a line: line numbers repeat in the tables
    return hourly_from_files(weather_files(spark, sf_dir)).drop("linha")


def weather_daily(spark, sf_dir):
    return hourly_to_daily(hourly_from_files(weather_files(spark, sf_dir)))


def weather_file_report(spark, sf_dir):
    return file_report(weather_files(spark, sf_dir))


# --- joins on names and codes ------------------------------------------------------

def _accented(name, key):
    """Some letters accented, which ones by the key."""
    return (F.when(key % 3 == 0, F.replace(name, F.lit("o"), F.lit("õ")))
            .when(key % 3 == 1, F.replace(name, F.lit("u"), F.lit("á"))).otherwise(name))


def accent_join(mode: str):
    """Customers under accented names, looked up on the accent-folded name."""
    def run(spark, sf_dir):
        c = read_tables(spark, sf_dir, ["customer"])["customer"]
        plain = c.select(accent_key("c_name", mode).alias("k"), F.col("c_nationkey").alias("nationkey"))
        spelled = c.select("c_custkey", accent_key(_accented(F.col("c_name"), F.col("c_custkey")), mode).alias("k"))
        return spelled.join(plain, "k", "left").select("c_custkey", F.col("k").alias("chave"), "nationkey")
    return run


def _orders_per_year(t):
    """Wide counts of orders per customer for the first years, '-' for none."""
    year = F.year("o_orderdate")
    counts = t["orders"].groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        *[F.count(F.when(year == FIRST_ORDER_YEAR + i, F.lit(1))).alias(f"n{i}") for i in range(len(YEARS))])
    text = lambda i: F.when(F.col(f"n{i}") > 0, F.col(f"n{i}").cast("string")).otherwise(F.lit("-"))
    return t["customer"].join(counts, "c_custkey", "left").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal",
        *[text(i).alias(f"casos_{y}") for i, y in enumerate(YEARS)])


def code_year_join(spark, sf_dir):
    """A case file whose rows are coded names, made long and joined to the places on the
    code and to the calendar on the year; rows without a code do not take part."""
    t = read_tables(spark, sf_dir, ["customer", "orders"])
    wide = _orders_per_year(t)
    code = F.lpad(F.col("c_custkey").cast("string"), 6, "0")
    raw = F.when(F.col("c_custkey") % 7 == 0, F.col("c_name")).otherwise(F.concat(code, F.lit(" "), F.col("c_name")))
    cases = wide.select(raw.alias("municipio_raw"), *[f"casos_{y}" for y in YEARS])
    places = t["customer"].select(code.alias("cd_ibge"), F.col("c_custkey").alias("sk_municipio"))
    return (cases_long(cases).join(places, "cd_ibge").join(F.broadcast(dim_tempo(spark)), "ano")  # six years
            .select("cd_ibge", "sk_municipio", "sk_tempo", "casos_tb"))


def name_exclusion(spark, sf_dir):
    """The socio-economic load: GDP and density joined on the accent-folded name and the
    year, without the rows of the state and of repeated headers."""
    t = read_tables(spark, sf_dir, ["customer"])
    c, k = t["customer"], F.col("c_custkey")
    name = F.when(k % 50 == 0, F.lit(GDP_EXCLUDED_NAMES[0])).when(k % 50 == 1, F.lit(GDP_EXCLUDED_NAMES[1])) \
        .otherwise(F.col("c_name"))
    value = lambda i, per: (k * per + i).cast("string")
    gdp = c.select(name.alias("municipio"), *[value(i, 10).alias(f"per_capita_{y}") for i, y in enumerate(YEARS)],
                   *[value(i, 1000).alias(f"pib_total_{y}") for i, y in enumerate(YEARS)]).select(*GDP_FIELDS)
    density = c.where(k % 3 > 0).select(
        F.upper("c_name").alias("municipio"), F.lit(None).cast("string").alias("regiao"),
        *[((k % 1000 + i) / 4).cast("decimal(10,2)").alias(f"dens_{y}") for i, y in enumerate(YEARS)])
    places = c.select(k.alias("sk_municipio"), _accented(F.col("c_name"), k).alias("nm_municipio"))
    return dim_socioeconomico(places, [(sk, y) for sk, y, _ in TIME_SEED], gdp, density)


def update_from_orders(spark, sf_dir):
    """UPDATE customer SET c_acctbal = its order value of 1995 WHERE EXISTS an order."""
    t = read_tables(spark, sf_dir, ["customer", "orders"])
    value = (t["orders"].where(F.year("o_orderdate") == 1995).groupBy(F.col("o_custkey").alias("c_custkey"))
             .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("c_acctbal")))
    target = t["customer"].select("c_custkey", F.col("c_acctbal").cast("decimal(28,2)").alias("c_acctbal"))
    guard = t["orders"].select(F.col("o_custkey").alias("c_custkey"))
    return update_where_exists(target, value, ["c_custkey"], "c_acctbal", guard, ["c_custkey"])


def json_array_expand(spark, sf_dir):
    """One JSON array per order (its line items, seven at most), taken apart into rows."""
    li = read_tables(spark, sf_dir, ["lineitem"])["lineitem"]
    item = F.struct(F.col("l_linenumber").cast("string").alias("linha"),
                    F.col("l_quantity").cast("decimal(12,2)").cast("string").alias("quantidade"))
    docs = li.groupBy("l_orderkey").agg(F.to_json(F.collect_list(item)).alias("doc"))
    return explode_json_column(docs, "doc", ["linha", "quantidade"], keep=["l_orderkey"])


# --- rejects -----------------------------------------------------------------------

def loader_rejects(spark, sf_dir):
    """The rejects of every loader, on texts with a bad cell in some rows."""
    t = read_tables(spark, sf_dir, ["orders", "customer", "supplier"])
    o, k = t["orders"], F.col("o_orderkey")
    good = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    daily = {c: F.lit("1.50") for c in DAILY_WEATHER_COLUMNS} | {
        "ano": F.when(k % 23 == 0, F.lit("MCMXCV")).otherwise(F.lit("1995")),
        "codigo_estacao": F.concat(F.lit("A"), k.cast("string")), "nome_estacao": F.lit("x"),
        "data": F.when(k % 29 == 0, F.lit("31/02/1995")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")),
        "temp_med_c": F.when(k % 31 == 0, F.lit("12,5")).otherwise(F.lit(" 12.5 ")),
        "precipitacao_mm": good, "umidade_med_pct": F.lit("")}
    daily = o.select(*[daily[c].alias(c) for c in DAILY_WEATHER_COLUMNS])
    c, ck = t["customer"], F.col("c_custkey")
    dens = c.select(F.col("c_name").alias("municipio"), F.lit("r").alias("regiao"), *[
        F.when(ck % (37 + i) == 0, F.lit("n/d")).otherwise(F.lit("1.25")).alias(n)
        for i, n in enumerate(DENSITY_COLUMNS[2:])])
    raw = c.select(F.col("c_name").alias("municipio"), F.lit("r").alias("regiao"), *[
        F.when(ck % (41 + i) == 0, F.lit("-")).otherwise(F.lit("1.234,56")).alias(n)
        for i, n in enumerate(DENSITY_COLUMNS[2:])])
    s, sk = t["supplier"], F.col("s_suppkey")
    fixed = {f: F.lit("x") for f in STATION_FIELDS} | {
        "CD_ESTACAO": F.concat(F.lit("S"), sk.cast("string")),
        "VL_LATITUDE": F.when(sk % 5 == 0, F.lit("24S")).otherwise(F.lit("-24.5")),
        "VL_LONGITUDE": F.lit(None).cast("string"), "VL_ALTITUDE": F.when(sk % 7 == 0, F.lit("1e9")).otherwise(F.lit("9"))}
    stations = s.select(*[fixed[f].alias(f) for f in STATION_FIELDS])
    return (warehouse.daily_weather_rejects(daily).unionByName(warehouse.density_rejects(dens))
            .unionByName(warehouse.raw_density_rejects(raw)).unionByName(warehouse.station_rejects(stations)))


QUERIES = {
    "weather_hourly": weather_hourly,
    "weather_daily": weather_daily,
    "weather_file_report": weather_file_report,
    "accent_join_correct": accent_join("correct"),
    "accent_join_compat": accent_join("compat"),
    "code_year_join": code_year_join,
    "name_exclusion": name_exclusion,
    "update_from_orders": update_from_orders,
    "json_array_expand": json_array_expand,
    "loader_rejects": loader_rejects,
}
