"""

``entry(spark)`` runs the flagship query on /root/testdata/sf0.001.
``queries()`` maps each implemented operator/query to a callable
(spark, sf_dir) -> DataFrame that reads the benchmark tables (all rows).
``oracle_sql()`` gives, for the same names, independent DuckDB SQL over the
same parquet tables. Output columns are normalised for the comparison:
integers as bigint, exact decimals as double, dates as ISO text.
"""

from __future__ import annotations

import os
import sys
import uuid
import warnings
from collections.abc import Callable

# importable however this file is loaded (by path, or from another working directory)
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellata.functions.dates import parse_mixed_date
from stellata.functions.numbers import dash_to_zero, locale_number, to_decimal, tolerant_float
from stellata.functions.text import (fold_accents, ibge_code, ibge_name, starts_with_code,
                                     xml_escape)
from stellata.operators import quality
from stellata.operators.aggregates import hourly_to_daily, rows_per_group
from stellata.operators.copy_on_write import read_parts, update_parts, write_parts
from stellata.operators.gates import Check, NotNull, References, Unique, write_gated
from stellata.operators.joins import nearest_lookup
from stellata.operators.keys import dense_key
from stellata.operators.registry import register_keys, with_keys
from stellata.operators.reshape import union_all_slices, unpivot_measures, unpivot_years
from stellata.plans import bench_texts, olap, summary_states
from stellata.plans.bench_sql import QUERIES as _SQL
from stellata.plans.benchstar import (ALL_CLIMATE, BENCH_LATITUDE, BENCH_REGION, BENCH_REGION_STATION,
                                      MAPPED_CLIMATE, NO_CLIMATE, bench_star,
                                      customer_year_orders, order_years, read_tables)
from stellata.plans.star import nearest_climate, remap_climate, year_grid
from stellata.session import checkpoint_dir
from stellata.sources.batches import append_batch, read_batches
from stellata.sources.json_arrays import read_json_array
from stellata.sources.tables import GDP_FIELDS, GDP_SHEET_COLUMNS, clean_gdp_sheet, explode_xml_column

# the training-data operators are an optional part: without their folder, or without a package
# that only they need, the rest works
try:
    import corpus_pipeline
    from stellata.llm.queries import QUERIES as _LLM_QUERIES
    from stellata.llm.queries import SQL as _LLM_SQL
except ImportError as error:
    if not (error.name or "").startswith(("stellata.llm", "corpus_pipeline")):
        warnings.warn(f"the training-data queries are left out: {error}", stacklevel=1)
    _LLM_QUERIES, _LLM_SQL = {}, {}
else:
    _LLM_QUERIES = _LLM_QUERIES | {"pipeline": corpus_pipeline.run}
    if corpus_pipeline.ORACLE_SQL:
        _LLM_SQL = _LLM_SQL | {"pipeline": corpus_pipeline.ORACLE_SQL}

SMOKE_DIR = "/root/testdata/sf0.001"


def _out(df: DataFrame) -> DataFrame:
    """Normalise output types for the cross-engine comparison."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(t, T.DateType):
            c = c.cast("string")
        elif isinstance(t, T.ArrayType):
            c = F.array_join(c, ",")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _olap(fn, climate: str = NO_CLIMATE):
    """A statement on the benchmark star, planned over the tables as one lazy query."""
    return lambda spark, sf_dir: _out(fn(bench_star(spark, sf_dir, climate)))


# --- the fifteen statements on the benchmark star ---------------------------

def _period_ratio(spark, sf_dir):
    return _out(olap.period_ratio(olap.region_year_summary(bench_star(spark, sf_dir, MAPPED_CLIMATE))))


def _new_folder(spark, name):
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _summary_refreshed(keys):
    """The summary's states of all years, then those of the second year computed anew: what
    the refreshed store says by ``keys``."""
    def run(spark, sf_dir):
        star, root = bench_star(spark, sf_dir, MAPPED_CLIMATE), _new_folder(spark, "estados")
        summary_states.refresh(star, root)
        summary_states.refresh(star, root, star.extras["years"][1:2])
        return _out(summary_states.summary(spark, root, keys))
    return run


# --- reshaping ---------------------------------------------------------------

def _wide_counts(spark, sf_dir):
    t = read_tables(spark, sf_dir, ["orders"])
    years = order_years(t["orders"])
    cy = customer_year_orders(t["orders"])
    # pivot: one row per customer, one text column per year, '-' for no orders
    wide = (cy.groupBy("sk_municipio").pivot("ano", years)
            .agg(F.first(F.col("casos").cast("string")).alias("c"), F.first("valor").alias("v")))
    renamed = wide.select(
        "sk_municipio",
        *[F.coalesce(F.col(f"{y}_c"), F.lit("-")).alias(f"casos_{y}") for y in years],
        *[F.col(f"{y}_v").alias(f"valor_{y}") for y in years])
    return renamed, years


def _unpivot_years(spark, sf_dir):
    wide, years = _wide_counts(spark, sf_dir)
    long = unpivot_years(wide, ["sk_municipio"], {y: f"casos_{y}" for y in years}, "ano", "casos_raw")
    return _out(long.select("sk_municipio", "ano", dash_to_zero("casos_raw", "bigint").alias("casos_tb")))


def _union_all_slices(spark, sf_dir):
    wide, years = _wide_counts(spark, sf_dir)
    long = union_all_slices(wide, ["sk_municipio"], {y: f"casos_{y}" for y in years}, "ano", "casos_raw")
    return _out(long.select("sk_municipio", "ano", dash_to_zero("casos_raw", "bigint").alias("casos_tb")))


def _unpivot_measures(spark, sf_dir):
    wide, years = _wide_counts(spark, sf_dir)
    long = unpivot_measures(wide, ["sk_municipio"], {
        "pedidos": {y: f"casos_{y}" for y in years},
        "valor": {y: f"valor_{y}" for y in years}})
    return _out(long.select("sk_municipio", "ano", dash_to_zero("pedidos", "bigint").alias("pedidos"),
                            "valor"))


# --- weather-shaped aggregation ----------------------------------------------

def _daily_from_readings(spark, sf_dir):
    ev = read_tables(spark, sf_dir, ["events"])["events"]
    hourly = ev.select(
        F.year("ts").alias("ano"), F.col("event_type").alias("codigo_estacao"),
        F.col("user_id").cast("string").alias("nome_estacao"), F.col("value").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"), F.lit(None).cast("double").alias("altitude"),
        F.to_date("ts").cast("string").alias("data"),
        F.col("value").alias("temp_max_c"), F.col("value").alias("temp_min_c"),
        F.col("value").alias("temp_med_c"),
        F.get_json_object("props", "$.k").cast("double").alias("umidade_pct"),
        F.col("value").alias("precipitacao_mm"),
        F.lit("events").alias("arquivo"), F.col("event_id").alias("linha"))
    return _out(hourly_to_daily(hourly).drop("longitude", "altitude"))


def _yearly_climate(spark, sf_dir):
    return _out(bench_star(spark, sf_dir, ALL_CLIMATE).clima)


def _place_year_grid(spark, sf_dir):
    """The customer x year grid (rows that have no order too) with the counts of the year
    and the socio-economic row of (customer, year): joins on a code and a year."""
    t = read_tables(spark, sf_dir, ["customer", "orders"])
    years = order_years(t["orders"])
    grid = year_grid(t["customer"].select(F.col("c_custkey").alias("sk_municipio")), [(y, y) for y in years])
    cy = customer_year_orders(t["orders"])
    g = grid.join(cy, ["sk_municipio", "ano"], "left")
    return _out(g.select("sk_municipio", "ano", F.coalesce("casos", F.lit(0)).alias("casos_tb"),
                         F.col("valor").cast("decimal(20,0)").alias("pib_total")))


# --- lookups -----------------------------------------------------------------

def _nearest_lookup(spark, sf_dir):
    sup = read_tables(spark, sf_dir, ["supplier"])["supplier"]
    return _out(nearest_lookup(sup, ["s_nationkey"], "s_acctbal", BENCH_LATITUDE,
                               ["s_suppkey", "s_acctbal"], ["s_suppkey"]))


def _nearest_climate(spark, sf_dir):
    s = bench_star(spark, sf_dir, ALL_CLIMATE)
    return _out(nearest_climate(s.clima, s.estacao, BENCH_LATITUDE))


def _remap_by_mapping(spark, sf_dir):
    s = bench_star(spark, sf_dir, ALL_CLIMATE)
    near = nearest_climate(s.clima, s.estacao, BENCH_LATITUDE).select("sk_tempo", "sk_clima")
    # older load: every row gets the climate of the one station nearest the
    # reference point (one row per year: bounded)
    v1 = s.fato.drop("sk_clima").join(F.broadcast(near), "sk_tempo", "left")
    v2 = remap_climate(v1, s.municipio, s.extras["aux_regiao_estacao"], s.estacao, s.clima)
    return _out(v2.select("sk_fat", "sk_clima"))


def _station_lookup_chain(spark, sf_dir):
    s = bench_star(spark, sf_dir, MAPPED_CLIMATE, keep_unmapped=False)
    f = s.fato.join(s.clima.select("sk_clima", "temp_med_anual"), "sk_clima")
    return _out(f.select("sk_municipio", "sk_tempo", "sk_estacao", "sk_clima", "temp_med_anual"))


def _literal_mapping(spark, sf_dir):
    """The literal region -> station map (VALUES) applied to every customer
    through its nation and region."""
    t = read_tables(spark, sf_dir, ["customer", "nation", "region"])
    rmap = spark.createDataFrame(BENCH_REGION_STATION, "nm_regiao string, cd_estacao string")
    geo = (F.broadcast(t["nation"]).join(F.broadcast(t["region"]),
                                         F.col("n_regionkey") == F.col("r_regionkey"))
           .join(F.broadcast(rmap), F.col("r_name") == F.col("nm_regiao")))  # fixed sizes
    out = t["customer"].join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
    return _out(out.select("c_custkey", "r_name", "cd_estacao"))


# --- text and number cleaning ------------------------------------------------

def _accent(mode):
    def run(spark, sf_dir):
        docs = read_tables(spark, sf_dir, ["documents"])["documents"]
        return _out(docs.select("doc_id", F.md5(fold_accents("text", mode)).alias("folded_md5"),
                                F.length("text").cast("bigint").alias("n_chars")))
    return run


def _json_expand(spark, sf_dir):
    ev = read_tables(spark, sf_dir, ["events"])["events"]
    return _out(ev.select("event_id", "event_type",
                          F.from_json("props", "k bigint")["k"].alias("k")))


def _xml_expand(spark, sf_dir):
    """One XML document per customer, parsed back into rows (XMLTABLE)."""
    cust = read_tables(spark, sf_dir, ["customer"])["customer"]
    doc = F.concat(
        F.lit("<pib_municipios><municipio><municipio>"), xml_escape("c_name"),
        F.lit("</municipio><per_capita_2018>"), F.col("c_custkey").cast("string"),
        F.lit("</per_capita_2018><pib_total_2018>"), F.col("c_nationkey").cast("string"),
        F.lit("</pib_total_2018></municipio></pib_municipios>"))
    rows = explode_xml_column(cust.select(doc.alias("doc")), "doc", "municipio", GDP_FIELDS)
    return _out(rows.select("municipio", "per_capita_2018", "pib_total_2018"))


def _price_text(orders):
    return F.col("o_totalprice").cast("decimal(12,2)").cast("string")


def _tolerant_float(spark, sf_dir):
    o = read_tables(spark, sf_dir, ["orders"])["orders"]
    p = F.col("o_orderpriority")
    text = (F.when(p == "1-URGENT", F.replace(_price_text(o), F.lit("."), F.lit(",")))
            .when(p == "2-HIGH", F.concat(F.lit(" "), _price_text(o), F.lit("\t")))
            .when(p == "3-MEDIUM", F.lit("-9999,00"))
            .when(p == "4-NOT SPECIFIED", F.lit("null"))
            .otherwise(F.lit("n/a")))
    return _out(o.select("o_orderkey", tolerant_float(text).alias("leitura")))


def _locale_number(spark, sf_dir):
    o = read_tables(spark, sf_dir, ["orders"])["orders"]
    text = F.translate(F.format_number(F.col("o_totalprice").cast("decimal(12,2)"), 2), ",.", ".,")
    return _out(o.select("o_orderkey", locale_number(text, 12, 2).alias("valor")))


def _mixed_dates(spark, sf_dir):
    o = read_tables(spark, sf_dir, ["orders"])["orders"]
    p, d = F.col("o_orderpriority"), F.col("o_orderdate")
    text = (F.when(p == "1-URGENT", F.date_format(d, "yyyy-MM-dd"))
            .when(p == "2-HIGH", F.date_format(d, "yyyy/MM/dd"))
            .when(p == "3-MEDIUM", F.date_format(d, "dd/MM/yyyy"))
            .when(p == "4-NOT SPECIFIED", F.concat(F.lit(" "), F.date_format(d, "yyyy-MM-dd")))
            .otherwise(F.lit("sem data")))
    return _out(o.select("o_orderkey", parse_mixed_date(text).alias("data")))


def _code_name_split(spark, sf_dir):
    c = read_tables(spark, sf_dir, ["customer"])["customer"]
    raw = F.when(F.col("c_mktsegment") == "BUILDING", F.upper("c_name")).otherwise(
        F.concat(F.lpad(F.col("c_custkey").cast("string"), 6, "0"), F.lit(" "), F.upper("c_name")))
    r = c.select(raw.alias("municipio_raw")).where(starts_with_code("municipio_raw"))
    return _out(r.select(ibge_code("municipio_raw").alias("cd_ibge"),
                         ibge_name("municipio_raw").alias("nm_municipio")))


def _flag_label(spark, sf_dir):
    t = read_tables(spark, sf_dir, ["orders", "customer"])
    o = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
    s = F.col("o_orderstatus")
    label = (F.when(s == "F", F.lit("FINALIZADO")).when(s == "O", F.lit("ABERTO"))
             .otherwise(F.lit("PARCIAL")))
    return _out(o.select("o_orderkey", label.alias("rotulo"),
                         F.upper("o_orderpriority").alias("prioridade_texto"),
                         to_decimal(F.substring("o_orderpriority", 1, 1), 4, 0).cast("bigint").alias("prioridade"),
                         F.abs("c_acctbal").alias("saldo_abs")))


def _sheet_cleanup(spark, sf_dir):
    sup = read_tables(spark, sf_dir, ["supplier"])["supplier"]
    num = lambda mult, y: ((F.col("s_suppkey") * mult + (y - 2000)).cast("decimal(20,1)")
                           .cast("string"))
    years = (2017, 2018, 2019, 2020, 2021, 2022, 2023)
    rows = sup.select(F.col("s_name").alias("c0"),
                      *[num(100, y).alias(f"c{i + 1}") for i, y in enumerate(years)],
                      *[num(1000, y).alias(f"c{i + 8}") for i, y in enumerate(years)])
    junk = spark.createDataFrame([
        ("PRODUTO INTERNO BRUTO DOS MUNICÍPIOS",) + (None,) * 14,
        ("MUNICÍPIOS",) + tuple(str(y) for y in years) * 2,
        (None,) + ("1",) * 14,
        ("SEM TOTAL",) + ("2",) * 8 + (None,) + ("2",) * 5,
    ], ", ".join(f"c{i} string" for i in range(15)))
    sheet = rows.unionByName(junk)
    assert len(GDP_SHEET_COLUMNS) == 15
    return _out(clean_gdp_sheet(sheet))


def _distinct_names(spark, sf_dir):
    part = read_tables(spark, sf_dir, ["part"])["part"]
    return _out(part.where(F.col("p_brand").rlike("^Brand#[0-9]+$")).select("p_brand").distinct())


def _sorted_nulls_last(spark, sf_dir):
    """ORDER BY segment ASC NULLS LAST (one segment made NULL), ties by key; the
    position is written out by the dense-key operator (no single-task sort)."""
    checkpoint_dir(spark)
    cust = read_tables(spark, sf_dir, ["customer"])["customer"]
    c = cust.select("c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None))
                    .otherwise(F.col("c_mktsegment")).alias("segmento"))
    return _out(dense_key(c, ["segmento", "c_custkey"], "posicao"))


def _dense_keys(spark, sf_dir):
    checkpoint_dir(spark)
    o = read_tables(spark, sf_dir, ["orders"])["orders"]
    return _out(dense_key(o.select("o_orderkey"), ["o_orderkey"], "sk"))


def _registered_keys(spark, sf_dir):
    """Two loads into one key registry: customers outside one segment, then all of them."""
    root = _new_folder(spark, "chaves")
    cust = read_tables(spark, sf_dir, ["customer"])["customer"]
    register_keys(cust.where(F.col("c_mktsegment") != "BUILDING"), root, ["c_name"])
    keys = register_keys(cust, root, ["c_name"])
    return _out(with_keys(cust.select("c_custkey", "c_name"), keys, ["c_name"]).select("c_custkey", "sk"))


def _json_array_files(spark, sf_dir):
    """All customers as files of JSON arrays (objects with an inner object, over many lines), read
    back by many tasks."""
    path = _new_folder(spark, "catalogo")
    cust = read_tables(spark, sf_dir, ["customer"])["customer"]
    place = F.struct(F.col("c_nationkey").alias("pais"), F.concat(F.lit('}"{'), "c_mktsegment").alias("segmento"))
    doc = F.to_json(F.struct("c_custkey", "c_name", "c_acctbal", place.alias("local")))
    lots = cust.groupBy(F.floor(F.col("c_custkey") / 500)).agg(F.collect_list(doc).alias("d"))
    text = F.concat(F.lit("[\n  "), F.array_join("d", ",\n  "), F.lit("\n]"))
    lots.select(text.alias("value")).write.text(path)
    rows = read_json_array(spark, path, "c_custkey bigint, c_name string, c_acctbal double, "
                                        "local struct<pais: bigint, segmento: string>")
    return _out(rows.select("c_custkey", "c_name", "c_acctbal", "local.pais", "local.segmento"))


def _appended_batches(spark, sf_dir):
    """Orders appended in two batches, the first of which is loaded a second time."""
    root = _new_folder(spark, "lotes")
    o = read_tables(spark, sf_dir, ["orders"])["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    early = F.year("o_orderdate") < 1995
    append_batch(o.where(early), root)
    append_batch(o.where(~early), root)
    append_batch(o.where(early), root)
    return _out(read_batches(spark, root).select("o_orderkey", "o_custkey"))


def _updated_parts(spark, sf_dir):
    """Orders kept by years; those of 1995 with line items get their quantity, other years stay."""
    root = _new_folder(spark, "partes")
    t = read_tables(spark, sf_dir, ["orders", "lineitem"])
    o = t["orders"].select("o_orderkey", F.year("o_orderdate").alias("ano"))
    write_parts(o.withColumn("quantidade", F.lit(0).cast("decimal(28,2)")), root, "ano")
    value = (t["lineitem"].groupBy(F.col("l_orderkey").alias("o_orderkey"))
             .agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("quantidade")))
    guard = o.where("ano = 1995").join(value, "o_orderkey", "left_semi").select("o_orderkey", "ano")
    update_parts(spark, root, "ano", value, ["o_orderkey"], "quantidade", guard, ["o_orderkey", "ano"])
    return _out(read_parts(spark, root).select("o_orderkey", "ano", "quantidade"))


def _refused_load(spark, sf_dir):
    """What stops a load whose customers lack one segment and repeat a nation: the constraints that
    its tables break, with the number of offending rows or keys."""
    t = read_tables(spark, sf_dir, ["customer", "orders"])
    cust = t["customer"].where(F.col("c_mktsegment") != "BUILDING").select(
        "c_custkey", "c_nationkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("saldo"))
    path, found, tables = _new_folder(spark, "recusa"), [], {}
    for name, df, rules in (
            ("cliente", cust, [Unique(["c_custkey"]), Unique(["c_nationkey"]), NotNull("saldo")]),
            ("pedido", t["orders"].select("o_orderkey", "o_custkey", "o_totalprice"),
             [Unique(["o_orderkey"]), References(["o_custkey"], "cliente", ["c_custkey"]),
              Check("valor", F.col("o_totalprice") > 200000)])):
        found += write_gated(df, f"{path}/{name}", name, rules, tables)
        tables[name] = spark.read.parquet(f"{path}/{name}")
    return _out(spark.createDataFrame(found, "tabela string, restricao string, linhas bigint"))


# --- data quality -------------------------------------------------------------

def _quality_unique(spark, sf_dir):
    o = read_tables(spark, sf_dir, ["orders"])["orders"]
    k = o.select("o_custkey", F.year("o_orderdate").alias("ano"))
    return _out(quality.duplicate_keys(k, ["o_custkey", "ano"]))


def _quality_not_null(spark, sf_dir):
    """Cells blanked by rule (the tables have no nulls of their own)."""
    c = read_tables(spark, sf_dir, ["customer"])["customer"]
    k = F.col("c_custkey")
    blanked = c.select(
        "c_custkey", F.when(k % 7 > 0, F.col("c_name")).alias("c_name"),
        F.when(k % 11 > 0, F.col("c_nationkey")).alias("c_nationkey"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("c_mktsegment"))
    return _out(quality.null_counts(blanked, blanked.columns))


def _quality_foreign_keys(spark, sf_dir):
    """Some line items refer, by rule, to orders that do not exist; some to none."""
    t = read_tables(spark, sf_dir, ["lineitem", "orders"])
    k = F.col("l_orderkey")
    broken = F.when(k % 97 == 0, -k).when(k % 89 == 0, F.lit(None).cast("bigint")).otherwise(k)
    return _out(quality.orphans(t["lineitem"].select(broken.alias("l_orderkey"), "l_linenumber"), ["l_orderkey"],
                                t["orders"], ["o_orderkey"]))


def _quality_domain(spark, sf_dir):
    ev = read_tables(spark, sf_dir, ["events"])["events"]
    checks = {"json_invalido": ~quality.is_json(F.col("props")),
              "valor_fora_de_escala": ~quality.fits_decimal(F.col("value"), 4, 2),
              "tipo_longo": ~quality.fits_length(F.col("event_type"), 6)}
    return _out(quality.domain_violations(ev, checks, ["event_id"]))


def _station_row_counts(spark, sf_dir):
    t = read_tables(spark, sf_dir, ["lineitem", "supplier"])
    names = t["supplier"].select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return _out(rows_per_group(t["lineitem"], "l_suppkey", "s_name", names))


def _text_query(fn):
    return lambda spark, sf_dir: _out(fn(spark, sf_dir))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: yearly totals (query 1) on the smallest benchmark star."""
    return _olap(olap.yearly_totals)(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "yearly_totals": _olap(olap.yearly_totals),
        "top10_places": _olap(olap.top_places),
        "risk_and_income_bands": _olap(olap.risk_and_income_bands),
        "year_over_year": _olap(olap.year_over_year),
        "rank_quartile_share": _olap(olap.rank_quartile_share),
        "rank_quartile_share_all": _olap(olap.rank_quartile_share_of_all),
        "moving_avg_running_sum": _olap(olap.moving_avg_running_sum),
        "rollup_region_year": _olap(olap.rollup_region_year),
        "cube_period_band": _olap(olap.cube_period_band),
        "grouping_sets_year_region": _olap(olap.grouping_sets_year_region),
        "wide_view": _olap(olap.wide_view, MAPPED_CLIMATE),
        "region_year_summary": _olap(olap.region_year_summary, MAPPED_CLIMATE),
        "xml_report": _olap(olap.xml_report),
        "json_rows": _olap(olap.json_rows, MAPPED_CLIMATE),
        "with_region_mean": _olap(lambda s: olap.with_region_mean(s, BENCH_REGION), MAPPED_CLIMATE),
        "above_region_mean": _olap(lambda s: olap.above_region_mean(s, BENCH_REGION), MAPPED_CLIMATE),
        "period_ratio": _period_ratio,
        "unpivot_years": _unpivot_years,
        "union_all_slices": _union_all_slices,
        "unpivot_measures": _unpivot_measures,
        "daily_from_readings": _daily_from_readings,
        "yearly_climate": _yearly_climate,
        "place_year_grid": _place_year_grid,
        "nearest_lookup": _nearest_lookup,
        "nearest_climate": _nearest_climate,
        "remap_by_mapping": _remap_by_mapping,
        "station_lookup_chain": _station_lookup_chain,
        "literal_mapping": _literal_mapping,
        "accent_fold_correct": _accent("correct"),
        "accent_fold_compat": _accent("compat"),
        "json_expand": _json_expand,
        "xml_expand": _xml_expand,
        "tolerant_float": _tolerant_float,
        "locale_number": _locale_number,
        "mixed_dates": _mixed_dates,
        "code_name_split": _code_name_split,
        "flag_label": _flag_label,
        "sheet_cleanup": _sheet_cleanup,
        "distinct_names": _distinct_names,
        "sorted_nulls_last": _sorted_nulls_last,
        "dense_keys": _dense_keys,
        "quality_unique": _quality_unique,
        "quality_not_null": _quality_not_null,
        "quality_foreign_keys": _quality_foreign_keys,
        "quality_domain": _quality_domain,
        "station_row_counts": _station_row_counts,
        "registered_keys": _registered_keys,
        "appended_batches": _appended_batches,
        "updated_parts": _updated_parts,
        "refused_load": _refused_load,
        "json_array_files": _json_array_files,
        "summary_refreshed": _summary_refreshed(summary_states.KEYS),
        "summary_by_region": _summary_refreshed(["regiao"]),
        **{name: _text_query(fn) for name, fn in bench_texts.QUERIES.items()},
        **_LLM_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    return {**_SQL, **_LLM_SQL}
