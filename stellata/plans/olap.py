"""The fifteen analytic statements over a :class:`Star`.

Each function returns a DataFrame (lazy). Joins to the time dimension are
broadcast (a handful of years); other dimensions are plain joins that adaptive
execution broadcasts when measured small. Rankings use explicit tie-breaks so
the results are deterministic. Where the statement sorts, the returned
DataFrame is sorted the same way (Oracle NULL placement spelled out).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellata.functions.numbers import avg_half_up, ratio_half_up
from stellata.functions.text import number_text
from stellata.operators.export import json_object, xml_document, xml_rows
from stellata.operators.joins import semi_join_top
from stellata.operators.windows import (
    change_vs_previous,
    moving_average_running_sum,
    rank_quartile_share_all,
    top_k_rank_quartile_share,
    with_group_mean,
)
from stellata.plans.star import Star

# ---------------------------------------------------------------------------
# Labels printed by the statements.
RISK_LABELS = ("Sem casos", "Baixo (1-5)", "Moderado (6-20)", "Alto (>20)")
INCOME_LABELS = ("Sem dado", "PIB baixo (<20k)", "PIB medio (20-40k)", "PIB alto (>40k)")
INCOME_BANDS = ("Sem dado", "PIB baixo", "PIB medio", "PIB alto")
INCOME_LIMITS = (20000, 40000)
PERIOD_LABELS = ("Pandemia (2020-2022)", "Pre/Pos-Pandemia")
ROLLUP_TOTALS = ("TOTAL GERAL", "TODOS OS ANOS")
CUBE_TOTALS = ("TODOS", "TODAS")
SETS_TOTAL = "---"
NO_REGION = "Nao informado"
NOT_AVAILABLE = "N/D"
XML_ROOT, XML_TITLE, XML_ROW = "relatorio_tb", "Tuberculose Parana 2018-2023", "municipio"
EXAMPLE_REGION = "RGI de Londrina"
# ---------------------------------------------------------------------------


def _fm(star: Star) -> DataFrame:
    return star.fato.join(star.municipio, "sk_municipio")


def _ft(star: Star, fact: DataFrame | None = None) -> DataFrame:
    f = star.fato if fact is None else fact
    return f.join(F.broadcast(star.tempo), "sk_tempo")


# The socio-economic row of a fact row is the one of its (municipality, year):
# its key is built from that pair, so joining on the pair is the same join and
# lets the bucketed star tables meet without a shuffle.
SOCIO_KEYS = ["sk_municipio", "sk_tempo"]


def _socio(star: Star, *cols: str) -> DataFrame:
    return star.socio.select(*SOCIO_KEYS, *cols)


def _clima(star: Star, *cols: str) -> tuple[DataFrame, bool]:
    """Climate rows to join to the fact, and whether they are bounded.

    A star built by ``star.fact`` (it carries its region map) takes every climate
    key from the region -> station lookup, so the rows the fact can reference are
    those of the mapped stations: at most (map rows × years), a bound fixed by
    the literal map. They are found with a broadcast semi-join against the map
    and then broadcast themselves. Without a map, the whole table is joined and
    adaptive execution decides."""
    c = star.clima.select("sk_clima", "sk_estacao", *cols)
    mapped = _mapped_stations(star)
    if mapped is None:
        return c, False
    return c.join(F.broadcast(mapped.select("sk_estacao")), "sk_estacao", "left_semi"), True


def _mapped_stations(star: Star) -> DataFrame | None:
    """Stations named by the star's literal region map (None without a map): one per
    code, the smallest key, so at most one per map row."""
    rmap = star.extras.get("aux_regiao_estacao")
    if rmap is None:
        return None
    named = star.estacao.join(F.broadcast(rmap.select("cd_estacao").distinct()), "cd_estacao", "left_semi")
    row = F.struct("sk_estacao", "nm_estacao")
    return named.groupBy("cd_estacao").agg(F.min(row).alias("r")).select("cd_estacao", "r.*")


def _join_clima(f: DataFrame, star: Star, *cols: str) -> DataFrame:
    c, bounded = _clima(star, *cols)
    c = c.drop("sk_estacao") if "sk_estacao" not in cols else c
    return f.join(F.broadcast(c) if bounded else c, "sk_clima", "left")


def _income_band(pib, labels=INCOME_LABELS):
    lo, hi = INCOME_LIMITS
    return (F.when(pib.isNull(), F.lit(labels[0])).when(pib < lo, F.lit(labels[1]))
            .when(pib < hi, F.lit(labels[2])).otherwise(F.lit(labels[3])))


# 1 --------------------------------------------------------------------------
def yearly_totals(star: Star) -> DataFrame:
    """Cases per year and the number of municipalities with cases."""
    f = _ft(star, star.fato.where(F.col("casos_tb") > 0))
    return (f.groupBy("ano", "pandemia")
            .agg(F.sum("casos_tb").alias("total_casos"),
                 F.count_distinct("sk_municipio").alias("municipios_com_casos"))
            .orderBy("ano"))


# 2 --------------------------------------------------------------------------
def _by_place(star: Star, *aggregates, fact: DataFrame | None = None) -> DataFrame:
    """One row per municipality name and region: the fact is collapsed to one row per
    municipality first, names come after."""
    return ((star.fato if fact is None else fact).groupBy("sk_municipio").agg(*aggregates)
            .join(star.municipio.select("sk_municipio", "nm_municipio", "nm_regiao"), "sk_municipio"))


def place_totals(star: Star) -> DataFrame:
    return (_by_place(star, F.sum("casos_tb").alias("_casos")).groupBy("nm_municipio", "nm_regiao")
            .agg(F.sum("_casos").alias("total_casos")))


def top_places(star: Star, k: int = 10) -> DataFrame:
    """The k municipalities with most cases over all years (ties by name)."""
    return place_totals(star).orderBy(F.col("total_casos").desc_nulls_first(),
                                      F.col("nm_municipio").asc_nulls_last(),
                                      F.col("nm_regiao").asc_nulls_last()).limit(k)


# 3 --------------------------------------------------------------------------
def risk_and_income_bands(star: Star) -> DataFrame:
    """Risk band of total cases, income band of the highest GDP per capita and
    the mean density as text ('N/D' when unknown)."""
    f = star.fato.join(_socio(star, "pib_per_capita", "dens_demografica"), SOCIO_KEYS, "left")
    f = _by_place(star, F.sum("casos_tb").alias("_casos"), F.max("pib_per_capita").alias("_pib"),
                  F.sum("dens_demografica").alias("_dens"), F.count("dens_demografica").alias("_n"), fact=f)
    total = F.sum("_casos")
    risk = (F.when(total == 0, F.lit(RISK_LABELS[0]))
            .when(total.between(1, 5), F.lit(RISK_LABELS[1]))
            .when(total.between(6, 20), F.lit(RISK_LABELS[2]))
            .when(total > 20, F.lit(RISK_LABELS[3])))
    g = f.groupBy("nm_municipio", "nm_regiao").agg(
        total.alias("total_casos"),
        risk.alias("categoria_risco"),
        _income_band(F.max("_pib")).alias("faixa_pib"),
        F.coalesce(number_text(ratio_half_up(F.sum("_dens"), F.sum("_n"), 2, 2)), F.lit(NOT_AVAILABLE))
        .alias("dens_media"))
    return g.orderBy(F.col("total_casos").desc_nulls_first(), F.col("nm_municipio").asc_nulls_last(),
                     F.col("nm_regiao").asc_nulls_last())


# 4 --------------------------------------------------------------------------
def year_over_year(star: Star) -> DataFrame:
    """Yearly totals with the previous year's total and the change."""
    series = _ft(star).groupBy("ano").agg(F.sum("casos_tb").alias("total_casos"))
    return change_vs_previous(series, "ano", "total_casos").orderBy("ano")


# 5 --------------------------------------------------------------------------
def rank_quartile_share(star: Star, k: int = 20) -> DataFrame:
    """Top k municipalities with RANK, NTILE(4) and share of all cases."""
    out = top_k_rank_quartile_share(place_totals(star), "total_casos",
                                    ["nm_municipio", "nm_regiao"], k)
    return out.select("nm_municipio", "nm_regiao", "total_casos", "ranking", "quartil",
                      "pct_do_total").orderBy("ranking", F.col("nm_municipio").asc_nulls_last(),
                                              F.col("nm_regiao").asc_nulls_last())


def rank_quartile_share_of_all(star: Star) -> DataFrame:
    """The same for every municipality."""
    out = rank_quartile_share_all(place_totals(star), "total_casos", ["nm_municipio", "nm_regiao"])
    return out.select("nm_municipio", "nm_regiao", "total_casos", "ranking", "quartil", "pct_do_total")


# 6 --------------------------------------------------------------------------
def moving_avg_running_sum(star: Star, k: int = 5) -> DataFrame:
    """3-year centred moving average and running sum for the k municipalities
    (by name) with most cases."""
    base = _ft(star, _fm(star)).select("sk_municipio", "nm_municipio", "ano", "casos_tb")
    top = (_by_place(star, F.sum("casos_tb").alias("_casos")).groupBy("nm_municipio")
           .agg(F.sum("_casos").alias("total"))
           .orderBy(F.col("total").desc_nulls_first(), F.col("nm_municipio").asc_nulls_last())
           .limit(k))
    sel = semi_join_top(base, top, ["nm_municipio"])
    out = moving_average_running_sum(sel, "sk_municipio", "ano", "casos_tb")
    return (out.select("nm_municipio", "ano", "casos_tb", "media_movel_3anos", "acumulado")
            .orderBy("nm_municipio", "ano"))


# 7 --------------------------------------------------------------------------
def rollup_region_year(star: Star) -> DataFrame:
    """ROLLUP(region, year) with GROUPING flags; the labels hide NULL keys, the
    flags tell a NULL region group from the grand total."""
    f = _ft(star, _fm(star))
    g = f.rollup("nm_regiao", "ano").agg(
        F.sum("casos_tb").alias("total_casos"),
        avg_half_up("casos_tb").alias("media_por_municipio"),
        F.max("casos_tb").alias("max_casos"),
        F.grouping("nm_regiao").alias("grp_regiao"),
        F.grouping("ano").alias("grp_ano"))
    out = g.select(
        F.coalesce("nm_regiao", F.lit(ROLLUP_TOTALS[0])).alias("regiao"),
        F.coalesce(F.col("ano").cast("string"), F.lit(ROLLUP_TOTALS[1])).alias("ano"),
        "total_casos", "media_por_municipio", "max_casos", "grp_regiao", "grp_ano",
        F.col("nm_regiao").alias("_r"), F.col("ano").alias("_a"))
    return (out.orderBy("grp_regiao", "grp_ano", F.col("_r").asc_nulls_last(),
                        F.col("_a").asc_nulls_last()).drop("_r", "_a"))


# 8 --------------------------------------------------------------------------
def cube_period_band(star: Star) -> DataFrame:
    """CUBE(period, income band): cases and distinct municipalities."""
    f = _ft(star).join(_socio(star, "pib_per_capita"),
                       SOCIO_KEYS, "left")
    f = f.select("sk_municipio", F.col("casos_tb").alias("total_casos"),
                 F.when(F.col("pandemia") == "S", F.lit(PERIOD_LABELS[0]))
                 .otherwise(F.lit(PERIOD_LABELS[1])).alias("periodo"),
                 _income_band(F.col("pib_per_capita"), INCOME_BANDS).alias("faixa_pib"))
    # one row per (municipality, period, band) first; a municipality then counts once in
    # each combination it has, so only sums and counts of a few groups are exchanged
    per = f.groupBy("sk_municipio", "periodo", "faixa_pib").agg(F.sum("total_casos").alias("n"))
    own = per.groupBy("sk_municipio").agg(F.collect_list(F.struct("periodo", "faixa_pib", "n")).alias("c"))
    none = F.lit(None).cast("string")
    combos = F.concat(
        F.col("c"),
        F.transform("c", lambda x: F.struct(x["periodo"].alias("periodo"), none.alias("faixa_pib"), x["n"].alias("n"))),
        F.transform("c", lambda x: F.struct(none.alias("periodo"), x["faixa_pib"].alias("faixa_pib"), x["n"].alias("n"))),
        F.transform("c", lambda x: F.struct(none.alias("periodo"), none.alias("faixa_pib"), x["n"].alias("n"))))
    seen = lambda x, i: F.size(F.filter(F.slice("all", 1, i), lambda y:
                               y["periodo"].eqNullSafe(x["periodo"]) & y["faixa_pib"].eqNullSafe(x["faixa_pib"]))) == 0
    rows = own.select(combos.alias("all")).select(F.inline(F.transform("all", lambda x, i: F.struct(
        x["periodo"].alias("periodo"), x["faixa_pib"].alias("faixa_pib"), x["n"].alias("n"),
        seen(x, i).cast("long").alias("once")))))
    g = rows.groupBy("periodo", "faixa_pib").agg(F.sum("n").alias("total_casos"), F.sum("once").alias("municipios"))
    out = g.select(F.coalesce("periodo", F.lit(CUBE_TOTALS[0])).alias("periodo_pandemia"),
                   F.coalesce("faixa_pib", F.lit(CUBE_TOTALS[1])).alias("faixa_pib"),
                   "total_casos", "municipios", F.col("periodo").alias("_p"))
    return out.orderBy(F.col("_p").asc_nulls_last(), F.col("faixa_pib").asc_nulls_last()).drop("_p")


# 9 --------------------------------------------------------------------------
def grouping_sets_year_region(star: Star) -> DataFrame:
    """GROUPING SETS ((year), (region)) — no grand total."""
    f = _ft(star, _fm(star))
    g = f.groupingSets([["ano"], ["nm_regiao"]], "ano", "nm_regiao").agg(
        F.sum("casos_tb").alias("total_casos"),
        F.grouping("ano").alias("grp_ano"),
        F.grouping("nm_regiao").alias("grp_regiao"))
    out = g.select(F.coalesce(F.col("ano").cast("string"), F.lit(SETS_TOTAL)).alias("ano"),
                   F.coalesce("nm_regiao", F.lit(SETS_TOTAL)).alias("regiao"),
                   "total_casos", "grp_ano", "grp_regiao",
                   F.col("ano").alias("_a"), F.col("nm_regiao").alias("_r"))
    return (out.orderBy("grp_ano", "grp_regiao", F.col("_a").asc_nulls_last(),
                        F.col("_r").asc_nulls_last()).drop("_a", "_r"))


# 10 -------------------------------------------------------------------------
def wide_view(star: Star) -> DataFrame:
    """Fact with every dimension attribute (the view ``vw_municipio_tb``)."""
    f = (_ft(star, _fm(star))
         .join(_socio(star, "pib_per_capita", "pib_total",
                                 "dens_demografica"), SOCIO_KEYS, "left"))
    clima, bounded = _clima(star, "temp_max_anual", "temp_min_anual", "temp_med_anual",
                            "umidade_med_anual", "precipitacao_total", "dias_chuva")
    # station name of each climate row; with a map, only mapped stations can occur
    st = _mapped_stations(star) if bounded else star.estacao
    st = st.select("sk_estacao", F.col("nm_estacao").alias("estacao_referencia"))
    clima = clima.join(F.broadcast(st) if bounded else st, "sk_estacao", "left")
    f = f.join(F.broadcast(clima) if bounded else clima, "sk_clima", "left")
    return f.select("cd_ibge", "nm_municipio", "nm_regiao", "ano", "pandemia", "casos_tb",
                    "pib_per_capita", "pib_total", "dens_demografica", "temp_max_anual",
                    "temp_min_anual", "temp_med_anual", "umidade_med_anual",
                    "precipitacao_total", "dias_chuva", "estacao_referencia")


# 11 -------------------------------------------------------------------------
def summary_rows(star: Star) -> DataFrame:
    """The fact with what the summary reads of its dimensions."""
    f = (_ft(star, _fm(star))
         .join(_socio(star, "pib_per_capita", "dens_demografica"), SOCIO_KEYS, "left"))
    return _join_clima(f, star, "temp_med_anual", "umidade_med_anual", "precipitacao_total")


def region_year_summary(star: Star) -> DataFrame:
    """Region × year summary (the materialized view ``mv_regiao_ano``)."""
    f = summary_rows(star)
    return f.groupBy(F.coalesce("nm_regiao", F.lit(NO_REGION)).alias("regiao"), "ano",
                     "pandemia").agg(
        F.count_distinct("sk_municipio").alias("qtd_municipios"),
        F.sum("casos_tb").alias("total_casos"),
        avg_half_up("casos_tb").alias("media_casos"),
        avg_half_up("pib_per_capita", 2, 2).alias("pib_medio"),
        avg_half_up("dens_demografica", 2, 2).alias("dens_media"),
        avg_half_up("temp_med_anual", 2, 2).alias("temp_media"),
        avg_half_up("umidade_med_anual", 2, 2).alias("umidade_media"),
        avg_half_up("precipitacao_total", 2, 2).alias("precipitacao_media"))


def region_year_cases(star: Star) -> DataFrame:
    """The columns of the summary that statement 15 reads, when there is no summary."""
    f = _ft(star, star.fato.groupBy("sk_municipio", "sk_tempo").agg(F.sum("casos_tb").alias("casos_tb")))
    f = f.join(star.municipio.select("sk_municipio", "nm_regiao"), "sk_municipio")
    return f.groupBy(F.coalesce("nm_regiao", F.lit(NO_REGION)).alias("regiao"), "ano", "pandemia").agg(
        F.sum("casos_tb").alias("total_casos"))


# 12 -------------------------------------------------------------------------
def xml_report(star: Star, k: int = 10) -> DataFrame:
    """One XML document with the k municipalities with most cases."""
    f = star.fato.join(_socio(star, "pib_per_capita"), SOCIO_KEYS, "left")
    f = _by_place(star, F.sum("casos_tb").alias("_casos"), F.sum("pib_per_capita").alias("_pib"),
                  F.count("pib_per_capita").alias("_n"), fact=f)
    g = f.groupBy("nm_municipio", "nm_regiao").agg(
        F.sum("_casos").alias("total_casos"),
        ratio_half_up(F.sum("_pib"), F.sum("_n"), 0, 2).alias("pib_medio"))
    element = xml_rows(g, XML_ROW, [
        ("nome", F.col("nm_municipio")),
        ("regiao", F.coalesce("nm_regiao", F.lit(NOT_AVAILABLE))),
        ("total_casos", number_text("total_casos")),
        ("pib_medio", F.coalesce(number_text("pib_medio"), F.lit(NOT_AVAILABLE)))])
    return xml_document(g, XML_ROOT, {"titulo": XML_TITLE}, element,
                        [-F.col("total_casos"), F.col("nm_municipio"), F.col("nm_regiao")], k)


# 13 -------------------------------------------------------------------------
def json_rows(star: Star) -> DataFrame:
    """One JSON object per year with cases and mean climate."""
    f = _join_clima(_ft(star), star, "temp_med_anual", "umidade_med_anual", "precipitacao_total")
    g = f.groupBy("ano", "pandemia").agg(
        F.sum("casos_tb").alias("total_casos"),
        F.count(F.when(F.col("casos_tb") > 0, F.lit(1))).alias("municipios_afetados"),
        avg_half_up("temp_med_anual", 2, 2).alias("temp_media_pr"),
        avg_half_up("umidade_med_anual", 2, 2).alias("umidade_media_pr"),
        avg_half_up("precipitacao_total", 2, 2).alias("precipitacao_media"))
    numbers = ("ano", "total_casos", "municipios_afetados", "temp_media_pr", "umidade_media_pr",
               "precipitacao_media")
    doc = json_object([("ano", F.col("ano")), ("pandemia", F.col("pandemia")),
                       ("total_casos", F.col("total_casos")),
                       ("municipios_afetados", F.col("municipios_afetados")),
                       ("temp_media_pr", F.col("temp_media_pr")),
                       ("umidade_media_pr", F.col("umidade_media_pr")),
                       ("precipitacao_media", F.col("precipitacao_media"))], numeric=numbers)
    return g.orderBy("ano").select(doc.alias("resumo_json"))


# 14 -------------------------------------------------------------------------
def with_region_mean(star: Star, region: str = EXAMPLE_REGION) -> DataFrame:
    """Municipalities of one region with the regional mean of the year beside. The mean
    is taken from the fact and its municipalities, without the view's other joins."""
    v = wide_view(star).where(F.col("nm_regiao") == region)
    places = star.municipio.where(F.col("nm_regiao") == region).select("sk_municipio", "nm_regiao")
    counts = _ft(star, star.fato.join(places, "sk_municipio")).select("nm_regiao", "ano", "casos_tb")
    v = with_group_mean(v, ["nm_regiao", "ano"], "casos_tb", "media_regiao", means_of=counts)
    return (v.select("nm_municipio", "ano", "casos_tb", "media_regiao", "pib_per_capita",
                     "temp_med_anual")
            .orderBy(F.col("ano").asc_nulls_last(), F.col("casos_tb").desc_nulls_first(),
                     F.col("nm_municipio").asc_nulls_last()))


def above_region_mean(star: Star, region: str = EXAMPLE_REGION) -> DataFrame:
    """As :func:`with_region_mean`, only rows above the regional mean (what the
    statement's title promises)."""
    return with_region_mean(star, region).where(F.col("casos_tb") > F.col("media_regiao"))


# 15 -------------------------------------------------------------------------
def period_ratio(summary: DataFrame) -> DataFrame:
    """Per region: cases in and out of the pandemic years and their ratio."""
    inside = F.sum(F.when(F.col("pandemia") == "S", F.col("total_casos")).otherwise(F.lit(0)))
    outside = F.sum(F.when(F.col("pandemia") == "N", F.col("total_casos")).otherwise(F.lit(0)))
    g = summary.groupBy("regiao").agg(inside.alias("casos_pandemia"),
                                      outside.alias("casos_fora_pandemia"),
                                      F.sum("total_casos").alias("total_geral"))
    return (g.withColumn("razao_pandemia",
                         ratio_half_up(F.col("casos_pandemia"), F.col("casos_fora_pandemia"), 2))
            .orderBy(F.col("total_geral").desc_nulls_first(), F.col("regiao").asc_nulls_last()))


ALL = {
    "q01_yearly_totals": yearly_totals, "q02_top_places": top_places,
    "q03_risk_and_income_bands": risk_and_income_bands, "q04_year_over_year": year_over_year,
    "q05_rank_quartile_share": rank_quartile_share,
    "q06_moving_avg_running_sum": moving_avg_running_sum,
    "q07_rollup_region_year": rollup_region_year, "q08_cube_period_band": cube_period_band,
    "q09_grouping_sets_year_region": grouping_sets_year_region, "q10_wide_view": wide_view,
    "q11_region_year_summary": region_year_summary, "q12_xml_report": xml_report,
    "q13_json_rows": json_rows,
}
