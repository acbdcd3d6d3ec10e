"""Star schema: one fact (cases per municipality and year) and five dimensions
(time, municipality, station, yearly climate, socio-economy), built with
DataFrame joins from the staged sources.

Surrogate keys: municipalities use their 6-digit code; rows at (municipality,
year) or (station, year) grain get a mixed-radix key of their parents' keys;
stations, which have text codes, get a dense key ordered by code. No key needs a
global sort.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellata.functions.numbers import dash_to_zero, to_decimal
from stellata.functions.text import accent_key, ibge_code, ibge_name, starts_with_code
from stellata.operators.aggregates import yearly_summary
from stellata.operators.joins import nearest_lookup
from stellata.operators.keys import dense_key, grain_key
from stellata.operators.reshape import unpivot_measures, unpivot_years
from stellata.sources.tables import YEARS

# ---------------------------------------------------------------------------
# The time dimension seed (key, year, pandemic flag).
TIME_SEED = [(1, 2018, "N"), (2, 2019, "N"), (3, 2020, "S"), (4, 2021, "S"), (5, 2022, "S"),
             (6, 2023, "N")]
# Region -> reference weather station code.
REGION_STATION = [
    ("RGI de Apucarana", "A835"),
    ("RGI de Campo Mourão", "A822"),
    ("RGI de Cascavel", "A820"),
    ("RGI de Cianorte", "A869"),
    ("RGI de Cornélio Procópio - Bandeirantes", "A842"),
    ("RGI de Curitiba", "A807"),
    ("RGI de Dois Vizinhos", "A843"),
    ("RGI de Foz do Iguaçu", "A846"),
    ("RGI de Francisco Beltrão", "A843"),
    ("RGI de Guarapuava", "A823"),
    ("RGI de Ibaiti", "A871"),
    ("RGI de Irati", "A823"),
    ("RGI de Ivaiporã", "A822"),
    ("RGI de Laranjeiras do Sul - Quedas do Iguaçu", "B804"),
    ("RGI de Loanda", "A849"),
    ("RGI de Londrina", "A842"),
    ("RGI de Marechal Cândido Rondon", "A820"),
    ("RGI de Maringá", "A835"),
    ("RGI de Paranacity - Colorado", "A835"),
    ("RGI de Paranaguá", "A873"),
    ("RGI de Paranavaí", "A850"),
    ("RGI de Pato Branco", "A876"),
    ("RGI de Pitanga", "A822"),
    ("RGI de Ponta Grossa", "A819"),
    ("RGI de Santo Antônio da Platina", "A821"),
    ("RGI de Telêmaco Borba", "A872"),
    ("RGI de Toledo", "A820"),
    ("RGI de Umuarama", "A824"),
    ("RGI de União da Vitória", "A875"),
]
# Latitude of the single reference point of the older fact load.
REFERENCE_LATITUDE = -24.5
GDP_EXCLUDED_NAMES = ("Estado do Paraná", "MUNICÍPIOS")
STATE = "PR"
# ---------------------------------------------------------------------------

# Radix of the time part in (parent key, time key) composite keys; time keys are
# either small seeds or calendar years, both below it.
TIME_RADIX = 10000


@dataclass
class Star:
    tempo: DataFrame        # sk_tempo, ano, pandemia
    municipio: DataFrame    # sk_municipio, cd_ibge, nm_municipio, nm_regiao
    estacao: DataFrame      # sk_estacao, cd_estacao, nm_estacao, tp_estacao, cd_situacao, latitude, longitude, altitude
    clima: DataFrame        # sk_clima, sk_estacao, sk_tempo, temp_*_anual, umidade_med_anual, precipitacao_total, dias_chuva
    socio: DataFrame        # sk_socioeconomico, sk_municipio, sk_tempo, pib_per_capita, pib_total, dens_demografica
    fato: DataFrame         # sk_fat, sk_municipio, sk_tempo, sk_estacao, sk_socioeconomico, sk_clima, casos_tb
    extras: dict = field(default_factory=dict)

    def tables(self) -> dict[str, DataFrame]:
        return {"dim_tempo": self.tempo, "dim_municipio": self.municipio,
                "dim_estacao": self.estacao, "dim_clima": self.clima,
                "dim_socioeconomico": self.socio, "fato_tuberculose": self.fato}


def dim_tempo(spark: SparkSession, seed=TIME_SEED) -> DataFrame:
    return spark.createDataFrame(seed, "sk_tempo bigint, ano int, pandemia string")


def region_station_map(spark: SparkSession, pairs=REGION_STATION) -> DataFrame:
    return spark.createDataFrame(pairs, "nm_regiao string, cd_estacao string")


def dim_municipio(cases: DataFrame, density: DataFrame, mode: str = "correct") -> DataFrame:
    """Distinct coded names of the case file, region looked up in the density
    table on the accent-folded name (LEFT: an unmatched name has a NULL region)."""
    raw = cases.where(starts_with_code("municipio_raw")).select("municipio_raw").distinct()
    m = raw.select(ibge_code("municipio_raw").alias("cd_ibge"),
                   ibge_name("municipio_raw").alias("nm_municipio"))
    regions = density.select(accent_key("municipio", mode).alias("_k"),
                             F.col("regiao").alias("nm_regiao"))
    m = m.withColumn("_k", accent_key("nm_municipio", mode)).join(regions, "_k", "left").drop("_k")
    return m.select(F.col("cd_ibge").cast("bigint").alias("sk_municipio"), "cd_ibge",
                    "nm_municipio", "nm_regiao")


def dim_estacao(stations: DataFrame, state: str = STATE) -> DataFrame:
    """Stations of the state from the catalogue; coordinates as decimals (a
    minus sign is accepted, unlike the source's number mask)."""
    st = stations.where(F.col("SG_ESTADO") == state).select(
        F.col("CD_ESTACAO").alias("cd_estacao"), F.col("DC_NOME").alias("nm_estacao"),
        F.col("TP_ESTACAO").alias("tp_estacao"), F.col("CD_SITUACAO").alias("cd_situacao"),
        to_decimal("VL_LATITUDE", 12, 8).alias("latitude"),
        to_decimal("VL_LONGITUDE", 12, 8).alias("longitude"),
        to_decimal("VL_ALTITUDE", 8, 2).alias("altitude"))
    keyed = dense_key(st, ["cd_estacao"], "sk_estacao")
    return keyed.select("sk_estacao", "cd_estacao", "nm_estacao", "tp_estacao", "cd_situacao",
                        "latitude", "longitude", "altitude")


def dim_clima(daily: DataFrame, estacao: DataFrame, tempo: DataFrame) -> DataFrame:
    """Daily staging rows -> one row per (station, year)."""
    d = (daily.join(estacao.select("sk_estacao", F.col("cd_estacao").alias("codigo_estacao")),
                    "codigo_estacao")
         .join(F.broadcast(tempo.select("sk_tempo", "ano")), "ano"))
    y = yearly_summary(d, ["sk_estacao", "sk_tempo"], "temp_max_c", "temp_min_c", "temp_med_c",
                       "umidade_med_pct", "precipitacao_mm", in_scale=2)
    return y.select(grain_key(("sk_estacao", 1), ("sk_tempo", TIME_RADIX)).alias("sk_clima"), "*")


def year_grid(df: DataFrame, years) -> DataFrame:
    """Every row once per year: ``years`` is a short list of (sk_tempo, ano) —
    the calendar of the time dimension, known on the driver — so the grid is a
    ``Generate`` (explode) in the plan, linear in the rows, with no join."""
    pairs = F.array(*[F.struct(F.lit(sk).cast("bigint").alias("sk_tempo"),
                               F.lit(y).cast("int").alias("ano")) for sk, y in years])
    return df.select("*", F.inline(pairs))


def dim_socioeconomico(municipio: DataFrame, years, gdp: DataFrame,
                       density: DataFrame, mode: str = "correct") -> DataFrame:
    """Municipality × year grid with GDP per capita, GDP total and density for
    that year (wide year columns unpivoted, then joined on (name key, year)).
    ``years``: (sk_tempo, ano) pairs of the time dimension."""
    grid = year_grid(municipio.select("sk_municipio", accent_key("nm_municipio", mode).alias("_k")),
                     years)
    g = gdp.where(~F.col("municipio").isin(*GDP_EXCLUDED_NAMES)).withColumn(
        "_k", accent_key("municipio", mode))
    gdp_long = unpivot_measures(g, ["_k"], {
        "pib_per_capita": {y: f"per_capita_{y}" for y in YEARS},
        "pib_total": {y: f"pib_total_{y}" for y in YEARS}})
    gdp_long = gdp_long.select(
        "_k", "ano",
        to_decimal(F.nullif(F.col("pib_per_capita"), F.lit("")), 15, 2).alias("pib_per_capita"),
        to_decimal(F.nullif(F.col("pib_total"), F.lit("")), 20, 0).alias("pib_total"))
    dens_long = unpivot_years(density.withColumn("_k", accent_key("municipio", mode)), ["_k"],
                              {y: f"dens_{y}" for y in YEARS}, "ano", "dens_demografica")
    s = grid.join(gdp_long, ["_k", "ano"], "left").join(dens_long, ["_k", "ano"], "left")
    return s.select(grain_key(("sk_municipio", 1), ("sk_tempo", TIME_RADIX)).alias("sk_socioeconomico"),
                    "sk_municipio", "sk_tempo", "pib_per_capita", "pib_total",
                    F.col("dens_demografica").cast("decimal(10,2)").alias("dens_demografica"))


def cases_long(cases: DataFrame) -> DataFrame:
    """(cd_ibge, ano, casos_tb): the six year columns unpivoted, ``-`` -> 0."""
    coded = cases.where(starts_with_code("municipio_raw"))
    long = unpivot_years(coded, ["municipio_raw"], {y: f"casos_{y}" for y in YEARS}, "ano", "casos_raw")
    return long.select(ibge_code("municipio_raw").alias("cd_ibge"), "ano",
                       dash_to_zero("casos_raw").alias("casos_tb"))


def region_lookups(region_map: DataFrame, estacao: DataFrame, clima: DataFrame):
    """(nm_regiao -> sk_estacao) and ((nm_regiao, sk_tempo) -> sk_clima).

    ``region_map`` is a literal with one row per region. A station code that repeats in
    the catalogue counts once (its smallest key), so the first has at most as many rows
    as the map and the second that times the years: bounds fixed by the map, so the fact
    can broadcast both."""
    # the map side is the bounded one: broadcast it, stream stations and climate
    codes = F.broadcast(region_map.select("cd_estacao").distinct())
    one = (estacao.join(codes, "cd_estacao", "left_semi")
           .groupBy("cd_estacao").agg(F.min("sk_estacao").alias("sk_estacao")))
    rs = region_map.join(F.broadcast(one), "cd_estacao").select("nm_regiao", "sk_estacao")
    rc = clima.select("sk_clima", "sk_estacao", "sk_tempo").join(F.broadcast(rs), "sk_estacao") \
        .select("nm_regiao", "sk_tempo", "sk_clima")
    return rs, rc


def fact(counts: DataFrame, municipio: DataFrame, tempo: DataFrame, region_map: DataFrame,
         estacao: DataFrame, clima: DataFrame, keep_unmapped: bool = False) -> DataFrame:
    """Final fact load: each (municipality, year) case count with its region's
    station, that station's climate of the year and the socio-economic key.

    ``counts`` has (cd_ibge, ano, casos_tb), e.g. :func:`cases_long`; when it
    already carries ``sk_municipio`` and ``nm_regiao`` the municipality join is
    skipped. The socio-economic dimension is built on the full municipality ×
    year grid, so its key is computed, not looked up.

    As in the source, the station/climate lookups are inner joins, so rows whose
    region has no station (or whose station has no climate that year) are
    dropped; ``keep_unmapped=True`` keeps them with NULL keys instead. Both
    lookups are broadcast joins against tables bounded by the region map."""
    how = "left" if keep_unmapped else "inner"
    f = counts
    if not {"sk_municipio", "nm_regiao"} <= set(counts.columns):
        f = f.join(municipio.select("sk_municipio", "cd_ibge", "nm_regiao"), "cd_ibge")
    f = f.join(F.broadcast(tempo.select("sk_tempo", "ano")), "ano")  # calendar years
    rs, rc = region_lookups(region_map, estacao, clima)
    f = f.join(F.broadcast(rs), "nm_regiao", how).join(F.broadcast(rc), ["nm_regiao", "sk_tempo"], how)
    return f.select(grain_key(("sk_municipio", 1), ("sk_tempo", TIME_RADIX)).alias("sk_fat"),
                    "sk_municipio", "sk_tempo", "sk_estacao",
                    grain_key(("sk_municipio", 1), ("sk_tempo", TIME_RADIX)).alias("sk_socioeconomico"),
                    "sk_clima", "casos_tb")


def nearest_climate(clima: DataFrame, estacao: DataFrame,
                    latitude: float = REFERENCE_LATITUDE) -> DataFrame:
    """Per year, the climate row of the station nearest to a latitude (the older
    fact load's scalar subquery), ties broken by the smaller climate key."""
    c = clima.join(estacao.select("sk_estacao", "latitude"), "sk_estacao")
    return nearest_lookup(c, ["sk_tempo"], "latitude", latitude, ["sk_clima", "sk_estacao"],
                          ["sk_clima"])


def remap_climate(fato: DataFrame, municipio: DataFrame, region_map: DataFrame,
                  estacao: DataFrame, clima: DataFrame) -> DataFrame:
    """The correcting UPDATE: a fact row whose municipality's region has a station
    gets that station's climate of the row's year (NULL if none); other rows keep
    their climate key. The fact meets its municipality once; what the region decides
    is bounded by the map and broadcast, so no fact-sized rows are dealt by a station."""
    _, rc = region_lookups(region_map, estacao, clima)
    mapped = region_map.select("nm_regiao", F.lit(True).alias("_mapped")).distinct()
    f = (fato.join(municipio.select("sk_municipio", "nm_regiao"), "sk_municipio", "left")
         .join(F.broadcast(mapped), "nm_regiao", "left")
         .join(F.broadcast(rc.withColumnRenamed("sk_clima", "_new")), ["nm_regiao", "sk_tempo"], "left"))
    return f.withColumn("sk_clima", F.when(F.col("_mapped"), F.col("_new")).otherwise(F.col("sk_clima"))) \
        .select(*fato.columns)


def build_star(spark: SparkSession, cases: DataFrame, density: DataFrame, stations: DataFrame,
               daily_weather: DataFrame, gdp: DataFrame, mode: str = "correct",
               keep_unmapped: bool = False) -> Star:
    """Staged sources -> star. ``mode`` picks the accent map (see ``accent_key``)."""
    t = dim_tempo(spark)
    m = dim_municipio(cases, density, mode)
    e = dim_estacao(stations)
    c = dim_clima(daily_weather, e, t)
    s = dim_socioeconomico(m, [(sk, y) for sk, y, _ in TIME_SEED], gdp, density, mode)
    rmap = region_station_map(spark)
    f = fact(cases_long(cases), m, t, rmap, e, c, keep_unmapped)
    return Star(t, m, e, c, s, f, extras={"aux_regiao_estacao": rmap})
