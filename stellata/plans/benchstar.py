"""The star built from the TPC-H-like benchmark tables, so the analytic
queries run unchanged on data that grows with the scale factor.

Mapping (place = customer, time = order year, station = supplier):

* ``dim_tempo``: calendar years from the first to the last order year;
  pandemic flag ``S`` for 1997-1999;
* ``dim_municipio``: customers, region = region name through the nation, with
  one region left out so some places have a NULL region;
* ``dim_socioeconomico``: customer × year; per-capita = account balance
  (NULL when negative), total = order value of the year, density derived from
  the balance;
* ``dim_estacao``: suppliers (latitude = account balance);
* daily "weather" = line items per (supplier, ship day) — quantity max/min,
  discount and tax means, quantity × discount as rain — rolled up to
  ``dim_clima`` per (supplier, year) by the same yearly operator as real data;
* fact: orders counted per (customer, year) over the full customer × year grid
  (0 where a customer ordered nothing), station by a literal region map.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellata.functions.numbers import avg_half_up, sum_exact
from stellata.operators.aggregates import yearly_summary
from stellata.operators.keys import grain_key
from stellata.plans.star import TIME_RADIX, Star, fact

# ---------------------------------------------------------------------------
# Fixed values of the benchmark mapping.
PANDEMIC_YEARS = (1997, 1999)
REGION_WITHOUT_NAME = "MIDDLE EAST"
BENCH_REGION_STATION = [("AFRICA", "S1"), ("AMERICA", "S2"), ("ASIA", "S3"), ("EUROPE", "S4")]
DENSITY_BASE_YEAR = 1995
BENCH_REGION = "EUROPE"
BENCH_LATITUDE = 5000.0
# ---------------------------------------------------------------------------

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents")


def read_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in names}


def order_years(orders: DataFrame) -> list[int]:
    """Calendar years spanned by the orders (one tiny aggregate; bounded)."""
    lo, hi = orders.agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    return list(range(int(lo), int(hi) + 1))


def bench_dim_tempo(spark: SparkSession, years: list[int]) -> DataFrame:
    lo, hi = PANDEMIC_YEARS
    rows = [(y, y, "S" if lo <= y <= hi else "N") for y in years]
    return spark.createDataFrame(rows, "sk_tempo bigint, ano int, pandemia string")


def bench_dim_municipio(t: dict[str, DataFrame]) -> DataFrame:
    regions = t["region"].where(F.col("r_name") != REGION_WITHOUT_NAME)
    nation = F.broadcast(t["nation"])  # 25 nations
    m = (t["customer"].join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(F.broadcast(regions), F.col("n_regionkey") == F.col("r_regionkey"), "left"))
    return m.select(F.col("c_custkey").alias("sk_municipio"),
                    F.col("c_custkey").cast("string").alias("cd_ibge"),
                    F.col("c_name").alias("nm_municipio"), F.col("r_name").alias("nm_regiao"),
                    "c_acctbal")


def customer_year_orders(orders: DataFrame) -> DataFrame:
    """(sk_municipio, ano, casos, valor): orders and order value per customer-year
    (partial aggregation collapses a hot customer inside each task)."""
    return orders.groupBy(F.col("o_custkey").alias("sk_municipio"),
                          F.year("o_orderdate").alias("ano")).agg(
        F.count(F.lit(1)).alias("casos"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("valor"))


def customer_years(municipio: DataFrame, orders: DataFrame, years: list[int], value: bool = False) -> DataFrame:
    """Every customer in every year with its orders and, if wanted, their value (0 and
    NULL where it ordered nothing). Orders collapse to one row per customer, with a column per year,
    before they meet the customers; the years are then taken apart in place."""
    year = F.year("o_orderdate")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    per = orders.groupBy(F.col("o_custkey").alias("sk_municipio")).agg(
        *[F.count(F.when(year == y, F.lit(1))).alias(f"n_{y}") for y in years],
        *[F.sum(F.when(year == y, price)).alias(f"v_{y}") for y in years if value])
    cells = F.array(*[F.struct(F.lit(y).cast("bigint").alias("sk_tempo"), F.lit(y).cast("int").alias("ano"),
                               F.coalesce(F.col(f"n_{y}"), F.lit(0)).cast("int").alias("casos_tb"),
                               *([F.col(f"v_{y}").alias("valor")] if value else [])) for y in years])
    return municipio.join(per, "sk_municipio", "left").select(*municipio.columns, F.inline(cells))


def bench_dim_socio(grid: DataFrame) -> DataFrame:
    bal = F.col("c_acctbal")
    return grid.select(
        grain_key(("sk_municipio", 1), ("sk_tempo", TIME_RADIX)).alias("sk_socioeconomico"),
        "sk_municipio", "sk_tempo",
        F.when(bal >= 0, bal.cast("decimal(15,2)")).alias("pib_per_capita"),
        F.col("valor").cast("decimal(20,0)").alias("pib_total"),
        (F.abs(bal).cast("decimal(10,2)") + (F.col("ano") - DENSITY_BASE_YEAR))
        .cast("decimal(10,2)").alias("dens_demografica"))


def bench_dim_estacao(supplier: DataFrame) -> DataFrame:
    return supplier.select(
        F.col("s_suppkey").alias("sk_estacao"),
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("cd_estacao"),
        F.col("s_name").alias("nm_estacao"), F.lit("FORNECEDOR").alias("tp_estacao"),
        F.lit("ATIVO").alias("cd_situacao"),
        F.col("s_acctbal").cast("decimal(12,8)").alias("latitude"),
        F.col("s_nationkey").cast("decimal(12,8)").alias("longitude"),
        (F.col("s_nationkey") * 10).cast("decimal(8,2)").alias("altitude"))


def bench_daily(lineitem: DataFrame) -> DataFrame:
    """Per (supplier, ship day): the daily staging shape with decimal(6,2)/(8,2)
    measures. Rows only add bigint units (two-decimal inputs); decimals are
    formed once per group."""
    return lineitem.groupBy(F.col("l_suppkey").alias("sk_estacao"),
                            F.to_date("l_shipdate").alias("dia"),
                            F.year("l_shipdate").alias("ano")).agg(
        F.max("l_quantity").cast("decimal(6,2)").alias("temp_max_c"),
        F.min("l_quantity").cast("decimal(6,2)").alias("temp_min_c"),
        avg_half_up(F.col("l_discount") * 100, 2, 2).cast("decimal(6,2)").alias("temp_med_c"),
        avg_half_up(F.col("l_tax") * 100, 2, 2).cast("decimal(6,2)").alias("umidade_med_pct"),
        sum_exact(F.col("l_quantity") * F.col("l_discount"), 4).cast("decimal(8,2)")
        .alias("precipitacao_mm"))


def bench_dim_clima(daily: DataFrame, tempo: DataFrame) -> DataFrame:
    d = daily.join(F.broadcast(tempo.select("sk_tempo", "ano")), "ano")  # calendar years
    y = yearly_summary(d, ["sk_estacao", "sk_tempo"], "temp_max_c", "temp_min_c", "temp_med_c",
                       "umidade_med_pct", "precipitacao_mm", in_scale=2)
    return y.select(grain_key(("sk_estacao", 1), ("sk_tempo", TIME_RADIX)).alias("sk_clima"), "*")


#: How much of the climate a statement needs.
NO_CLIMATE, MAPPED_CLIMATE, ALL_CLIMATE = "none", "mapped", "all"


def bench_star(spark: SparkSession, sf_dir: str, climate: str = MAPPED_CLIMATE,
               keep_unmapped: bool = True) -> Star:
    """The benchmark star as one lazy plan over the tables; nothing is stored, so any
    number of statements can run at once and each computes the parts that it reads.

    ``climate``: ``none`` leaves line items and suppliers out (the fact has no station
    and climate keys then), ``mapped`` reads the line items of the stations in the
    region map only (the only ones a fact row can refer to), ``all`` every station's."""
    t = read_tables(spark, sf_dir, ["region", "nation", "customer", "supplier", "orders", "lineitem"])
    years = order_years(t["orders"])
    tempo = bench_dim_tempo(spark, years)
    municipio = bench_dim_municipio(t)
    grid = customer_years(municipio, t["orders"], years)
    estacao = bench_dim_estacao(t["supplier"])
    rmap = spark.createDataFrame(BENCH_REGION_STATION, "nm_regiao string, cd_estacao string")
    items = t["lineitem"]
    if climate != ALL_CLIMATE:
        named = F.broadcast(rmap.select("cd_estacao").distinct())  # four codes
        wanted = estacao.join(named, "cd_estacao", "left_semi").select(F.col("sk_estacao").alias("l_suppkey"))
        items = items.join(F.broadcast(wanted), "l_suppkey", "left_semi")
    clima = bench_dim_clima(bench_daily(items), tempo)
    dim_m = municipio.drop("c_acctbal")
    counts = grid.select("sk_municipio", "nm_regiao", "ano", "casos_tb")
    if climate == NO_CLIMATE:
        key = grain_key(("sk_municipio", 1), ("sk_tempo", TIME_RADIX))
        fato = grid.select(key.alias("sk_fat"), "sk_municipio", "sk_tempo", key.alias("sk_socioeconomico"), "casos_tb")
    else:
        fato = fact(counts, dim_m, tempo, rmap, estacao, clima, keep_unmapped)
    worth = customer_years(municipio, t["orders"], years, value=True)
    return Star(tempo, dim_m, estacao, clima, bench_dim_socio(worth), fato,
                extras={"aux_regiao_estacao": rmap, "years": years})
