"""Stored star schema: write the star's tables once, query them many times.

The star is an ETL product: the source warehouse loads it once and runs its
analytic statements against the loaded tables. Here every load writes a new version
folder under a root that the caller names (on a cluster, a shared folder) and commits
it by creating one marker file inside that folder, last. Nothing is ever overwritten:
readers take the newest committed version, so loads and readers can run at the same
time, and a load that dies leaves a version that nobody reads.
Writing also cuts the lineage: a lost executor costs the reading of a table.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellata.operators.gates import Constraint, LoadRefused, NotNull, References, Unique, write_gated
from stellata.plans.star import Star

STAR_TABLES = ("dim_tempo", "dim_municipio", "dim_estacao", "dim_clima", "dim_socioeconomico",
               "fato_tuberculose")
MARKER, REFUSED = "COMMITTED", "REFUSED"

#: What the warehouse declares of its tables: primary keys, foreign keys, value checks.
STAR_GATES: dict[str, Sequence[Constraint]] = {
    "dim_tempo": [Unique(["sk_tempo"]), Unique(["ano"])],
    "dim_municipio": [Unique(["sk_municipio"]), NotNull("nm_municipio")],
    "dim_estacao": [Unique(["sk_estacao"]), Unique(["cd_estacao"])],
    "dim_clima": [Unique(["sk_clima"]), References(["sk_estacao"], "dim_estacao", ["sk_estacao"]),
                  References(["sk_tempo"], "dim_tempo", ["sk_tempo"])],
    "dim_socioeconomico": [Unique(["sk_socioeconomico"]),
                           References(["sk_municipio"], "dim_municipio", ["sk_municipio"]),
                           References(["sk_tempo"], "dim_tempo", ["sk_tempo"])],
    "fato_tuberculose": [Unique(["sk_fat"]), NotNull("sk_municipio"), NotNull("sk_tempo"),
                         References(["sk_municipio"], "dim_municipio", ["sk_municipio"]),
                         References(["sk_tempo"], "dim_tempo", ["sk_tempo"]),
                         References(["sk_estacao"], "dim_estacao", ["sk_estacao"]),
                         References(["sk_socioeconomico"], "dim_socioeconomico", ["sk_socioeconomico"]),
                         References(["sk_clima"], "dim_clima", ["sk_clima"])],
}

Stage = tuple[str, Callable[[dict[str, DataFrame]], DataFrame]]


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of ``path`` as Hadoop objects."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def new_version(root: str) -> str:
    """A folder name that sorts after the versions made before it."""
    return f"{root.rstrip('/')}/v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def commit(spark: SparkSession, version: str) -> None:
    """Make a version visible: create its marker (fails if it has one)."""
    fs, path = _hadoop(spark, f"{version}/{MARKER}")
    fs.create(path, False).close()


def versions(spark: SparkSession, root: str) -> list[str]:
    """The committed versions under ``root``, oldest first (one per load)."""
    fs, pattern = _hadoop(spark, f"{root.rstrip('/')}/v-*/{MARKER}")
    found = fs.globStatus(pattern) or []
    return sorted(f.getPath().getParent().toString() for f in found)


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove all but the newest ``keep`` committed versions (the caller knows that no
    reader still uses them); returns what went."""
    gone = versions(spark, root)[:-keep] if keep else versions(spark, root)
    for version in gone:
        fs, path = _hadoop(spark, version)
        fs.delete(path, True)
    return gone


def build_stages(spark: SparkSession, root: str, stages: Sequence[Stage],
                 gates: Mapping[str, Sequence[Constraint]] | None = None) -> str:
    """Staged load: each stage builds one table from the tables already stored
    (passed in as a dict), is written, and is read back for the stages after it:
    no table recomputes its inputs. The version is committed after the last one.

    ``gates`` names the constraints of tables. A table that breaks one ends the load:
    ``LoadRefused`` says which; the version is not committed but marked ``REFUSED``, with the
    offending keys under ``_rejected``, and readers keep the version before it."""
    version = new_version(root)
    stored: dict[str, DataFrame] = {}
    for name, make in stages:
        found = write_gated(make(stored), f"{version}/{name}", name, (gates or {}).get(name, ()), stored)
        if found:
            fs, path = _hadoop(spark, f"{version}/{REFUSED}")
            out = fs.create(path, False)
            out.write(bytearray("".join(f"{t}\t{c}\t{n}\n" for t, c, n in found).encode()))
            out.close()
            raise LoadRefused(found, version)
        stored[name] = spark.read.parquet(f"{version}/{name}")
    commit(spark, version)
    return version


def load_star(spark: SparkSession, root: str, extra_names: Sequence[str] = ()) -> Star:
    """The newest committed version under ``root``."""
    found = versions(spark, root)
    if not found:
        raise FileNotFoundError(f"no committed star under {root}")
    t = {n: spark.read.parquet(f"{found[-1]}/{n}") for n in (*STAR_TABLES, *extra_names)}
    return Star(t["dim_tempo"], t["dim_municipio"], t["dim_estacao"], t["dim_clima"],
                t["dim_socioeconomico"], t["fato_tuberculose"], extras={n: t[n] for n in extra_names})


def load_warehouse(spark: SparkSession, *, cases_csv: str, density_csv: str, stations_json: str,
                   daily_weather_csv: str, gdp_xml: str, out_root: str,
                   mode: str = "correct", gates: Mapping[str, Sequence[Constraint]] | None = STAR_GATES) -> Star:
    """Files -> staging DataFrames -> star tables loaded stage by stage into a new
    version under ``out_root`` (dimensions first, the fact from the stored dimensions),
    with the region x year summary and the rejects of every loader; then committed.
    Returns the star read back from storage. ``mode`` picks the accent map used to
    match names (see ``accent_key``); ``gates`` the constraints without which the load
    is refused (see ``build_stages``)."""
    from stellata.plans import olap
    from stellata.plans import star as st
    from stellata.plans.views import SUMMARY_NAME
    from stellata.sources import tables as tb

    cases, density = tb.read_cases(spark, cases_csv), tb.read_density(spark, density_csv)
    years = [(sk, y) for sk, y, _ in st.TIME_SEED]

    def planned(d: dict[str, DataFrame]) -> Star:
        return Star(d["dim_tempo"], d["dim_municipio"], d["dim_estacao"], d["dim_clima"],
                    d["dim_socioeconomico"], d["fato_tuberculose"],
                    extras={"aux_regiao_estacao": d["aux_regiao_estacao"]})

    build_stages(spark, out_root, [
        ("dim_tempo", lambda d: st.dim_tempo(spark)),
        ("aux_regiao_estacao", lambda d: st.region_station_map(spark)),
        ("dim_municipio", lambda d: st.dim_municipio(cases, density, mode)),
        ("dim_estacao", lambda d: st.dim_estacao(tb.read_stations(spark, stations_json))),
        ("dim_clima", lambda d: st.dim_clima(tb.read_daily_weather(spark, daily_weather_csv),
                                             d["dim_estacao"], d["dim_tempo"])),
        ("dim_socioeconomico", lambda d: st.dim_socioeconomico(
            d["dim_municipio"], years, tb.read_gdp_xml(spark, gdp_xml), density, mode)),
        ("fato_tuberculose", lambda d: st.fact(
            st.cases_long(cases), d["dim_municipio"], d["dim_tempo"], d["aux_regiao_estacao"],
            d["dim_estacao"], d["dim_clima"])),
        (SUMMARY_NAME, lambda d: olap.region_year_summary(planned(d))),
        # the source load stops on a value its masks reject; here such values become
        # NULL in the dimensions and are listed
        ("rejeitos", lambda d: gdp_rejects(tb.read_gdp_xml(spark, gdp_xml))
         .select(F.lit("pib").alias("carga"), F.col("municipio").alias("chave"), "falhas")
         .unionByName(daily_weather_rejects(tb.daily_weather_text(spark, daily_weather_csv)))
         .unionByName(density_rejects(tb.density_text(spark, density_csv)))
         .unionByName(station_rejects(tb.read_stations(spark, stations_json)))),
    ], gates)
    return load_star(spark, out_root, ("aux_regiao_estacao", SUMMARY_NAME, "rejeitos"))


def gdp_rejects(gdp: DataFrame) -> DataFrame:
    """GDP rows with a value that is not a number of the dimension's precision:
    (municipio, list of failing columns)."""
    from stellata.functions.numbers import is_bad_number
    from stellata.operators.quality import domain_violations
    from stellata.sources.tables import YEARS

    checks = {f"per_capita_{y}": is_bad_number(f"per_capita_{y}", 15, 2) for y in YEARS}
    checks.update({f"pib_total_{y}": is_bad_number(f"pib_total_{y}", 20, 0) for y in YEARS})
    return domain_violations(gdp, checks, ["municipio"])


def _listed(df: DataFrame, load: str, key, checks) -> DataFrame:
    from stellata.operators.quality import domain_violations

    return domain_violations(df.withColumn("_chave", key), checks, ["_chave"]).select(
        F.lit(load).alias("carga"), F.col("_chave").alias("chave"), "falhas")


def daily_weather_rejects(text: DataFrame) -> DataFrame:
    """Rows of the daily weather text with a date or measure that the load cannot take:
    (carga, chave = station and date text, list of failing columns)."""
    from stellata.functions.dates import parse_mixed_date
    from stellata.functions.numbers import is_bad_number
    from stellata.sources.tables import DAILY_WEATHER_TYPES

    blank = F.coalesce(F.trim("data"), F.lit("")) == ""
    checks = {"ano": is_bad_number("ano", 10, 0), "data": blank | parse_mixed_date("data").isNull()}
    checks.update({c: is_bad_number(c, p, s) for c, (p, s) in DAILY_WEATHER_TYPES.items()})
    key = F.concat_ws(" ", F.trim("codigo_estacao"), F.trim("data"))
    return _listed(text, "clima", key, checks)


def density_rejects(text: DataFrame) -> DataFrame:
    """Rows of the processed density text with a value that is not a number."""
    from stellata.functions.numbers import is_bad_number
    from stellata.sources.tables import YEARS

    return _listed(text, "densidade", F.col("municipio"),
                   {f"dens_{y}": is_bad_number(f"dens_{y}", 10, 2) for y in YEARS})


def raw_density_rejects(text: DataFrame) -> DataFrame:
    """The same for the raw export, whose numbers are written ``1.234,56``."""
    from stellata.functions.numbers import locale_number
    from stellata.sources.tables import YEARS

    def bad(c):
        return (F.coalesce(F.trim(c), F.lit("")) != "") & locale_number(c).isNull()

    return _listed(text, "densidade bruta", F.col("municipio"), {f"dens_{y}": bad(f"dens_{y}") for y in YEARS})


def station_rejects(stations: DataFrame) -> DataFrame:
    """Stations with a coordinate or altitude that is not a number."""
    from stellata.functions.numbers import is_bad_number

    return _listed(stations, "estacoes", F.col("CD_ESTACAO"),
                   {"VL_LATITUDE": is_bad_number("VL_LATITUDE", 12, 8),
                    "VL_LONGITUDE": is_bad_number("VL_LONGITUDE", 12, 8),
                    "VL_ALTITUDE": is_bad_number("VL_ALTITUDE", 8, 2)})
