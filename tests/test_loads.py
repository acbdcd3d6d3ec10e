"""Keys across loads and large JSON arrays."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from stellata.operators import registry
from stellata.sources.json_arrays import array_objects, read_json_array

# --- keys ------------------------------------------------------------------------------


def stations(spark, codes):
    return spark.createDataFrame([(c, n) for c in codes for n in range(2)], "cd string, n int")


def test_keys_survive_the_next_load(spark, tmp_path):
    root = str(tmp_path / "keys")
    first = registry.register_keys(stations(spark, ["B", "D", None]), root, ["cd"])
    old = {r["cd"]: r["sk"] for r in first.collect()}
    assert sorted(old.values()) == [1, 2, 3]
    second = registry.register_keys(stations(spark, ["A", "B", "C", "D", None]), root, ["cd"])
    new = {r["cd"]: r["sk"] for r in second.collect()}
    assert {c: new[c] for c in old} == old and [new["A"], new["C"]] == [4, 5]
    # a repeated load adds nothing, not even a generation
    again = registry.register_keys(stations(spark, ["C", "A"]), root, ["cd"])
    assert {r["cd"]: r["sk"] for r in again.collect()} == new
    assert len(registry.generations(spark, root)) == 2
    rows = registry.with_keys(stations(spark, ["A", None, "Z"]), again, ["cd"]).collect()
    assert sorted((str(r["cd"]), r["n"], str(r["sk"])) for r in rows) == sorted(
        (str(c), n, str(new.get(c))) for c in ("A", None, "Z") for n in range(2))


def test_a_lost_race_numbers_again(spark, tmp_path, monkeypatch):
    """Another load commits between reading the registry and committing: no key is given twice."""
    root, real, raced = str(tmp_path / "keys"), registry.dense_key, []

    def slow(df, natural, key, start):
        out = real(df, natural, key, start=start)
        if not raced:
            raced.append(1)
            registry.register_keys(stations(spark, ["X", "B"]), root, ["cd"])
        return out

    monkeypatch.setattr(registry, "dense_key", slow)
    got = registry.register_keys(stations(spark, ["A", "B"]), root, ["cd"]).collect()
    assert sorted((r["cd"], r["sk"]) for r in got) == [("A", 3), ("B", 1), ("X", 2)]


def test_empty_load(spark, tmp_path):
    root = str(tmp_path / "keys")
    assert registry.register_keys(stations(spark, ["a"]).limit(0), root, ["cd"]).collect() == []
    assert registry.generations(spark, root) == []


# --- JSON arrays -----------------------------------------------------------------------

SCHEMA = "id long, name string, inner struct<a: long, b: array<string>>"


def objects(n, seed=1):
    rng = random.Random(seed)
    odd = ['plain', 'a } b', '{"x": [', '\\', '"', 'é ☃ }', ']],', '\\"}', "line\nbreak", "", "tab\t{"]
    return [{"id": i, "name": rng.choice(odd) + rng.choice(odd),
             **({"inner": {"a": i, "b": [rng.choice(odd), "}"]}} if rng.random() < 0.4 else {})} for i in range(n)]


@pytest.mark.parametrize("split", [64, 1000, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_array_in_many_tasks(spark, tmp_path, split, indent):
    want = objects(120)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.json").write_text(json.dumps(want, indent=indent, ensure_ascii=indent is None))
    (tmp_path / "in" / "two.json").write_text("[]\n" + json.dumps(want[:7]) + "\n" + json.dumps(want[7:9], indent=1))
    (tmp_path / "in" / "none.json").write_text(" [ ] ")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = [json.loads(r["objeto"]) for r in array_objects(spark, str(tmp_path / "in")).collect()]
        rows = read_json_array(spark, str(tmp_path / "in" / "one.json"), SCHEMA).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    key = lambda x: json.dumps(x, sort_keys=True)
    assert sorted(got, key=key) == sorted(want + want[:9], key=key)
    # and as one task reads it
    whole = spark.read.option("multiLine", True).schema(SCHEMA).json(str(tmp_path / "in" / "one.json")).collect()
    assert sorted(rows, key=lambda r: r["id"]) == sorted(whole, key=lambda r: r["id"])


# --- summary states --------------------------------------------------------------------

def test_refresh_of_one_year_equals_recomputation(spark, tmp_path):
    from dataclasses import replace

    from stellata.plans import olap, summary_states
    from stellata.plans.benchstar import MAPPED_CLIMATE, bench_star

    star, root = bench_star(spark, "/root/testdata/sf0.001", MAPPED_CLIMATE), str(tmp_path / "states")
    year = star.extras["years"][2]
    first = summary_states.refresh(star, root)
    # one year's cases change, and one region's rows of that year go
    key = star.tempo.where(F.col("ano") == year).first()["sk_tempo"]
    gone = star.municipio.where("nm_regiao = 'ASIA'").select("sk_municipio")
    hit = star.fato.where(F.col("sk_tempo") == key).join(gone, "sk_municipio", "left_anti")
    changed = replace(star, fato=star.fato.where(F.col("sk_tempo") != key).unionByName(
        hit.withColumn("casos_tb", F.col("casos_tb") + 3).select(*star.fato.columns)))
    second = summary_states.refresh(changed, root, [year])
    where = summary_states.manifest(spark, root)
    assert {v for y, v in where.items() if y != year} == {first} and where[year] == second
    folders = {p.name for p in (tmp_path / "states" / second.rsplit("/", 1)[1] / "somas").iterdir() if p.is_dir()}
    assert folders == {f"ano={year}"}
    want = olap.region_year_summary(changed)
    got = summary_states.summary(spark, root).select(*want.columns)
    as_text = lambda df: sorted(str(tuple(map(str, r))) for r in df.collect())
    assert as_text(got) == as_text(want)
    # coarser groups follow from the states: distinct municipalities over all years
    regions = {r["regiao"]: r["qtd_municipios"] for r in summary_states.summary(spark, root, ["regiao"]).collect()}
    f = olap.summary_rows(changed).groupBy(F.coalesce("nm_regiao", F.lit(olap.NO_REGION)).alias("r")).agg(
        F.count_distinct("sk_municipio").alias("n"))
    assert regions == {r["r"]: r["n"] for r in f.collect()}
