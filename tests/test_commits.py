"""Appends that count once, loads that are refused, updates of the parts that change, broken files."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from stellata.operators import copy_on_write, gates
from stellata.operators.joins import update_where_exists
from stellata.plans import warehouse
from stellata.sources import batches
from stellata.sources.weather import folder_report, read_weather_hourly
from weather_files import write_weather_folder

# --- batches ---------------------------------------------------------------------------


def rows(spark, n, start=0):
    return spark.createDataFrame([(i, None if i % 3 == 0 else f"x{i}", i / 4) for i in range(start, start + n)],
                                 "id int, nome string, v double")


def test_a_batch_counts_once(spark, tmp_path):
    root = str(tmp_path / "t")
    assert batches.append_batch(rows(spark, 20), root)
    # the same rows in another order and partitioning
    assert not batches.append_batch(rows(spark, 20).repartition(3).orderBy(F.desc("id")), root)
    assert batches.append_batch(rows(spark, 20, 20), root)
    assert not batches.append_batch(rows(spark, 0), root)
    got = batches.read_batches(spark, root)
    assert sorted(r["id"] for r in got.collect()) == list(range(40))
    assert sorted(b.rows for b in batches.batches(spark, root)) == [20, 20]
    # nothing is left of the batches that were not added
    assert sum(p.is_dir() for p in (tmp_path / "t").iterdir()) == 2


def test_fingerprints_tell_bags_apart(spark):
    make = lambda values: batches.fingerprint(spark.createDataFrame(values, "a string, b string"))[0]
    bags = [[("x", None)], [(None, "x")], [("x", None), ("x", None)], [("x", "")], [(None, None)], []]
    assert len({make(b) for b in bags}) == len(bags)
    assert make([("a", "b"), ("c", "d")]) == make([("c", "d"), ("a", "b")])


def test_named_batches_and_a_replay_at_the_same_time(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    assert batches.append_batch(rows(spark, 5), root, "monday")
    assert batches.append_batch(rows(spark, 5), root, "tuesday")  # equal rows on purpose
    assert not batches.append_batch(rows(spark, 9), root, "monday")
    assert batches.read_batches(spark, root).count() == 10
    # two loads of one batch, neither of which sees the other before it commits
    real = batches.batches
    monkeypatch.setattr(batches, "batches", lambda *a: [])
    assert batches.append_batch(rows(spark, 7, 50), root) and batches.append_batch(rows(spark, 7, 50), root)
    monkeypatch.setattr(batches, "batches", real)
    assert batches.read_batches(spark, root).count() == 17
    # a load that died before its commit
    rows(spark, 3).write.parquet(f"{root}/rows-dead")
    assert batches.read_batches(spark, root).count() == 17


# --- gates -----------------------------------------------------------------------------

def test_refused_load_leaves_the_current_version(spark, tmp_path):
    root = str(tmp_path / "dw")
    table = lambda values, ddl: spark.createDataFrame(values, ddl)
    rules = {"dim": [gates.Unique(["k"]), gates.NotNull("nome")],
             "fato": [gates.References(["k"], "dim", ["k"]), gates.Check("n >= 0", F.col("n") < 0)]}

    def load(dim, fact):
        return warehouse.build_stages(spark, root, [
            ("dim", lambda d: table(dim, "k int, nome string")),
            ("fato", lambda d: table(fact, "k int, n int"))], rules)

    good = load([(1, "a"), (2, "b")], [(1, 5), (None, 0), (2, 1), (2, 1)])
    cases = [([(1, "a"), (1, None)], [(1, 5)], {"unique: k": 1, "not null: nome": 1}),
             ([(1, "a")], [(2, 5), (3, -1), (None, -2)], {"references: k -> dim": 2, "check: n >= 0": 2})]
    for dim, fact, want in cases:
        with pytest.raises(gates.LoadRefused) as refused:
            load(dim, fact)
        assert {c: n for _, c, n in refused.value.found} == want
        assert os.path.exists(refused.value.version.removeprefix("file:") + "/REFUSED")
        assert [v.rsplit("/", 1)[1] for v in warehouse.versions(spark, root)] == [good.rsplit("/", 1)[1]]
        assert spark.read.parquet(f"{refused.value.version}/_rejected/*").count() >= 1


def test_empty_tables_pass_the_gate(spark, tmp_path):
    full, rules = spark.createDataFrame([(1,)], "k int"), [gates.NotNull("k"), gates.Unique(["k"])]
    for i, df in enumerate([full.limit(0), full.where("1 = 0"), full.where("k > 5").groupBy("k").count().select("k")]):
        assert gates.write_gated(df, str(tmp_path / f"t{i}"), "t", rules, {}) == []


# --- updates ---------------------------------------------------------------------------

def test_update_writes_the_parts_it_changes(spark, tmp_path):
    root = str(tmp_path / "t")
    table = spark.createDataFrame([(i, 2018 + i % 4, float(i)) for i in range(40)], "id int, ano int, v double")
    copy_on_write.write_parts(table, root, "ano")
    values = spark.createDataFrame([(i, -1.0) for i in (1, 5, 9)], "id int, v double")
    guard = spark.createDataFrame([(1,), (5,), (13,)], "id int")  # all in 2019; 13 has no value
    assert copy_on_write.update_parts(spark, root, "ano", values, ["id"], "v", guard, ["id"]) == ["2019"]
    last = warehouse.versions(spark, root)[-1].removeprefix("file:")
    assert [p for p in os.listdir(last) if "=" in p] == ["_parte=2019"]
    as_rows = lambda df: sorted(map(str, df.select("id", "ano", "v").collect()))
    want = update_where_exists(table, values, ["id"], "v", guard, ["id"])
    assert as_rows(copy_on_write.read_parts(spark, root)) == as_rows(want)
    assert copy_on_write.read_parts(spark, root, [2020]).count() == 10
    # nothing to change, nothing written; a version without its commit is not read
    assert copy_on_write.update_parts(spark, root, "ano", values, ["id"], "v", guard.where("id > 99"), ["id"]) == []
    table.withColumn("_parte", F.lit("2018")).write.partitionBy("_parte").parquet(warehouse.new_version(root))
    assert as_rows(copy_on_write.read_parts(spark, root)) == as_rows(want)


# --- files -----------------------------------------------------------------------------

def test_unreadable_file_is_reported(spark, tmp_path):
    root = write_weather_folder(str(tmp_path / "horarios"))
    path = os.path.join(root, "2020", "INMET_S_PR_A001_RUIM.CSV")
    with open(path, "w") as f:
        f.write("x" * 2000)
    with open(os.path.join(root, "2020", ".INMET_S_PR_A001_RUIM.CSV.crc"), "wb") as f:
        f.write(b"crc\x00\x00\x00\x02\x00" + b"\x00" * 16)  # checksums that the bytes do not have
    assert read_weather_hourly(spark, root).count() == 10
    got = {os.path.basename(r["arquivo"]): (r["ano"], r["situacao"], r["registros"]) for r in folder_report(spark, root).collect()}
    assert got["INMET_S_PR_A001_RUIM.CSV"] == (2020, "ilegivel", 0)
    assert sorted(s for _, s, _ in got.values()) == ["ilegivel", "lido", "lido", "lido", "outra uf", "sem coluna de data"]
