"""Operators against brute force on small frames."""

from __future__ import annotations

import random
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from stellata.operators import quality
from stellata.operators.export import json_object, xml_document, xml_rows
from stellata.operators.joins import nearest_lookup, update_where_exists
from stellata.operators.keys import dense_key, grain_key
from stellata.operators.reshape import union_all_slices, unpivot_measures, unpivot_years
from stellata.operators.windows import (change_vs_previous, moving_average_running_sum,
                                        top_k_rank_quartile_share,
                                        with_group_mean)


def test_dense_key_is_row_number(spark):
    rnd = random.Random(3)
    keys = rnd.sample(range(10 ** 6), 5000)
    df = spark.createDataFrame([(k, f"v{k}") for k in keys], "k bigint, v string").repartition(7)
    got = dense_key(df, ["k"], "sk", num_partitions=5).select("k", "sk")
    want = df.select("k", F.row_number().over(Window.orderBy("k")).alias("sk"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_grain_key(spark):
    df = spark.createDataFrame([(410010, 3)], "a bigint, b bigint")
    assert df.select(grain_key(("a", 1), ("b", 10000))).first()[0] == 4100100003


def test_nearest_lookup_nulls_last_and_ties(spark):
    rows = [("x", 1, None), ("x", 2, -24.0), ("x", 3, -25.0), ("x", 4, -26.0),
            ("y", 5, None), ("z", 6, -10.0), ("z", 7, -30.0)]
    df = spark.createDataFrame(rows, "g string, id bigint, lat double")
    got = {r["g"]: r["id"] for r in nearest_lookup(df, ["g"], "lat", -24.5, ["id"], ["id"]).collect()}
    assert got == {"x": 2, "y": 5, "z": 7}  # tie 2/3 -> smaller id; all-NULL group -> its row
    overall = nearest_lookup(df, [], "lat", -24.5, ["id"], ["id"]).collect()
    assert [r["id"] for r in overall] == [2]


def test_update_where_exists(spark):
    target = spark.createDataFrame([(1, 2018, 10), (1, 2019, 11), (2, 2018, 12), (3, 2018, 13)],
                                   "m bigint, y int, c bigint")
    values = spark.createDataFrame([(1, 2018, 100), (2, 2019, 200)], "m bigint, y int, c bigint")
    guard = spark.createDataFrame([(1,), (2,)], "m bigint")
    got = sorted(tuple(r) for r in update_where_exists(target, values, ["m", "y"], "c", guard, ["m"]).collect())
    # guarded with a value -> new; guarded without -> NULL; unguarded -> old
    assert got == [(1, 2018, 100), (1, 2019, None), (2, 2018, None), (3, 2018, 13)]


def _brute_rank(df, value, tiebreak, k):
    order = [F.col(value).desc()] + [F.col(c) for c in tiebreak]
    w = Window.orderBy(*order)
    out = (df.withColumn("ranking", F.rank().over(Window.orderBy(F.col(value).desc())))
           .withColumn("quartil", F.ntile(4).over(w))
           .withColumn("_rn", F.row_number().over(w))
           .withColumn("_tot", F.sum(value).over(Window.partitionBy())))
    return {r["name"]: (r["ranking"], r["quartil"]) for r in out.where(F.col("_rn") <= k).collect()}


def test_top_k_rank_quartile_share_vs_windows(spark):
    rnd = random.Random(11)
    for n in (1, 3, 4, 5, 7, 21, 50, 203):
        rows = [(f"n{i:04d}", rnd.randint(0, 12)) for i in range(n)]
        df = spark.createDataFrame(rows, "name string, total bigint")
        got = top_k_rank_quartile_share(df, "total", ["name"], 20).collect()
        want = _brute_rank(df, "total", ["name"], 20)
        assert {r["name"]: (r["ranking"], r["quartil"]) for r in got} == want
        grand = sum(t for _, t in rows)
        for r in got:
            if grand:
                exact = (Decimal(r["total"]) * 100 / Decimal(grand)).quantize(Decimal("0.01"), "ROUND_HALF_UP")
                assert r["pct_do_total"] == exact


def test_change_moving_and_group_mean(spark):
    s = spark.createDataFrame([(2018, 10), (2019, 0), (2020, 5), (2021, 8)], "ano int, total_casos bigint")
    got = [tuple(r) for r in change_vs_previous(s, "ano", "total_casos").orderBy("ano").collect()]
    assert got[0][2:] == (None, None, None)
    assert got[1][2:] == (10, -10, Decimal("-100.00"))
    assert got[2][2:] == (0, 5, None)  # previous 0 -> NULLIF guard
    assert got[3][4] == Decimal("60.00")
    m = spark.createDataFrame([(1, 2018, 1), (1, 2019, 2), (1, 2020, 4), (2, 2018, 7)],
                              "e bigint, ano int, v int")
    out = {(r["e"], r["ano"]): (r["media_movel_3anos"], r["acumulado"])
           for r in moving_average_running_sum(m, "e", "ano", "v").collect()}
    assert out[(1, 2018)] == (Decimal("1.50"), 1)
    assert out[(1, 2019)] == (Decimal("2.33"), 3)
    assert out[(1, 2020)] == (Decimal("3.00"), 7)
    assert out[(2, 2018)] == (Decimal("7.00"), 7)
    g = with_group_mean(m, ["e"], "v", "media")
    assert {r["e"]: r["media"] for r in g.collect()} == {1: Decimal("2.33"), 2: Decimal("7.00")}


def test_unpivot_round_trip(spark):
    wide = spark.createDataFrame([("a", "1", "-", "3"), ("b", None, "2", "-")],
                                 "k string, c18 string, c19 string, c20 string")
    cols = {2018: "c18", 2019: "c19", 2020: "c20"}
    long = unpivot_years(wide, ["k"], cols)
    assert long.count() == 6
    assert sorted(map(tuple, long.collect())) == sorted(map(tuple, union_all_slices(wide, ["k"], cols).collect()))
    back = long.groupBy("k").pivot("ano", list(cols)).agg(F.first("valor"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, wide.collect()))
    two = unpivot_measures(wide, ["k"], {"p": cols, "q": cols})
    assert two.columns == ["k", "ano", "p", "q"] and two.count() == 6


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c")], "k bigint, v string")
    dup = {r["k"]: r["ocorrencias"] for r in quality.duplicate_keys(df, ["k"]).collect()}
    assert dup == {1: 2, None: 1}
    nulls = {r["coluna"]: r["nulos"] for r in quality.null_counts(df, ["k", "v"]).collect()}
    assert nulls == {"k": 1, "v": 1}
    parent = spark.createDataFrame([(1,)], "id bigint")
    assert sorted(r["k"] for r in quality.orphans(df, ["k"], parent, ["id"]).collect()) == [2]
    docs = spark.createDataFrame([(1, '{"a": 1}', "12.5"), (2, "{bad", "123.456"), (3, None, None)],
                                 "id int, j string, n string")
    bad = quality.domain_violations(docs, {"json": ~quality.is_json(F.col("j")),
                                           "numero": ~quality.fits_decimal(F.col("n"), 4, 2)}, ["id"])
    assert {r["id"]: r["falhas"] for r in bad.collect()} == {2: ["json", "numero"]}


def test_xml_and_json_rendering(spark):
    df = spark.createDataFrame([("B & C", 5, None), ("A<1>", 9, 2.5)], "n string, t bigint, p double")
    el = xml_rows(df, "m", [("nome", F.col("n")), ("t", F.col("t").cast("string"))])
    doc = xml_document(df, "r", {"titulo": "T"}, el, [-F.col("t")], 10).first()[0]
    assert xml_document(df, "r", {}, el, [-F.col("t")], 1).first()[0] == \
        "<r><m><nome>A&lt;1&gt;</nome><t>9</t></m></r>"
    assert doc == ('<r titulo="T"><m><nome>A&lt;1&gt;</nome><t>9</t></m>'
                   '<m><nome>B &amp; C</nome><t>5</t></m></r>')
    js = [r[0] for r in df.select(json_object(
        [("n", F.col("n")), ("p", F.col("p").cast("decimal(10,2)")), ("t", F.col("t"))],
        numeric=("p", "t"))).collect()]
    assert js == ['{"n":"B & C","p":null,"t":5}', '{"n":"A<1>","p":2.5,"t":9}']
    quoted = spark.createDataFrame([('say "hi"\n', 0.5)], "n string, p double")
    js = quoted.select(json_object([("n", F.col("n")), ("p", F.col("p").cast("decimal(4,2)"))],
                                   numeric=("p",))).first()[0]
    assert js == '{"n":"say \\"hi\\"\\n","p":0.5}'
    import json as _json
    assert _json.loads(js) == {"n": 'say "hi"\n', "p": 0.5}


def test_rank_and_quartile_of_all_rows(spark):
    """Ties across parts, nulls and tiny tables, against Spark's own windows."""
    from pyspark.sql import Window

    from stellata.operators.windows import rank_quartile_share_all

    many = spark.range(3000).select(F.concat(F.lit("n"), F.col("id")).alias("nome"), F.when(
        F.col("id") % 50 > 0, F.when(F.col("id") < 1800, 7).otherwise(F.col("id") % 9)).cast("bigint").alias("v"))
    for df in (many, many.limit(3), many.where("nome = 'n51'"), many.limit(0)):
        order = [F.col("v").desc_nulls_last(), F.col("nome").asc_nulls_last()]
        want = df.select("nome", "v", F.rank().over(Window.orderBy(order[0])).cast("bigint").alias("ranking"),
                         F.ntile(4).over(Window.orderBy(*order)).alias("quartil"))
        got = rank_quartile_share_all(df, "v", ["nome"]).select("nome", "v", "ranking", "quartil")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
