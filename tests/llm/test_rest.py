"""Mixing, WARC archives, URL verdicts, nearest neighbours and the pipeline."""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import zstandard
from cases import documents, table, texts

from stellata.llm import ann, linkrank, mixing, warc
from stellata.llm.common import shared_path
from stellata.llm.queries import QUERIES, RULES, SQL

SF = "/root/testdata/sf0.001"


# --- mixing --------------------------------------------------------------------------

def brute_targets(sizes, weights=(1, 2, 3), cap=3.0):
    """Shares by repeated rounds, as the words of the contract have it."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), {}
    while True:
        rest = total - sum(stopped.values())
        open_ = [s for s in names if s not in stopped]
        share = {s: rest * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap * sizes[s]]
        if not over:
            return {**share, **stopped}
        stopped.update({s: cap * sizes[s] for s in over})


@pytest.mark.parametrize("bucket", [2000, 3])
def test_mix(spark, tmp_path, bucket):
    rows = texts() + [(500 + i, "tiny", "zz") for i in range(2)]
    docs = table(spark, tmp_path, rows)
    got = mixing.mix(docs, bucket=bucket).collect()
    assert len(got) == len(rows)
    sizes, biggest = defaultdict(int), defaultdict(int)
    for _, t, s in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        sizes[s] += n
        biggest[s] = max(biggest[s], n)
    want = brute_targets(dict(sizes))
    taken = defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert math.isclose(r["target"], want[r["source"]])
        assert r["taken"] <= 3 * r["size"] and r["epochs"] == int(r["target"] // r["source_size"])
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= biggest[s] / 2 + 1e-6
    again = mixing.mix(docs.repartition(5), bucket=bucket).collect()
    key = lambda r: (str(r["id"]), r["size"], r["taken"])
    assert sorted(map(key, again)) == sorted(map(key, got))
    out = mixing.mixture(docs, bucket=bucket)
    assert out.columns == docs.columns
    assert out.count() == sum(r["epochs"] + r["picked"] for r in got)


def test_keys_are_weighted(spark):
    """Heavier documents come first more often: with keys -ln(u)/w, weight 4 against 1
    wins with probability 4/5."""
    rows = [(i, "w " * (1 + i % 2), "s") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mix(df, weight=lambda size, points: (size - 1) * 3.0 + 1.0).select("id", "picked", "size")
    assert got.count() == 4000
    first = df.select(mixing.uniform(df["doc_id"], 7).alias("u"), "doc_id").collect()
    key = {r["doc_id"]: -math.log(r["u"]) / (4.0 if r["doc_id"] % 2 else 1.0) for r in first}
    wins = sum(key[i + 1] < key[i] for i in range(0, 4000, 2))
    assert abs(wins / 2000 - 0.8) < 0.03


def test_mix_of_nothing(spark):
    assert mixing.mix(documents(spark, [])).count() == 0
    blank = [(i, None, None) for i in range(3)] + [(9, " ", "a")]
    got = mixing.mix(documents(spark, blank)).collect()
    assert len(got) == 4 and all(r["taken"] == 0 and r["target"] == 0 for r in got)


# --- WARC ----------------------------------------------------------------------------

PAGES = "page_id bigint, url string, html string, `row` string, id string, payload string, n int, sha1 string, of string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "x", "x", 1, "x", "x") for i, u, h in rows], PAGES)


def page_rows():
    big, other = "<p>große Seite</p>" * 100, "y" * 1000
    return [(1, "http://a/", big), (2, None, big), (3, "http://c/\r\nX: y", big), (4, "", None), (5, "u", ""),
            (6, "http://f/", "small"), (7, "http://g/", "small"), (8, "http://h", other), (None, "http://i", other),
            (9, "http://j", "z" * 999), (10, "http://k", "z" * 999), (11, "u", "é" * 600), (11, "u", "é" * 600),
            (12, "u", "long " * 400_000), (13, "http://m", "WARC/1.1\r\n\r\n" * 90)]


def test_warc_round_trip(spark):
    rows = page_rows()
    path = shared_path(spark, "archives")
    warc.write(pages(spark, rows), path)
    got = warc.inventory(warc.read(spark, path)).collect()
    groups = defaultdict(list)
    for i, _, h in rows:
        groups[h or ""].append(i)
    want = []
    for h, ids in groups.items():
        data, many = h.encode(), len(h.encode()) >= 1000
        ids = sorted(ids, key=lambda x: -1 if x is None else x)
        for k, i in enumerate(ids):
            first = not many or k == len(ids) - 1
            want.append((str(i), len(data), hashlib.sha1(data).hexdigest(), "response" if first else "revisit",
                         None if first else ids[-1]))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, got)) == sorted(map(key, want))


@pytest.mark.parametrize("plan", ["scan", "repartition", "union", "join"])
def test_warc_of_any_plan(spark, tmp_path, plan):
    """Rows numbered by another plan than the one that reads them must not lose payloads."""
    rows = [(i, f"http://h/{i}", f"{'x' * 1500}{i % 20}") for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    if plan == "scan":
        pages.repartition(3).write.parquet(str(tmp_path / "pages"))
        pages = spark.read.parquet(str(tmp_path / "pages"))
    elif plan == "repartition":
        pages = pages.repartition(5)
    elif plan == "union":
        pages = pages.where("page_id % 2 = 0").unionByName(pages.where("page_id % 2 = 1").repartition(3))
    else:
        pages = pages.join(spark.range(400).withColumnRenamed("id", "page_id"), "page_id")
    path = shared_path(spark, "archives")
    warc.write(pages, path, archive_bytes=20_000)
    got = warc.inventory(warc.read(spark, path)).collect()
    assert sorted((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got
                  ) == [(i, len(h), hashlib.sha1(h.encode()).hexdigest(), "response" if i >= 380 else "revisit",
                         None if i >= 380 else 380 + i % 20) for i, _, h in rows]


def test_archive_frames(spark):
    """A leading skippable frame with the dictionary, a frame per record, and nothing
    but empty skippable frames between them; the payloads come back whole."""
    path = shared_path(spark, "archives")
    rows = [(i, f"http://h/{i}", f"<html>{'common text ' * 30}{i}</html>") for i in range(300)]
    warc.write(pages(spark, rows).coalesce(1), path)
    [(content,)] = spark.read.format("binaryFile").load(path).select("content").collect()
    content = bytes(content)
    size = int.from_bytes(content[4:8], "little")
    assert content[:4] == bytes.fromhex("5D2A4D18")
    dictionary = zstandard.ZstdCompressionDict(content[8:8 + size])
    assert dictionary.dict_id()
    parts = content[8 + size:].split(warc.SEPARATOR.encode())
    whole = [p for p in parts if p]
    assert len(whole) == 300
    # each frame decompresses by itself, and the dictionary pays
    found = [zstandard.ZstdDecompressor(dict_data=dictionary).decompress(p) for p in whole]
    assert all(x.startswith(b"WARC/1.1\r\n") for x in found)
    assert sum(map(len, whole)) < 0.5 * sum(len(zstandard.ZstdCompressor().compress(x)) for x in found)
    back = {r["record_id"]: bytes(r["payload"]).decode() for r in warc.read(spark, path).collect()}
    assert sorted(back.values()) == sorted(h for _, _, h in rows)


def test_warc_of_nothing(spark):
    path = shared_path(spark, "archives")
    warc.write(pages(spark, []), path)
    assert warc.read(spark, path).count() == 0
    assert list(warc.records(b"")) == []


# --- URL verdicts --------------------------------------------------------------------

def brute_verdicts(rows, threshold=0.5, damping=0.85, turns=200):
    judged, trust, blocked, links = [], defaultdict(float), defaultdict(float), defaultdict(float)
    for i, u, html in rows:
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            host = re.split("[/?#]", rest)[0]
            path = re.split("[?#]", rest[len(host):])[0]
            host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule = max(fits) if fits else None
        judged.append((i, host, path, rule))
        if rule and host:
            (trust if rule[2] == "allow" else blocked)[host] += 1
        for link in re.findall(r"""href\s*=\s*["']?([^"'\s>]+)""", html or "", re.I):
            m = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]+)", link)
            there = m[1].lower() if m else ""
            if host and there and there != host:
                links[host, there] += 1

    def rank(seeds, edges):
        whole = sum(seeds.values())
        if not whole:
            return defaultdict(float)
        seeds = {h: n / whole for h, n in seeds.items()}
        out = defaultdict(float)
        for (a, _), n in edges.items():
            out[a] += n
        r = defaultdict(float, seeds)
        for _ in range(turns):
            new = defaultdict(float)
            for (a, b), n in edges.items():
                new[b] += damping * r[a] * n / out[a]
            home = 1 - sum(new.values())
            for h, s in seeds.items():
                new[h] += s * home
            r = new
        return r

    t, d = rank(trust, links), rank(blocked, {(b, a): n for (a, b), n in links.items()})
    out = []
    for i, host, path, rule in judged:
        both = t[host] + d[host]
        verdict = rule[2] if rule else "block" if both > 0 and d[host] / both >= threshold else "allow"
        out.append((str(i), host, path, rule[1] if rule else None, verdict, t[host], d[host]))
    return out


def test_verdicts_with_links(spark):
    rows = [(1, "http://good.com/x", '<a href="http://mid.org/">'), (2, "http://mid.org/a", "<A HREF='//Shop.org/x?y'>"),
            (3, "http://bad.net/es/1", "<a href=http://x.org>"), (4, "http://lists.org/", '<a href="http://bad.net/fr/">' * 3),
            (5, "http://lists.org/b", '<a href="/own">'), (6, "http://shop.org", None), (7, None, "<a href='http://mid.org'>"),
            (8, "no host", ""), (9, "HTTP://WWW.Example.COM/en/?q#f", ""), (10, "http://a.example.com/en/x", ""),
            (11, "http://example.com/EN/", ""), (12, "ftp://bad.net/de/", '<a href="http://lists.org">'),
            (13, "http://notnet/es/", ""), (14, "://", ""), (15, "http://x.org#a://b", "mailto"), (15, "http://x.org#a://b", "mailto"),
            (None, "http://good.com", '<a href="http://lists.org">'), (16, "http://far.org/", '<a href="http://lists.org/">')]
    got = linkrank.verdicts(pages(spark, rows), RULES, turns=200, precision=1e-12).collect()
    want = brute_verdicts(rows)
    key = lambda r: tuple(map(str, r[:5]))
    assert sorted(map(key, got)) == sorted(map(key, want))
    by_host = {r[1]: r for r in want}
    for r in got:
        if r["host"]:
            assert math.isclose(r["trust"], by_host[r["host"]][5], abs_tol=1e-6)
            assert math.isclose(r["distrust"], by_host[r["host"]][6], abs_tol=1e-6)
    assert {r["verdict"] for r in got if r["host"] == "lists.org"} == {"block"}  # links to a blocked host
    assert {r["verdict"] for r in got if r["host"] == "mid.org"} == {"allow"}
    assert linkrank.verdicts(pages(spark, []), RULES).count() == 0


def seeds_of(spark, rows):
    return spark.createDataFrame(rows, "host string, trusted long, blocked long")


def links_of(spark, rows):
    return spark.createDataFrame(rows, "source string, target string, n long")


def test_ranks_reach_the_end_of_a_chain(spark):
    n = 46  # each host links to the next, the last one to the blocked host
    chain = [(f"h{i}", f"h{i + 1}", 1) for i in range(n)]
    ranks = {r["host"]: r for r in linkrank.propagate(
        links_of(spark, chain), seeds_of(spark, [(f"h{n}", 0, 1), ("far", 5, 0)])).collect()}
    for i in range(n):
        assert ranks[f"h{i}"]["trust"] == 0
        assert math.isclose(ranks[f"h{i}"]["distrust"], 0.85 * ranks[f"h{i + 1}"]["distrust"], rel_tol=1e-5)
    assert ranks["h0"]["distrust"] > 0


def test_verdicts_of_few_links_beside_many_seeds(spark):
    links = [("a.org", "bad.net", 1), ("b.org", "a.org", 1), ("c.org", "b.org", 1)]
    seeds = [("bad.net", 0, 1), ("alone.net", 0, 1 << 33), ("alone.com", 1 << 33, 0)]
    ranks = {r["host"]: r["distrust"] for r in linkrank.propagate(
        links_of(spark, links), seeds_of(spark, seeds)).collect()}
    assert ranks["a.org"] > ranks["b.org"] > ranks["c.org"] > 0
    assert math.isclose(ranks["c.org"], 0.85 ** 3 * ranks["bad.net"], rel_tol=1e-5)


# --- nearest neighbours --------------------------------------------------------------

def vector_rows():
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(600)]
    rows[40:140] = [(i, rows[40][1]) for i in range(40, 140)]  # equal vectors
    rows += [(1000, None), (1100, []), (1200, [0.0] * 8), (1300, [1.0] * 7 + [None]),
             (1400, [1.0] * 7 + [float("nan")]), (1500, [1.0] * 7 + [float("inf")]), (1600, [1.0, 2.0]),
             (None, [1.0] * 8), (1700, rows[3][1]), (1700, rows[3][1]), (1800, rows[5][1]), (5, rows[5][1])]
    return rows


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "x") for i, v in rows],
                                 "vec_id bigint, embedding array<float>, label int, v string, ids string")


def brute_neighbours(rows, every, k):
    usable = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)
              and any(v)}
    out = {}
    for q, v in usable:
        if q % every == 0:
            near = {}
            for i, w in usable:
                if i != q and len(w) == len(v):
                    d = float(np.sqrt(((np.array(w, dtype=np.float64) - np.array(v, dtype=np.float64)) ** 2).sum()))
                    near[i] = min(d, near.get(i, d))
            out[q] = sorted((d, i) for i, d in near.items())[:k]
    return out


@pytest.mark.parametrize("options", [{"width": 50.0}, {"cell": 20}])
def test_search(spark, tmp_path, options):
    path = str(tmp_path / "v.parquet")
    rows = vector_rows()
    vectors(spark, rows).repartition(3).write.parquet(path)
    got = defaultdict(list)
    for r in sorted(ann.search(spark.read.parquet(path), every=20, **options).collect(), key=lambda r: r["rank"]):
        got[r["query_id"]].append((r["score"], r["vec_id"]))
        assert r["rank"] == len(got[r["query_id"]])
    want = brute_neighbours(rows, 20, 10)
    assert set(got) == {q for q in want if want[q]}
    found = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in got)
    assert found / sum(map(len, want.values())) >= (1.0 if "width" in options else 0.9)
    for q in got:
        assert got[q] == sorted(got[q]) and len(got[q]) == len(want[q])
        if "width" in options:  # one bucket holds all: exact, ties included
            assert [i for _, i in got[q]] == [i for _, i in want[q]]
            assert np.allclose([d for d, _ in got[q]], [d for d, _ in want[q]])


def test_few_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 9.0]), (2, [-50.0, 1.0])]
    got = ann.search(vectors(spark, rows), every=2).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["vec_id"]) for r in got] == [(0, 1), (0, 2), (2, 1), (2, 0)]
    assert ann.search(vectors(spark, [])).count() == 0
    assert ann.search(vectors(spark, [(0, [1.0])])).count() == 0


def test_probes_come_in_order_of_cost():
    place = np.array([3.2, -1.9, 0.5])
    home, seen = np.floor(place), []
    for there in ann.probes(place, 27):
        move = there - home
        cost = sum((place[i] - home[i]) ** 2 if m < 0 else (1 - place[i] + home[i]) ** 2 for i, m in enumerate(move) if m)
        seen.append((cost, tuple(move)))
    assert len(set(seen)) == 27 and [c for c, _ in seen] == sorted(c for c, _ in seen)


# --- the queries and the pipeline ----------------------------------------------------

@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(SQL[name])
    columns = [c[0] for c in cur.description]
    got = [tuple(r) for r in QUERIES[name](spark, SF).select(*columns).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, got)) == sorted(map(key, cur.fetchall()))


def test_recall_on_the_benchmark_vectors(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
            .select("vec_id", "embedding").collect()]
    got = defaultdict(set)
    for r in QUERIES["op6_ann"](spark, "/root/testdata/sf0.01").collect():
        got[r["query_id"]].add(r["vec_id"])
    want = brute_neighbours(rows, 100, 10)
    assert sum(len(got[q] & {i for _, i in want[q]}) for q in want) / sum(map(len, want.values())) >= 0.9


def test_pipeline(spark):
    """Every stage against what the stage before it kept."""
    import corpus_pipeline
    from stellata.llm import bpe  # noqa: F401
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "simhash_near_dedup", "mixing", "byte_level_bpe"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        path = shared_path(spark, name)
        stage(spark, docs, SF).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        kept[name] = docs.count()
        if name != names[-1]:
            assert docs.columns == before.columns
        if name == "exact_dedup":
            clean = {re.sub(r"[\x20\x09-\x0D]", "", r[0] or "") for r in before.select("text").collect()}
            assert kept[name] == len(clean)
        if name in ("toxicity", "exact_dedup", "simhash_near_dedup"):
            ids = [r[0] for r in docs.select("doc_id").collect()]
            assert len(ids) == len(set(ids)) and set(ids) <= {r[0] for r in before.select("doc_id").collect()}
    assert kept["byte_level_bpe"] == kept["mixing"]
    total = corpus_pipeline.run(spark, SF)
    last = sorted(map(tuple, docs.collect()))
    assert sorted(map(tuple, total.select(*docs.columns).collect())) == last
