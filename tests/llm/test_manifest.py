"""Merkle manifest and importance resampling against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from cases import documents, prose, table, texts
from pyspark.sql import functions as F

from stellata.llm import merkle, resample
from stellata.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# --- Merkle manifest -----------------------------------------------------------------

def brute_tree(leaves, arity):
    """(root, for each leaf the siblings up to the root)."""
    proofs, where, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for i, p in enumerate(where):
            run = range(p // arity * arity, min(p // arity * arity + arity, len(nodes)))
            proofs[i] += [nodes[q] for q in run if q != p]
            where[i] = p // arity
        nodes = [H(*nodes[p:p + arity]) for p in range(0, len(nodes), arity)]
    return nodes[0], proofs


def brute_leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def brute_manifest(rows, arity=3):
    """(id, leaf, subroot, root, proof digest), sorted as text."""
    groups = defaultdict(list)
    for i, t, s in rows:
        groups[s].append((i is not None, i or 0, brute_leaf((i, s, "en", None if t is None else len(t), t)), i))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (sorted(groups[s], key=lambda x: x[:3])) for s in names}
    lower = {s: brute_tree([x[2] for x in trees[s]], arity) for s in names}
    root, upper = brute_tree([lower[s][0] for s in names], arity)
    return sorted(
        (str(x[3]), x[2], lower[s][0], root, H(*(lower[s][1][k] + upper[names.index(s)])))
        for s in names for k, x in enumerate(trees[s]))


def found(spark_rows, arity=3):
    got = merkle.verify(spark_rows, arity=arity).collect()
    assert all(r["folded"] == r["t_top"] for r in got)
    return sorted((str(r["id"]), r["hash"].hex(), r["top"].hex(), r["t_top"].hex(), r["proof_sha256"]) for r in got)


@pytest.mark.parametrize("options", [
    {}, {"block_bits": 2, "span": 2, "requests": 1}, {"arity": 2, "block_bits": 4}])
def test_manifest(spark, tmp_path, options):
    rows = texts() + [(1000 + i, f"line {i}", "hot") for i in range(150)] + [(7, "x", f"s{i}") for i in range(13)]
    docs = table(spark, tmp_path, rows)
    arity = options.get("arity", 3)
    assert found(merkle.manifest(docs, **options), arity) == brute_manifest(rows, arity)


def test_manifest_of_any_plan(spark):
    rows = texts()
    docs = documents(spark, rows)
    joined = docs.repartition(5).join(spark.range(1).select(F.lit("en").alias("lang")), "lang").unionByName(docs.limit(0))
    assert found(merkle.manifest(joined)) == brute_manifest(rows)


def test_manifest_of_one_and_none(spark):
    assert found(merkle.manifest(documents(spark, [(1, "a", None)]))) == brute_manifest([(1, "a", None)])
    assert merkle.verify(merkle.manifest(documents(spark, []))).collect() == []


def test_tampering_shows(spark, tmp_path):
    rows = [(i, "a\nb" if i % 3 else "ab", "s") for i in range(40)] + [(None, None, None)]
    docs = table(spark, tmp_path, rows)
    bent = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    got = merkle.verify(merkle.manifest(docs, other={"text": bent}), "other").collect()
    assert all((r["folded"] == r["t_top"]) == (r["id"] is None or r["id"] % 3 == 0) for r in got)


def test_block_arithmetic():
    """Nodes inside blocks, what a block lacks, and the proofs derived from both."""
    rng = np.random.default_rng(3)
    for n in [1, 2, 3, 4, 9, 10, 28, 100]:
        leaves = [hashlib.sha256(bytes([i])).hexdigest().encode() for i in range(n)]
        for arity in (2, 3, 5):
            root, proofs = brute_tree([x.decode() for x in leaves], arity)
            levels, nodes = {}, leaves
            for level in range(20):
                levels |= {(level, p): h for p, h in enumerate(nodes)}
                if len(nodes) == 1:
                    break
                nodes = [H(*[x.decode() for x in nodes[p:p + arity]]).encode() for p in range(0, len(nodes), arity)]
            first = int(rng.integers(0, n))
            count = int(rng.integers(1, n - first + 1))
            inside = merkle.covered(first, leaves[first:first + count], n, arity)
            assert all(levels[level, p] == h for level, p, h in inside)
            lacking = merkle.missing(first, count, n, arity)
            known = {(level, p) for level, p, _ in inside}
            assert not known & set(lacking) and len(lacking) <= 2 * (arity - 1) * 20
            top, got = merkle.expanded(first, leaves[first:first + count], n, {c: levels[c] for c in lacking}, arity)
            assert top.decode() == root
            assert [p.hex() for p in got] == ["".join(x) for x in proofs[first:first + count]]


# --- resampling ----------------------------------------------------------------------

def brute_words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w]


def brute_features(text, longest):
    words = brute_words(text)
    return [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute_resample(rows, target, longest, buckets, percent, least):
    def counts(all_texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in all_texts for f in brute_features(t, longest))

    s, t = counts(x[1] for x in rows), counts(target)
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    out = []
    for i, text, _ in rows:
        f = brute_features(text, longest)
        g = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t)))
             for b in (zlib.crc32(x.encode()) % buckets for x in f)]
        weight = sum(g) // len(g) if g else 0
        h = int(H(f"2024:{'' if i is None else i}")[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(brute_words(text)), len(f), weight, score))
    able = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], x[0] is None, x[0] or 0, x[2], x[3]))
    rank = {}
    for k, x in enumerate(able[:len(able) * percent // 100]):
        rank.setdefault(x, []).append(k + 1)
    return sorted(((*x, (rank.get(x) or [None]).pop(0) if rank.get(x) else None) for x in out), key=str)


@pytest.mark.parametrize("longest,buckets,percent,least", [(1, 10_000, 10, 20), (3, 97, 60, 1), (2, 10_000, 100, 0)])
def test_resample(spark, tmp_path, longest, buckets, percent, least):
    rows = texts() + [(900, "A" * 50 + "\x00b-C3po " + "é" * 3, "a"), (901, "--", "a"), (None, prose_of(40), "a")]
    target = ["Stone river", None, "", "the garden; the GARDEN"]
    docs = table(spark, tmp_path, rows)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.resample(docs, bench, longest=longest, buckets=buckets, percent=percent, least=least).collect()
    want = brute_resample(rows, target, longest, buckets, percent, least)
    assert sorted(((r["id"], r["n_words"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in got),
                  key=str) == want


def prose_of(n):
    import random
    return prose(random.Random(9), n)


def test_features_of_shifted_indices():
    texts_ = ["a b  a b c", "", "x", ",a", "b c "]
    for n, (at, code, crc) in enumerate(resample.features(pa.array(texts_, pa.string()), 3), 1):
        want = [[zlib.crc32(" ".join(w[i:i + n]).encode()) for i in range(len(w) - n + 1)] for w in map(brute_words, texts_)]
        assert [crc[code[a:b]].tolist() for a, b in zip(at[:-1], at[1:])] == want


def test_resample_of_nothing(spark, tmp_path):
    bench = spark.createDataFrame([("a b",)], "text string")
    assert resample.resample(documents(spark, []), bench).collect() == []
    got = resample.resample(table(spark, tmp_path), bench.limit(0)).collect()
    assert len(got) == len(texts())
    ranks = sorted(r["rank"] for r in got if r["rank"])
    assert ranks == list(range(1, len(ranks) + 1))


@pytest.mark.parametrize("name", ["op12_resample", "op13_merkle"])
def test_new_queries_equal_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    want = con.execute(SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(want.fetchall(), key=str)
