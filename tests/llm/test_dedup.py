"""Exact, SimHash and byte-string duplicates against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import uuid
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from cases import documents, prose, table, texts
from pyspark.sql import functions as F

from stellata.llm import common, exact_dedup, mixing, simhash, suffix_dedup
from stellata.llm.common import with_row
from stellata.llm.components import connected


def clean(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


# --- exact ---------------------------------------------------------------------------

def check_classes(rows, got):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[clean(t)].append((-len(t or ""), i is None, i or 0, i))
    want = sorted((str(i), str(min(groups[clean(t)])[3]), len(groups[clean(t)]),
                   hashlib.sha256(clean(t).encode()).hexdigest()) for i, t, _ in rows)
    assert sorted((str(r["id"]), str(r["keep_id"]), r["group_size"], r["sha256"]) for r in got) == want
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(groups)
    assert all(str(r["id"]) == str(r["keep_id"]) for r in kept)


@pytest.mark.parametrize("options", [
    {}, {"chunk": 64, "block": 32},
    # so small a modulus that different texts share fingerprints: the comparison tells them apart
    {"moduli": ((3, 2), (2, 1)), "block": 64}])
def test_exact_classes(spark, tmp_path, options):
    docs = table(spark, tmp_path)
    check_classes(texts(), exact_dedup.classes(docs, **options).collect())


def test_exact_stage_keeps_columns_and_one_of_each(spark, tmp_path):
    docs = table(spark, tmp_path)
    out = exact_dedup.distinct_documents(docs)
    assert out.columns == docs.columns
    assert out.count() == len({clean(t) for _, t, _ in texts()})


def test_hash_composes():
    run = exact_dedup._hasher(2147483647, 1000003, part=8)
    data = bytes(range(256)) * 3
    whole, _ = run(data)
    for cut in (0, 1, 7, 8, 100, len(data)):
        (a, _), (b, shift) = run(data[:cut]), run(data[cut:])
        assert (a * shift + b) % 2147483647 == whole
    assert run(b"\0") != run(b"\0\0")  # the length counts


# --- SimHash -------------------------------------------------------------------------

def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(points, distance=4):
    root = list(range(len(points)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(points)):
        for j in range(i):
            if (points[i] ^ points[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(points))]


def test_simhash_groups(spark, tmp_path):
    rows = texts()
    docs = table(spark, tmp_path)
    got = simhash.groups(docs, cell=3).collect()
    prints = [brute_fingerprint(t) for _, t, _ in rows]
    group = brute_components(prints)
    least = {}
    for g, (i, _, _) in zip(group, rows):
        least[g] = min(least.get(g, float("inf")), float("inf") if i is None else i)
    name = lambda x: "None" if x in (None, float("inf")) else str(x)
    want = sorted((name(i), f, name(least[g])) for (i, _, _), f, g in zip(rows, prints, group))
    assert sorted((name(r["id"]), r["fp"] % 2 ** 64, name(r["component_id"])) for r in got) == want
    assert sum(r["first"] for r in got) == len(set(group))
    out = simhash.representatives(docs)
    assert out.columns == docs.columns and out.count() == len(set(group))


def test_links_at_every_distance(spark):
    """Pairs at 0 to 9 differing bits, in any bits, link exactly up to the threshold; a
    dense ball of near points falls into few cells, which are split."""
    rng = np.random.default_rng(3)
    points = set()
    for _ in range(60):
        p = int(rng.integers(0, 2 ** 63))
        points.add(p)
        for d in range(1, 10):
            q = p
            for b in rng.choice(64, d, replace=False).tolist():
                q ^= 1 << b
            points.add(q)
    ball = int(rng.integers(0, 2 ** 63))
    points |= {ball ^ (1 << b) ^ (1 << c) for b in range(24) for c in range(b)}
    points = sorted(points)
    signed = [p - 2 ** 64 if p >= 2 ** 63 else p for p in points]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    edges = simhash.links(df, cell=40).collect()
    index = {p: i for i, p in enumerate(signed)}
    assert all((points[index[r["a"]]] ^ points[index[r["b"]]]).bit_count() <= 64 for r in edges)
    root = list(range(len(points)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in edges:
        a, b = find(index[r["a"]]), find(index[r["b"]])
        root[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(points))] == brute_components(points)


def test_links_of_cells_with_one_member(spark):
    rng = np.random.default_rng(8)
    fps = set()
    for base in rng.integers(0, 1 << 63, 30).tolist():
        fps |= {base, base ^ (1 << int(rng.integers(0, 63)))}
    df = spark.createDataFrame([(x,) for x in sorted(fps)], "fp long")
    found = connected(simhash.links(df, cell=1)).collect()
    assert {r["node"] for r in found} == fps  # every fingerprint has its pair


def test_golay_code_is_perfect():
    words = np.arange(1 << 23, dtype=np.uint32)[::97]
    table_, n = simhash._patterns(3)
    assert table_.shape[1] == 1 and (n == 1).all()  # one leader of weight <= 3 per syndrome
    anchors = words ^ table_[simhash._syndrome(words)][:, 0]
    assert (simhash._syndrome(anchors) == 0).all()
    assert np.bitwise_count(anchors ^ words).max() <= 3


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 3), (9, 8), (8, 7), (7, 9), (5, 5)] + [(100 + i, 101 + i) for i in range(40)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in connected(df).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7, **{100 + i: 100 for i in range(41)}}
    assert connected(df.where("false")).count() == 0


# --- repeated byte strings -----------------------------------------------------------

def brute_removal(rows, window):
    data = [(float("inf") if i is None else i, (t or "").encode()) for i, t, _ in rows]
    first = {}
    for i, b in data:
        for p in range(len(b) - window + 1):
            g = b[p:p + window]
            first[g] = min(first.get(g, i), i)
    out = []
    for (i, b), (key, _, _) in zip(data, rows):
        gone = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - window + 1):
            if first[b[p:p + window]] < i:
                gone[p:p + window] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        kept = bytes(np.frombuffer(b, dtype=np.uint8)[~gone])
        out.append((str(key), len(b), int(gone.sum()), len(edges) // 2, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"chunk_rows": 4, "key_bytes": 1000, "piece_bytes": 500}])
def test_suffix_dedup(spark, tmp_path, options):
    rows = [r if r[1] is None or len(r[1]) < 100_000 else (r[0], r[1][:9000] + r[1][-200:], r[2]) for r in texts()]
    got = suffix_dedup.report(suffix_dedup.remove_repeats(table(spark, tmp_path, rows), **options)).collect()
    assert sorted((str(r["id"]), *[r[c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")])
                  for r in got) == brute_removal(rows, 50)


@pytest.mark.parametrize("options", [{"hot_bytes": 0}, {"hot_bytes": 0, "chunk_rows": 4, "piece_bytes": 500},
                                     {"hot_bytes": 300, "chunk_rows": 4, "key_bytes": 1000, "piece_bytes": 500}])
def test_suffix_dedup_with_hot_keys(spark, tmp_path, options):
    rows = [r if r[1] is None or len(r[1]) < 100_000 else (r[0], r[1][:900] + r[1][-200:], r[2]) for r in texts()]
    rng = random.Random(3)
    rows += [(500 + i, prose(rng, 9) + " a boilerplate fragment " + prose(rng, 9 if i % 3 else 2), "a") for i in range(40)]
    rows += [(600 + i, rows[-7][1][5:] + rows[-9][1], "a") for i in range(3)]
    got = suffix_dedup.report(suffix_dedup.remove_repeats(table(spark, tmp_path, rows), **options)).collect()
    assert sorted((str(r["id"]), *[r[c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")])
                  for r in got) == brute_removal(rows, 50)


def test_a_hot_string_spreads_over_parts(spark, monkeypatch, tmp_path):
    """A short string in every document, with other neighbours each time: no part of the
    last sort gets more than a few of its pieces."""
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    some = lambda: "".join(rng.choice(letters) for _ in range(60))
    rows = [(i, some() + '<a href="https://www.example.org/">' + some(), "a") for i in range(600)]
    rows += [(1000 + i, rows[i][1][40:110], "a") for i in range(0, 600, 20)]
    sort_pieces, seen = suffix_dedup._sort_pieces, str(tmp_path)

    def watched(*options):
        run, schema = sort_pieces(*options)

        def sort(table):
            with open(f"{seen}/{uuid.uuid4().hex}", "w") as f:
                f.write(str(sum(len(x.as_py()) for x in table.column("bytes"))))
            return run(table)
        return sort, schema

    monkeypatch.setattr(suffix_dedup, "_sort_pieces", watched)
    got = suffix_dedup.report(suffix_dedup.remove_repeats(
        documents(spark, rows), chunk_rows=16, piece_bytes=2000, hot_bytes=2000)).collect()
    assert sorted((str(r["id"]), *[r[c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")])
                  for r in got) == brute_removal(rows, 50)
    assert 0 < max(int(x.read_text()) for x in tmp_path.iterdir()) < 15_000  # one key's pieces were over 40,000 bytes


def test_suffix_array():
    rng = np.random.default_rng(1)
    for n in range(60):
        s = rng.integers(1, rng.choice([2, 3, 200]), n)
        assert suffix_dedup.suffix_array(s).tolist() == sorted(range(n), key=lambda i: s[i:].tolist())


@pytest.mark.parametrize("run", [
    lambda d: exact_dedup.classes(d), lambda d: exact_dedup.distinct_documents(d), lambda d: simhash.groups(d),
    lambda d: simhash.representatives(d), lambda d: suffix_dedup.remove_repeats(d)])
def test_empty_tables(spark, run):
    assert run(documents(spark, [])).count() == 0


# --- row numbers ---------------------------------------------------------------------

@pytest.fixture
def splits(spark):
    """A function that changes how the next scans are split."""
    names = {"spark.sql.files.minPartitionNum": "1", "spark.sql.files.openCostInBytes": "1"}
    cores = {"spark.sql.files.minPartitionNum": "64", "spark.sql.files.openCostInBytes": "4m"}

    def use(changed):
        for k, v in (cores if changed else names).items():
            spark.conf.set(k, v)

    use(False)
    yield use
    for k in names:
        spark.conf.unset(k)


def test_row_numbers_do_not_follow_the_splits(spark, tmp_path, splits):
    docs, row = with_row(table(spark, tmp_path, parts=6))
    here = docs.select(row, "doc_id", "text")
    before = here.collect()
    splits(True)
    assert sorted(map(str, docs.select(row, "doc_id", "text").collect())) == sorted(map(str, before))
    assert len({r[0] for r in before}) == len(texts())
    shuffled, row = with_row(docs.orderBy(F.rand()))  # not a scan of a table
    assert shuffled.select(row, "doc_id", "text").collect() == shuffled.select(row, "doc_id", "text").collect()


@pytest.mark.parametrize("run", [exact_dedup.distinct_documents, simhash.representatives, mixing.mixture])
def test_stages_with_other_splits_later(spark, tmp_path, splits, run):
    docs = table(spark, tmp_path, parts=6)
    want = sorted(map(str, run(docs).select("doc_id", "text").collect()))
    out = run(docs).select("doc_id", "text")
    splits(True)  # the last scan is planned now
    assert sorted(map(str, out.collect())) == want


@pytest.mark.parametrize("run", [exact_dedup.distinct_documents, simhash.representatives, mixing.mixture])
def test_stages_do_not_sort_whole_rows(spark, tmp_path, run):
    """The few bytes known of a row are hashed, and whole rows with their texts stream past them."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = run(table(spark, tmp_path, parts=6))._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "ShuffledHashJoin [__row" in plan and "SortMergeJoin [__row" not in plan


def test_tasks_give_their_memory_back(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "release", lambda: calls.append("released"))

    def run(batches):
        for batch in batches:
            calls.append(batch)
            yield -batch

    assert list(common.tidy(run)([1, 2])) == [-1, -2]
    assert calls == [1, 2, "released"]
    monkeypatch.undo()
    common.release()


def test_suffix_dedup_with_other_splits_later(spark, tmp_path, splits):
    rows = [r for r in texts() if len(r[1] or "") < 100_000]
    out = suffix_dedup.report(suffix_dedup.remove_repeats(table(spark, tmp_path, rows, parts=6), chunk_rows=4))
    splits(True)
    assert sorted((str(r["id"]), *[r[c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")])
                  for r in out.collect()) == brute_removal(rows, 50)


def test_copies_do_not_make_a_key_hot():
    """Equal pieces of a key count once, however many chunks hold them; different ones add up."""
    rng = random.Random(6)
    passage = prose(rng, 40).encode()
    copies = [[passage] for _ in range(60)]
    varied = [[prose(rng, 9).encode() + b" one string that is the same among others " + prose(rng, 9).encode()] for _ in range(60)]

    def most(chunks):
        rows = []
        for chunk, texts_ in enumerate(chunks):
            _, _, length, keys, tags = suffix_dedup._runs(texts_, 50, 16, hashed=True)
            rows += suffix_dedup._key_rows(1, chunk, keys, np.full(len(keys), chunk),
                                           lambda order, edge: suffix_dedup._pieces_of_keys(
                                               (length + 49)[order], tags[order], edge))
        table_ = pa.table([pa.array(c, t) for c, t in zip(zip(*rows), suffix_dedup._KEY_TYPES)],
                          names=suffix_dedup._KEY_NAMES)
        for bound in (100, 200, 400, 800, 1600, 3200, 6400):
            if not any(len(x.as_py()) for x in suffix_dedup._shared_keys(bound)(table_).column("hot")):
                return bound

    assert most(copies) <= 400 < 1600 <= most(varied)


def test_pieces_alone_in_their_key_and_sorted_ones_agree(spark, tmp_path):
    """A passage that only whole copies hold (not sorted) beside ones cut at any place (sorted)."""
    rng = random.Random(8)
    whole, cut = prose(rng, 60), prose(rng, 60)
    rows = [(i, whole, "a") for i in (9, 3, 7)]
    rows += [(20 + i, prose(rng, 5) + cut[i:90 + 7 * i] + prose(rng, 5), "a") for i in range(20)]
    got = suffix_dedup.report(suffix_dedup.remove_repeats(table(spark, tmp_path, rows), chunk_rows=4)).collect()
    assert sorted((str(r["id"]), *[r[c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")])
                  for r in got) == brute_removal(rows, 50)


def test_hot_keys_do_not_deal_the_documents_out_again(spark, monkeypatch):
    """The documents are dealt by chunk to send pieces and to lose bytes, whether there are hot keys or not."""
    rng = random.Random(10)
    rows = [(i, prose(rng, 9) + " one string that is the same among others " + prose(rng, 9), "a") for i in range(40)]
    rows += [(100 + i, rows[i][1][20:110], "a") for i in range(0, 40, 4)]
    docs = documents(spark, rows)
    grouped = type(docs.groupBy("doc_id"))
    cogroup, calls = grouped.cogroup, []
    monkeypatch.setattr(grouped, "cogroup", lambda self, other: calls.append(1) or cogroup(self, other))
    for hot_bytes in (1 << 20, 300, 0):
        got = suffix_dedup.report(suffix_dedup.remove_repeats(docs, chunk_rows=4, hot_bytes=hot_bytes)).collect()
        assert sorted((str(r["id"]), *[r[c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")])
                      for r in got) == brute_removal(rows, 50)
    assert len(calls) == 3 * 2


def test_keys_and_pieces_travel_short():
    """A chunk gets 4 bytes a shared key and sends less than the bytes of its pieces; a key that is
    taken for a shared one changes nothing."""
    rng = random.Random(12)
    common = prose(rng, 30)
    texts_ = [(prose(rng, 12) + common[i % 7:] + prose(rng, 12)).encode() for i in range(24)]
    docs = [pa.table({"chunk": [c] * 6, "row": range(6 * c, 6 * c + 6), "id": range(6 * c, 6 * c + 6),
                      "text": pa.array(texts_[6 * c:6 * c + 6], pa.binary())}) for c in range(4)]
    send_keys = suffix_dedup._send_keys(1, 50, 16)
    keys = pa.concat_tables(pa.Table.from_batches(list(send_keys(x.to_batches()))) for x in docs)
    shared = suffix_dedup._shared_keys(1 << 20)(keys)
    mine = [set(np.frombuffer(x.as_py(), dtype=np.uint64).tolist()) for x in keys.column("keys")]
    assert [len(x.as_py()) for x in shared.column("keys")] == [
        4 * len(k & set().union(*mine[:c], *mine[c + 1:])) for c, k in enumerate(mine)]
    send, _ = suffix_dedup._send_pieces(1, 50, 16)
    sort, _ = suffix_dedup._sort_pieces(50, 16)
    remove, _ = suffix_dedup._remove(50, 16, "bigint")
    every = keys.select(["chunk"]).append_column("keys", pa.array(
        [np.frombuffer(x.as_py(), dtype=np.uint64).astype(np.uint32).tobytes() for x in keys.column("keys")]))
    every = every.append_column("hot", pa.array([b""] * 4)).append_column("windows", pa.array([b""] * 4))
    some = every.set_column(1, "keys", shared.column("keys"))
    out = []
    for told in (some, every):
        pieces = [send(d, told.slice(c, 1)) for c, d in enumerate(docs)]
        runs = suffix_dedup._runs(texts_, 50, 16)
        if told is every:
            assert sum(x.nbytes for x in pieces) < int((runs[2] + 49).sum())
        found = sort(pa.concat_tables(pieces))
        kept = [remove(d, found.filter(pa.array(np.asarray(found.column("chunk")) == c))) for c, d in enumerate(docs)]
        out.append([x.as_py() for k in kept for x in k.column("kept")])
    assert out[0] == out[1]
    assert [hashlib.sha256(x).hexdigest() for x in out[0]] == [
        r[4] for r in sorted(brute_removal([(i, t.decode(), "a") for i, t in enumerate(texts_)], 50), key=lambda r: int(r[0]))]


def chunks_of(texts_, each):
    """Tables of documents as chunks, the id being the row."""
    return [pa.table({"chunk": [c] * len(t), "row": range(c * each, c * each + len(t)),
                      "id": range(c * each, c * each + len(t)), "text": pa.array(t, pa.binary())})
            for c, t in enumerate(texts_[k:k + each] for k in range(0, len(texts_), each))]


def removed_by_steps(texts_, gram, hot_bytes=1 << 20, each=6):
    """What the steps leave of each text, all in this process, and the bytes of the pieces that are sent."""
    docs = chunks_of(texts_, each)
    keys = pa.concat_tables(pa.Table.from_batches(list(suffix_dedup._send_keys(1, 50, gram)(x.to_batches()))) for x in docs)
    shared = suffix_dedup._shared_keys(hot_bytes)(keys)
    hot = suffix_dedup._numbers(shared, "every_hot")
    again = pa.concat_tables(pa.Table.from_batches(
        list(suffix_dedup._send_windows(1, 50, gram, hot)(x.to_batches())), schema=keys.schema) for x in docs)
    told = {}
    if again.num_rows:
        both = suffix_dedup._shared_keys(np.iinfo(np.int64).max, short=lambda k: k)(again)
        told = dict(zip(both.column("chunk").to_pylist(), both.column("keys").to_pylist()))
    shared = shared.append_column("windows", pa.array(
        [told.get(c, b"") for c in shared.column("chunk").to_pylist()], pa.binary()))
    send, _ = suffix_dedup._send_pieces(1, 50, gram)
    pieces = pa.concat_tables(send(d, shared.filter(pa.array(np.asarray(shared.column("chunk")) == c)))
                              for c, d in enumerate(docs))
    found = suffix_dedup._sort_pieces(50, gram)[0](pieces)
    remove, _ = suffix_dedup._remove(50, gram, "bigint")
    out = [remove(d, found.filter(pa.array(np.asarray(found.column("chunk")) == c))) for c, d in enumerate(docs)]
    return [x.as_py() for k in out for x in k.column("kept")], len(hot), sum(pieces.column("size").to_pylist())


def test_a_larger_text_is_told_apart_by_longer_substrings():
    """Texts of few syllables have 16 bytes in common by chance, few of them 50: as the text grows, what is sent
    of such texts shrinks, and the same bytes go."""
    rng = random.Random(13)
    syllables = ["tion", "an", "ther", "ing", "on", "re", "al", "con"]
    texts_ = ["".join(rng.choice(syllables) for _ in range(300)).encode() for _ in range(40)]
    texts_ += [t[100:100 + 7 * k] + b"." + texts_[0][k:k + 90] for k, t in enumerate(texts_[:12])]
    lengths = [suffix_dedup.key_length(size) for size in (0, 64 << 20, 1 << 30, 16 << 30, 1 << 50)]
    assert lengths == sorted(set(lengths)) and lengths[0] == 16 and lengths[-1] <= 35
    done = [removed_by_steps(texts_, n) for n in lengths]
    assert [hashlib.sha256(x).hexdigest() for x in done[0][0]] == [
        r[4] for r in sorted(brute_removal([(i, t.decode(), "a") for i, t in enumerate(texts_)], 50), key=lambda r: int(r[0]))]
    assert all(x[0] == done[0][0] for x in done)
    assert done[2][2] < done[0][2] / 2


def test_a_larger_text_has_larger_parts():
    """Each chunk sends a row to each part: their number must not grow with the square of the text."""
    def rows(size, least):
        return size // suffix_dedup.CHUNK_BYTES * (size // suffix_dedup.part_bytes(size, least))

    for least in (suffix_dedup.KEY_BYTES, suffix_dedup.PIECE_BYTES):
        assert suffix_dedup.part_bytes(1 << 20, least) == least
        assert rows(10 << 30, least) < 2_000_000  # with parts of 2 MB 13 million
        assert max(suffix_dedup.part_bytes(1 << k, least) for k in range(50)) <= 16 << 20


@pytest.mark.parametrize("hot_bytes", [1 << 20, 200, 0])
def test_a_part_is_sorted_by_units(monkeypatch, hot_bytes):
    """The units in which a part is sorted, and the blocks in which keys are found, change no result."""
    rng = random.Random(14)
    passage = prose(rng, 60)
    texts_ = [(prose(rng, 9) + passage[k % 50:150 + 3 * k] + " a boilerplate fragment " + prose(rng, 9)).encode()
              for k in range(30)]
    texts_ += [b"", b"x" * 49, texts_[3], texts_[3][5:], "größer ".encode() * 30, b"x" * 300, b"x" * 120]
    want = [r[4] for r in sorted(brute_removal([(i, t.decode(), "a") for i, t in enumerate(texts_)], 50),
                                 key=lambda r: int(r[0]))]
    hots = set()
    for span, unit in ((1 << 16, 1 << 20), (1 << 16, 300), (256, 300)):
        monkeypatch.setattr(suffix_dedup, "_SPAN", span)
        monkeypatch.setattr(suffix_dedup, "_SORTED", unit)
        kept, hot, _ = removed_by_steps(texts_, 16, hot_bytes)
        assert [hashlib.sha256(x).hexdigest() for x in kept] == want
        hots.add(hot > 0)
    assert hots == {hot_bytes < 1 << 20}
