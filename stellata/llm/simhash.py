"""SimHash near-duplicates by anchor-point covering.

The 64 bits of a fingerprint are cut into three blocks of 22, 21 and 21 bits. Two
fingerprints that differ in at most 4 bits differ in at most 1 bit of some block.
The anchors of a block are the words of the perfect binary Golay code of length 23
(the block is padded with zero bits): its covering radius is 3, so every block has a
home anchor within 3 bits. A fingerprint is replicated to every anchor within
covering radius plus block threshold, 3 + 1 = 4 bits; of two blocks that differ in at
most one bit, each meets the other at the other's home anchor. All 64 bits are compared
per anchor, home members against all.

Equal fingerprints are one point, so copies cost nothing. An anchor that holds many
different fingerprints is split into cells of bounded size which are compared pair by
pair, each in its own task; nothing is dropped. What leaves a cell is a spanning
forest of its links, not the links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellata.llm.common import col, numbered, ship_code, stored, text_of, tidy, with_row, without
from stellata.llm.components import connected

#: (first bit, number of bits) of each block, and the bits of a block that may differ
#: so that `distance` differing bits cannot exceed it in every block.
BLOCKS = ((0, 22), (22, 21), (43, 21))
DISTANCE, SHINGLE = 4, 4
#: Fingerprints of one side of a cell, about.
CELL = 4096
#: Generator polynomial of the binary Golay code of length 23 (fixed value).
GOLAY, LENGTH, RADIUS = 0xC75, 23, 3


# --- fingerprints --------------------------------------------------------------

def fingerprint(text: bytes, shingle: int = SHINGLE, part: int = 1 << 16) -> tuple[int, int]:
    """(fingerprint as a signed long, number of shingles) of a UTF-8 text."""
    words = text.lower().split()  # of bytes: A-Z and the six ASCII spaces only
    if not words:
        return 0, 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > shingle:
        starts, ends = starts[:len(words) - shingle + 1], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, counts, n = xxhash.xxh64_digest, np.zeros(64, dtype=np.int64), len(starts)
    for at in range(0, n, part):
        spans = zip(starts[at:at + part].tolist(), ends[at:at + part].tolist())
        hashes = b"".join([digest(joined[s:e], 42) for s, e in spans])  # big-endian
        bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * counts > n)
    return int.from_bytes(set_bits.tobytes(), "big", signed=True), n


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE, row_col: str | None = None) -> DataFrame:
    """row, id, fp (the 64 bits as a signed long) and n_shingles per document."""
    rows = numbered(docs, row_col, id=col(id_col), text=F.encode(text_of(text_col), "UTF-8"))

    def run(batches):
        for batch in batches:
            found = [fingerprint(x.as_py(), shingle) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.array([f[0] for f in found], pa.int64()),
                 pa.array([f[1] for f in found], pa.int64())], names=["row", "id", "fp", "n_shingles"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"row long, id {kind}, fp long, n_shingles long")


# --- anchors -------------------------------------------------------------------

def _syndrome(words: np.ndarray) -> np.ndarray:
    """Remainders modulo the generator polynomial."""
    out = words.copy()
    for bit in range(LENGTH - 1, 10, -1):
        out ^= np.where(out >> np.uint32(bit) & np.uint32(1), np.uint32(GOLAY << (bit - 11)), np.uint32(0))
    return out


def _patterns(reach: int) -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome, the error patterns of at most ``reach`` bits, lightest
    first; the first of them leads to the home anchor. Padded; with their number."""
    levels = [np.zeros(1, dtype=np.uint32)]
    for _ in range(reach):
        last = levels[-1]
        grown = [(last | np.uint32(1 << b))[last < (1 << b)] for b in range(LENGTH)]
        levels.append(np.concatenate(grown))
    errors = np.concatenate(levels)
    of = _syndrome(errors)
    order = np.argsort(of, kind="stable")
    errors, of = errors[order], of[order]
    n = np.bincount(of, minlength=2048)
    table = np.zeros((2048, n.max()), dtype=np.uint32)
    table[of, np.arange(len(of)) - (np.cumsum(n) - n)[of]] = errors
    return table, n


def _members(reach: int):
    """Rows (block, anchor, fp, home) for each fingerprint."""
    def run(batches):
        table, n = _patterns(reach)
        width = np.arange(table.shape[1])
        for batch in batches:
            fps = np.asarray(batch.column("fp")).astype(np.int64)
            for k, (first, bits) in enumerate(BLOCKS):
                for at in range(0, len(fps), 4096):
                    fp = fps[at:at + 4096]
                    word = (fp.view(np.uint64) >> np.uint64(first) & np.uint64((1 << bits) - 1)).astype(np.uint32)
                    s = _syndrome(word)
                    there = width[None, :] < n[s][:, None]
                    anchors = (word[:, None] ^ table[s])[there]
                    home = np.broadcast_to(width == 0, there.shape)[there]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(anchors), k, dtype=np.int32)),
                         pa.array(anchors.astype(np.int32)),
                         pa.array(np.repeat(fp, n[s])), pa.array(home)],
                        names=["block", "anchor", "fp", "home"])
    return run


# --- cells ---------------------------------------------------------------------

def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) with the components of a-b."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while len(u):
        low = np.minimum(label[u], label[v])
        np.minimum.at(label, label[u], low)
        np.minimum.at(label, label[v], low)
        while not np.array_equal(label[label], label):
            label = label[label]
        keep = label[u] != label[v]
        u, v = u[keep], v[keep]
    far = label != np.arange(len(nodes))
    return nodes[far], nodes[label[far]]


def _links(distance: int, rows: int = 256):
    """Spanning forests of the links inside cells of (homes, members)."""
    def of_cell(homes, members):
        kept_a, kept_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in range(0, len(homes), rows):
            part = homes[at:at + rows]
            i, j = np.nonzero(np.bitwise_count(part[:, None] ^ members[None, :]) <= distance)
            x, y = part[i].view(np.int64), members[j].view(np.int64)
            x, y = forest(x[x != y], y[x != y])
            kept_a.append(x)
            kept_b.append(y)
        return forest(np.concatenate(kept_a), np.concatenate(kept_b))

    def run(batches):
        for batch in batches:
            homes, members = batch.column("homes"), batch.column("members")
            found = [of_cell(np.asarray(homes[i].values).view(np.uint64),
                             np.asarray(members[i].values).view(np.uint64)) for i in range(batch.num_rows)]
            a, b = (np.concatenate([f[k] for f in found] or [np.zeros(0, np.int64)]) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def links(points: DataFrame, distance: int = DISTANCE, cell: int = CELL) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints (column ``fp``, each once)
    which chains of links of at most ``distance`` differing bits connect."""
    ship_code(points.sparkSession)
    reach = RADIUS + distance // len(BLOCKS)
    spread = stored(points.mapInArrow(tidy(_members(reach)), "block int, anchor int, fp long, home boolean"), "anchors")
    # at most 3 * 4096 anchors, whatever the input: safe to broadcast
    sizes = spread.groupBy("block", "anchor").agg(
        F.ceil(F.sum(F.col("home").cast("int")) / cell).cast("int").alias("n_home"),
        F.ceil(F.count("*") / cell).cast("int").alias("n_all")).where("n_home > 0")
    sided = spread.join(F.broadcast(sizes), ["block", "anchor"])
    own = lambda seed, n: F.pmod(F.xxhash64("fp", F.lit(seed)), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    as_member = sided.select("block", "anchor", F.explode(every("n_home")).alias("h"),
                             own(1, "n_all").alias("m"), "fp", F.lit(False).alias("home"))
    as_home = sided.where("home").select("block", "anchor", own(2, "n_home").alias("h"),
                                         F.explode(every("n_all")).alias("m"), "fp", "home")
    cells = as_member.unionByName(as_home).groupBy("block", "anchor", "h", "m").agg(
        F.collect_list(F.when(F.col("home"), F.col("fp"))).alias("homes"),
        F.collect_list(F.when(~F.col("home"), F.col("fp"))).alias("members"))
    return (cells.where("size(homes) > 0 AND size(members) > 0").select("homes", "members")
            .mapInArrow(tidy(_links(distance)), "a long, b long").distinct())


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
           distance: int = DISTANCE, cell: int = CELL, row_col: str | None = None) -> DataFrame:
    """One row per document: row, id, fp and component_id, the smallest id of the
    documents that chains of links reach, itself included; ``first``: whether it is
    the row that represents its group.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, shingles are
    taken with repeats. A text of fewer words is one shingle; one without words (null
    and empty too) has fingerprint zero and is linked like any other. Repeated rows
    share their fingerprint and so their component; null ids come after all others.
    An empty table gives no rows. ``distance`` up to 5 keeps anchors within 4 bits.
    ``row_col``: the row numbers of ``with_row``, if ``docs`` has them.
    """
    prints = stored(fingerprints(docs, id_col, text_col, shingle, row_col), "prints")
    points = prints.select("fp").distinct()
    found = connected(links(stored(points, "points"), distance, cell))
    rooted = (prints.join(found.withColumnRenamed("node", "fp"), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("row"))
    best = rooted.groupBy("root").agg(F.min(order).alias("best"))
    out = rooted.join(best, "root")
    return out.select("row", "id", "fp", F.col("best.id").alias("component_id"),
                      (F.col("row") == F.col("best.row")).alias("first"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs``, all their columns: one of each group of near-duplicates."""
    names = docs.columns
    whole, row = with_row(docs)
    gone = groups(whole, id_col, text_col, row_col=row, **kw).where("NOT first").select(F.col("row").alias(row))
    return without(whole, gone, row).select(*[col(c) for c in names])
