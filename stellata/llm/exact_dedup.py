"""Exact duplicates by composable polynomial fingerprints.

A normalised text is cut into chunks of bytes. Chunk hashes are polynomials modulo
two primes; the hash of a whole text follows from those of its chunks by
length-shifted arithmetic (hash(xy) = hash(x) * base^len(y) + hash(y)), so the chunks
of a huge document are hashed in different tasks. Texts with equal length and equal
fingerprints are then compared chunk by chunk with the first of their group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellata.llm.common import SPACE, col, numbered, stored, text_of, tidy, with_row, without

#: Bytes of a chunk that is hashed, and of one that is compared.
CHUNK = 1 << 20
BLOCK = 1 << 16
#: Two primes under 2**31 (products fit a long) and a base for each.
MODULI = ((2147483647, 1000003), (2147483629, 69069))


def _powers(modulus: int, base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo ``modulus``, by doubling."""
    out = np.ones(1, dtype=np.uint64)
    step = base % modulus
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(step) % np.uint64(modulus)])
        step = step * step % modulus
    return out[:n]


def _hasher(modulus: int, base: int, part: int = 4096):
    """A function from bytes to (hash, base**length), both modulo ``modulus``."""
    down = _powers(modulus, base, part + 1)[::-1].copy()  # highest power first

    def run(data) -> tuple[int, int]:
        symbols = np.frombuffer(data, dtype=np.uint8)
        h, shift = 0, 1
        for at in range(0, len(symbols), part):
            piece = symbols[at:at + part].astype(np.uint64) + np.uint64(1)
            n = len(piece)
            # at most 4096 * 256 * 2**31 < 2**52
            value = int(np.dot(piece, down[part + 1 - n:]))
            step = int(down[part - n])
            h = (h * step + value) % modulus
            shift = shift * step % modulus
        return h, shift

    return run


def _hash_chunks(moduli):
    schema = "row long, chunk int, h1 long, s1 long, h2 long, s2 long"

    def run(batches):
        first, second = (_hasher(*m) for m in moduli)
        for batch in batches:
            found = [(*first(x.as_buffer()), *second(x.as_buffer())) for x in batch.column("bytes")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("chunk")]
                + [pa.array([f[i] for f in found], pa.int64()) for i in range(4)],
                names=["row", "chunk", "h1", "s1", "h2", "s2"])

    return run, schema


def _pieces(size: int):
    """The (chunk, bytes) pieces of the column ``bytes``; an empty text has one."""
    last = F.floor(F.greatest(F.octet_length("bytes") - 1, F.lit(0)) / size).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(
        i.alias("chunk"),
        F.substring(F.col("bytes"), i * size + 1, F.lit(size)).alias("bytes")))


def _combined(which: int, modulus: int):
    """The hash of a text from its chunks in order."""
    return F.aggregate(
        F.col("parts"), F.lit(0).cast("long"),
        lambda acc, x: (acc * x[f"s{which}"] + x[f"h{which}"]) % F.lit(modulus).cast("long"))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, chunk: int = CHUNK,
                 moduli=MODULI, row_col: str | None = None) -> DataFrame:
    """One row per document: row, id, n_points (code points of the text), n_bytes and
    sha256 of the normalised text, f1 and f2, its fingerprints.

    Texts of one chunk are hashed where they are read; the chunks of longer ones are
    dealt out, hashed in parallel and combined. Both ways give the same fingerprint.
    ``row_col``: the row numbers, if ``docs`` has them.
    """
    if row_col is None:
        docs, row_col = with_row(docs)
    clean = F.encode(F.regexp_replace("text", SPACE, ""), "UTF-8")
    rows = (numbered(docs, row_col, id=col(id_col), text=text_of(text_col))
            .withColumn("bytes", clean))
    facts = [F.length("text").cast("long").alias("n_points"),
             F.octet_length("bytes").cast("long").alias("n_bytes"),
             F.sha2("bytes", 256).alias("sha256")]
    run, schema = _hash_chunks(moduli)
    # by the raw length, so that the filter does not repeat the cleaning
    short = rows.where(F.octet_length("text") <= chunk)
    long = rows.where(F.octet_length("text") > chunk)

    def hash_short(batches):
        first, second = (_hasher(*m) for m in moduli)
        for batch in batches:
            data = batch.column("bytes")
            one = [first(x.as_buffer())[0] for x in data]
            two = [second(x.as_buffer())[0] for x in data]
            keep = [batch.column(c) for c in ("row", "id", "n_points", "n_bytes", "sha256")]
            yield pa.RecordBatch.from_arrays(
                keep + [pa.array(one, pa.int64()), pa.array(two, pa.int64())],
                names=["row", "id", "n_points", "n_bytes", "sha256", "f1", "f2"])

    id_type = rows.schema["id"].dataType.simpleString()
    shorts = short.select("row", "id", *facts, "bytes").mapInArrow(
        tidy(hash_short), f"row long, id {id_type}, n_points long, n_bytes long, sha256 string, "
                    "f1 long, f2 long")
    dealt = (long.select("row", F.explode(_pieces(chunk)).alias("p"))
             .select("row", "p.chunk", "p.bytes").repartition("row", "chunk"))
    parts = (dealt.mapInArrow(tidy(run), schema).groupBy("row")
             .agg(F.sort_array(F.collect_list(F.struct("chunk", "h1", "s1", "h2", "s2"))).alias("parts"))
             .select("row", _combined(1, moduli[0][0]).alias("f1"), _combined(2, moduli[1][0]).alias("f2")))
    longs = long.select("row", "id", *facts).join(parts, "row")
    return shorts.unionByName(longs.select(*shorts.columns))


def _verified(docs: DataFrame, text_col: str, prints: DataFrame, block: int, row_col: str) -> DataFrame:
    """(row, leader) for the rows whose fingerprint is not unique. ``leader`` is the
    first row with the same text, found by comparing blocks of bytes."""
    same = ["n_bytes", "f1", "f2"]
    groups = (prints.groupBy(*same).agg(F.count("*").alias("n"), F.min("row").alias("leader"))
              .where("n > 1").drop("n"))
    open_ = stored(prints.join(groups, same).select("row", "leader", *same), "candidates")
    texts = numbered(docs, row_col, text=text_of(text_col))
    out = None
    while True:
        # every member's blocks beside those of its leader: an inner join that reads
        # one leader block per key and streams the members past it
        # (a merge join at every size: the candidates grow with the documents)
        blocks = (open_.select("row", "leader").hint("merge")
                  .join(texts, "row")
                  .withColumn("bytes", F.encode(F.regexp_replace("text", SPACE, ""), "UTF-8"))
                  .select("row", "leader", F.explode(_pieces(block)).alias("p"))
                  .select("row", "leader", "p.chunk", "p.bytes"))
        first = blocks.where("row = leader").select("leader", "chunk", F.col("bytes").alias("first"))
        equal = (blocks.join(first, ["leader", "chunk"])
                 .groupBy("row").agg(F.bool_and(F.col("bytes") == F.col("first")).alias("equal")))
        judged = stored(open_.join(equal, "row"), "compared")
        right = judged.where("equal").select("row", "leader")
        out = right if out is None else out.unionByName(right)
        wrong = judged.where("NOT equal").select("row", F.col("leader").alias("old"), *same)
        if wrong.isEmpty():
            return out
        # texts that share a fingerprint only: they form groups among themselves
        again = wrong.groupBy(*same).agg(F.min("row").alias("leader"))
        open_ = stored(wrong.join(again, same).select("row", "leader", *same), "candidates")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK,
            block: int = BLOCK, moduli=MODULI, row_col: str | None = None) -> DataFrame:
    """One row per document with its class of equal texts.

    Texts are equal when they are identical after all characters of
    ``[\\x20\\x09-\\x0D]`` are deleted; null counts as the empty text, and all empty
    texts are equal. Of a class, the row with the most code points in the original
    text stays, then the one with the smallest id (null last), then the one with
    the smallest row number, so of fully repeated rows exactly one stays. Returns row, id,
    keep_id, group_size, kept, sha256 (of the normalised text); an empty table gives
    no rows, and other columns of ``docs`` are ignored. ``row_col``: the row numbers of
    ``with_row``, if ``docs`` has them.
    """
    if row_col is None:
        docs, row_col = with_row(docs)
    prints = stored(fingerprints(docs, id_col, text_col, chunk, moduli, row_col), "prints")
    leaders = _verified(docs, text_col, prints, block, row_col)
    member = prints.join(leaders, "row")
    order = F.struct((-F.col("n_points")).alias("p"), F.col("id").isNull().alias("none"),
                     F.col("id"), F.col("row"))
    best = (member.groupBy("leader").agg(F.min(order).alias("best"), F.count("*").alias("size"))
            .select("leader", F.col("best.id").alias("keep_id"), F.col("best.row").alias("keep_row"),
                    F.col("size").cast("long").alias("size")))
    many = leaders.join(best, "leader").drop("leader")
    out = prints.join(many, "row", "left")
    alone = F.col("keep_row").isNull()
    return out.select(
        "row", "id", F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"), "sha256")


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs``, all their columns, that stay of each class of equal texts."""
    names = docs.columns
    whole, row = with_row(docs)
    gone = classes(whole, id_col, text_col, row_col=row, **kw).where("NOT kept").select(F.col("row").alias(row))
    return without(whole, gone, row).select(*[col(c) for c in names])
