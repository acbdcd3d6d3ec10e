"""Merkle manifest of a dataset with octopus multiproofs.

The rows of each group (source) are the leaves of a tree; the roots of the groups, in
order, are the leaves of the tree above. A leaf partition is a block of consecutive
leaves. It hashes the nodes that lie inside it and gives those that no larger one of its
own contains; nodes that span blocks follow from these in a few rounds. For proofs,
every block works out the minimal union of the node coordinates that its own leaves
cannot give, fetches them once, derives the interior nodes that its proofs share, and
writes out the proof of each leaf from them.

All digests are hashed as hexadecimal text; tables hold them as 32 bytes.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stellata.llm.common import col, numbered, ship_code, stored

ARITY = 3
#: Leaves of a block at most, as a power of two.
BLOCK_BITS = 12
#: Levels that one round above the blocks builds: a subtree has at most ARITY**SPAN leaves.
SPAN = 5
#: Requests of one node that meet in one task, about; beyond, the node is dealt out in copies.
REQUESTS = 1000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _hash(children) -> bytes:
    """The parent of nodes given as hexadecimal bytes."""
    return sha256(b"".join(children)).hexdigest().encode()


# --- coordinates -------------------------------------------------------------------

def covered(first: int, nodes: list[bytes], n: int, arity: int = ARITY):
    """Nodes (level, place, hash) inside the run of leaves from ``first`` on, of ``n`` in
    the tree, that lie in no larger node inside it."""
    a, level, out = first, 0, []
    while n > 1:
        b, up_n = a + len(nodes), -(-n // arity)
        up_a, up_b = -(-a // arity), up_n if a + len(nodes) == n else (a + len(nodes)) // arity
        if up_a >= up_b:
            break
        out += [(level, p, nodes[p - a]) for p in range(a, up_a * arity)]
        out += [(level, p, nodes[p - a]) for p in range(up_b * arity, b)]
        nodes = [_hash(nodes[p * arity - a:min((p + 1) * arity, n) - a]) for p in range(up_a, up_b)]
        a, n, level = up_a, up_n, level + 1
    return out + [(level, a + i, h) for i, h in enumerate(nodes)]


def missing(first: int, count: int, n: int, arity: int = ARITY):
    """The coordinates (level, place) that the proofs of a run of leaves need and that do
    not follow from these leaves and each other: the minimal union."""
    a, b, level, out = first, first + count, 0, []
    while n > 1:
        up_a, up_b = a // arity, (b - 1) // arity + 1
        out += [(level, p) for p in range(up_a * arity, a)]
        out += [(level, p) for p in range(b, min(up_b * arity, n))]
        a, b, n, level = up_a, up_b, -(-n // arity), level + 1
    return out


def expanded(first: int, leaves: list[bytes], n: int, fetched: dict, arity: int = ARITY):
    """(root, proofs): the proof of each leaf of the run as its siblings' digests, level by
    level and left to right. Interior nodes are derived once for all."""
    a, nodes, level, levels = first, leaves, 0, []
    while n > 1:
        b, up_a = a + len(nodes), a // arity
        up_b = (a + len(nodes) - 1) // arity + 1
        whole = ([fetched[level, p] for p in range(up_a * arity, a)] + nodes
                 + [fetched[level, p] for p in range(b, min(up_b * arity, n))])
        runs = [whole[i:i + arity] for i in range(0, len(whole), arity)]
        levels.append((a, up_a, runs, len(nodes)))
        a, nodes, n, level = up_a, [_hash(r) for r in runs], -(-n // arity), level + 1
    proofs = [b""]  # of the root; then downwards
    for a, up_a, runs, count in reversed(levels):
        raw = [[bytes.fromhex(h.decode()) for h in r] for r in runs]
        proofs = [b"".join(raw[p // arity - up_a][:p % arity] + raw[p // arity - up_a][p % arity + 1:])
                  + proofs[p // arity - up_a] for p in range(a, a + count)]
    return nodes[0], proofs


def fold(node: bytes, place: int, n: int, proof: bytes, at: int = 0, arity: int = ARITY) -> tuple[bytes, int]:
    """(root, end of what was used): the root of a tree of ``n`` leaves from one leaf and
    the siblings in ``proof`` from ``at`` on."""
    while n > 1:
        begin = place // arity * arity
        width = min(begin + arity, n) - begin
        siblings = [proof[at + 32 * i:at + 32 * i + 32].hex().encode() for i in range(width - 1)]
        at += 32 * (width - 1)
        siblings.insert(place - begin, node)
        node, place, n = _hash(siblings), place // arity, -(-n // arity)
    return node, at


# --- blocks ------------------------------------------------------------------------

@dataclass
class Tree:
    """``leaves``: at, block, g, hash and what is carried along, in order of ``at``.
    ``runs``: block, g, first (place in the group), count, n (leaves of the group).
    ``nodes``: g, n, level, place, hash. ``parts``: tasks over the leaves."""
    leaves: DataFrame
    runs: DataFrame
    nodes: DataFrame
    parts: int


def _by_block(leaves: DataFrame, facts: DataFrame, parts: int, run, schema: str) -> DataFrame:
    """``run(facts of a block, its rows)`` for every block; ``facts`` has a row per block. Both
    are dealt by ranges of blocks, so that tasks are even, and streamed block by block."""
    info = facts.schema["facts"].dataType.simpleString()
    none = F.lit(None).cast(info)
    columns = leaves.columns
    rows = leaves.withColumn("facts", none).unionByName(facts.withColumn("at", F.lit(-1).cast("long")),
                                                       allowMissingColumns=True)
    dealt = rows.repartitionByRange(parts, "block").sortWithinPartitions("block", "at")

    def each(batches):
        def one_by_one():
            for batch in batches:
                yield from zip(*[batch.column(c).to_pylist() for c in ["block", "at", "facts", *columns]])

        for _, rows in groupby(one_by_one(), key=lambda r: r[0]):
            head = next(rows)
            yield from run(head[2], [dict(zip(columns, r[3:])) for r in rows])

    return dealt.mapInArrow(each, schema)


def _grown(leaves: DataFrame, order: list[Column], arity: int, block_bits: int, span: int) -> Tree:
    """The tree over ``leaves`` (g, hash, others): groups by ``g``, leaves in ``order``."""
    spark = leaves.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("g"), *order, F.monotonically_increasing_id()]
    keyed = leaves.select("*", *[c.alias(f"o{i}__") for i, c in enumerate(order)])
    names = [f"o{i}__" for i in range(len(order))]
    placed = stored(keyed.repartitionByRange(parts, *names).sortWithinPartitions(*names).drop(*names)
                    .withColumn("at", F.monotonically_increasing_id())
                    .withColumn("block", F.shiftright("at", block_bits)), "leaves")
    counts = placed.groupBy("block", "g").agg(F.count("*").alias("count"))
    # a row per block and group: about one for 2**block_bits leaves
    ahead = Window.partitionBy("g").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("g").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = stored(counts.select("block", "g", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("first"),
                                "count", F.sum("count").over(whole).alias("n")), "runs")
    facts = runs.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("g", "first", "count", "n"))).alias("facts"))
    schema = "g string, n long, level int, place long, hash binary"

    def batch_of(rows):
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                          names=["g", "n", "level", "place", "hash"])

    def inside(facts, rows):
        out, at = [], 0
        for f in facts:
            own = [r["hash"].hex().encode() for r in rows[at:at + f["count"]]]
            at += f["count"]
            out += [(f["g"], f["n"], level, p, bytes.fromhex(h.decode()))
                    for level, p, h in covered(f["first"], own, f["n"], arity)]
        yield batch_of(out)

    nodes = new = stored(_by_block(placed.select("block", "at", "hash"), facts, parts, inside, schema), "nodes")
    top, most = 0, runs.agg(F.max("n")).first()[0] or 0
    while arity ** top < most:  # levels above the leaves of the largest group
        top += 1

    def above(low):
        def run(batches):
            for batch in batches:
                out = []
                for r in batch.to_pylist():
                    known = {(x["level"], x["place"]): x["hash"].hex().encode() for x in r["below"]}
                    size = r["n"]
                    for _ in range(low):
                        size = -(-size // arity)
                    for level in range(low, low + span):
                        if size == 1:
                            break
                        for p in sorted({p // arity for at, p in known if at == level}):
                            made = _hash([known[level, c] for c in range(p * arity, min((p + 1) * arity, size))])
                            known[level + 1, p] = made
                            out.append((r["g"], r["n"], level + 1, p, bytes.fromhex(made.decode())))
                        size = -(-size // arity)
                yield batch_of(out)
        return run

    peaks = nodes
    for low in range(0, top, span):
        width = F.element_at(F.array(*[F.lit(arity ** k).cast("long") for k in range(span, 0, -1)]),
                             (F.col("level") - low + 1).cast("int"))
        # what is below: the blocks' own nodes of these levels and what the round before made
        # of its highest; a subtree has few nodes
        source = peaks if low == 0 else peaks.unionByName(new)
        below = (source.where((F.col("level") >= low) & (F.col("level") < low + span))
                 .where(F.lit(float(arity)) ** F.col("level") < F.col("n"))
                 .groupBy("g", "n", F.floor(F.col("place") / width).alias("root"))
                 .agg(F.collect_list(F.struct("level", "place", "hash")).alias("below")))
        new = stored(below.select("g", "n", "below").mapInArrow(above(low), schema), "above")
        nodes = nodes.unionByName(new)
    return Tree(placed, runs, nodes, parts)


def _tops(tree: Tree, arity: int) -> DataFrame:
    """(g, hash): the root of each group."""
    return (tree.nodes.where((F.col("place") == 0) & (F.lit(float(arity)) ** F.col("level") >= F.col("n")))
            .select("g", "hash"))


def _expanded(tree: Tree, arity: int, tails: DataFrame | None, requests: int, block_bits: int) -> DataFrame:
    """The leaves with place, n, top (root of the group) and proof; with ``tails`` (g, t_place,
    t_n, t_top, t_proof) also those of the tree above, its proof behind their own."""
    def ask(batches):
        for batch in batches:
            asked = [(r["block"], r["g"], level, p) for r in batch.to_pylist()
                     for level, p in missing(r["first"], r["count"], r["n"], arity)]
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in asked], k) for i, k in enumerate(kinds)],
                                             names=["block", "g", "level", "place"])

    # about arity**level >> block_bits blocks ask for a node: high ones are dealt out in copies
    copies = F.greatest(F.lit(1), F.least(F.lit(10_000), F.ceil(
        F.lit(float(arity)) ** F.col("level") / float(requests << block_bits)))).cast("int")
    wanted = (tree.runs.mapInArrow(ask, "block long, g string, level int, place long")
              .withColumn("copy", F.pmod(F.xxhash64("block"), copies).cast("int")))
    offered = tree.nodes.select("g", "level", "place", "hash",
                                F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"))
    fetched = (wanted.join(offered, ["g", "level", "place", "copy"]).groupBy("block", "g")
               .agg(F.collect_list(F.struct("level", "place", "hash")).alias("fetched")))
    facts = tree.runs.join(fetched, ["block", "g"], "left")
    if tails is not None:
        facts = facts.join(tails, "g")
    one = [c for c in facts.columns if c not in ("block", "g")]
    facts = facts.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("g", F.struct(*one).alias("x"))))
                                       .alias("facts"))
    carried = [f for f in tree.leaves.schema if f.name not in ("block", "at")]
    fields = [(f.name, f.dataType.simpleString()) for f in carried]
    fields += [("place", "bigint"), ("n", "bigint"), ("top", "binary"), ("proof", "binary")]
    if tails is not None:
        fields += [("t_place", "bigint"), ("t_n", "bigint"), ("t_top", "binary")]
    schema = ", ".join(f"`{n}` {t}" for n, t in fields)
    names, two = [f.name for f in carried], tails is not None
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(facts, rows):
        at, out = 0, []
        for f in facts:
            x = f["x"]
            own = rows[at:at + x["count"]]
            at += x["count"]
            known = {(y["level"], y["place"]): y["hash"].hex().encode() for y in x["fetched"] or ()}
            top, proofs = expanded(x["first"], [r["hash"].hex().encode() for r in own], x["n"], known, arity)
            top = bytes.fromhex(top.decode())
            for i, (r, proof) in enumerate(zip(own, proofs)):
                more = (x["first"] + i, x["n"], top, proof)
                if two:
                    more = (*more[:3], proof + x["t_proof"], x["t_place"], x["t_n"], x["t_top"])
                out.append(tuple(r[c] for c in names) + more)
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], f.type) for i, f in enumerate(arrow)],
                                         schema=arrow)

    return _by_block(tree.leaves, facts, tree.parts, run, schema)


# --- the manifest --------------------------------------------------------------------

def leaf(values: dict[str, Column]) -> Column:
    """The digest (32 bytes) of a row: each value `-` if null, else the number of its UTF-8
    bytes, a colon and the value; integers in decimal."""
    def part(c):
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[part(c) for c in values.values()]), 256))


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields=FIELDS,
             other: dict[str, Column] | None = None, arity: int = ARITY, block_bits: int = BLOCK_BITS,
             span: int = SPAN, requests: int = REQUESTS) -> DataFrame:
    """One row per row of ``docs``: id, hash (its leaf), other (the leaf with the columns of
    ``other`` in place of its own; null where they are equal), place and n in its group,
    top (the group's root), t_place and t_n of the group, t_top (the root) and proof: the
    siblings' digests, level by level up to the root, left to right.

    Leaves of a group ascend by id, nulls first, then by digest; groups ascend by the
    bytes of their UTF-8 text, null first. Rows that repeat an id have leaves of their
    own; of wholly equal rows it does not matter which comes first. A group of one leaf
    is its own root, and so is a single group's root. Null and empty values differ (`-`
    and `0:`). An empty table has no root and gives no rows; columns outside ``fields`` are
    ignored. No task sees a whole group, however large it is.
    """
    ship_code(docs.sparkSession)
    values = {c: col(c) for c in fields}
    base = leaf(values)
    changed = F.lit(None).cast("binary")
    if other:
        differs = F.lit(False)
        for name, c in other.items():
            differs = differs | ~c.eqNullSafe(col(name))
        changed = F.when(differs, leaf(values | other))
    key = F.coalesce(F.concat(F.lit("="), col(group_col).cast("string")), F.lit(""))
    rows = numbered(docs, g=key, id=col(id_col), hash=base, other=changed).drop("row")
    tree = _grown(rows, [F.col("id"), F.col("hash")], arity, block_bits, span)
    roots = _tops(tree, arity).select(F.lit("").alias("g"), F.col("g").alias("of"), "hash")
    above = _expanded(_grown(roots, [F.col("of")], arity, block_bits, span), arity, None, requests, block_bits)
    tails = stored(above.select(F.col("of").alias("g"), F.col("place").alias("t_place"), F.col("n").alias("t_n"),
                                F.col("top").alias("t_top"), F.col("proof").alias("t_proof")), "tops")
    return _expanded(tree, arity, tails, requests, block_bits).drop("g")


def verify(rows: DataFrame, leaf_col: str = "hash", arity: int = ARITY) -> DataFrame:
    """The rows of ``manifest`` with folded (the root that the digest in ``leaf_col`` and the
    proof lead to) and proof_sha256 (hex digest of the siblings) in place of the proof."""
    schema = [(f.name, f.dataType.simpleString()) for f in rows.schema if f.name not in ("proof", leaf_col + "__")]
    asked = rows.withColumn("leaf__", F.coalesce(col(leaf_col), F.col("hash")))

    def run(batches):
        for batch in batches:
            names = ("leaf__", "place", "n", "t_place", "t_n", "proof")
            roots, digests = [], []
            for node, place, n, t_place, t_n, proof in zip(*[batch.column(c).to_pylist() for c in names]):
                node, at = fold(node.hex().encode(), place, n, proof, 0, arity)
                node, _ = fold(node, t_place, t_n, proof, at, arity)
                roots.append(bytes.fromhex(node.decode()))
                digests.append(sha256(proof.hex().encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c, _ in schema] + [pa.array(roots, pa.binary()), pa.array(digests)],
                names=[c for c, _ in schema] + ["folded", "proof_sha256"])

    return asked.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in schema) + ", folded binary, proof_sha256 string")
