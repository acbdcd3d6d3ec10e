"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each table hashes a vector with several functions floor((a . x + b) / w), a drawn from
the Gaussian (2-stable) distribution; the values together name a bucket. A query visits
its own bucket and then perturbed ones in the order of their estimated success, which
follows from the query's distances to the bucket borders. The candidates of all
visits are ranked by their exact Euclidean distance.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stellata.llm.common import col, numbered, stored

#: Tables, functions per table, width of a bucket in units of the spread of the
#: vectors, and buckets that a query visits per table.
TABLES, FUNCTIONS, WIDTH, PROBES = 5, 6, 2.0, 48
#: Vectors or queries of one cell at most, about; vectors from which the spread is taken.
CELL, FIT_ROWS = 2000, 5000


# --- hashing ----------------------------------------------------------------------

class Hashes:
    """The functions of one table, for vectors of one dimension."""

    def __init__(self, table: int, dimension: int, functions: int, width: float, seed: int):
        rng = np.random.default_rng([seed, table, dimension])
        self.a = rng.standard_normal((dimension, functions))
        self.b = rng.uniform(0.0, width, functions)
        self.width, self.name = width, np.array([dimension], dtype="<i4").tobytes()

    def places(self, vectors: np.ndarray) -> np.ndarray:
        return (vectors @ self.a + self.b) / self.width

    def bucket(self, cells: np.ndarray) -> bytes:
        return self.name + np.clip(cells, -2 ** 31, 2 ** 31 - 1).astype("<i4").tobytes()


def probes(place: np.ndarray, count: int) -> list[np.ndarray]:
    """The first ``count`` buckets (vectors of integers) to visit, likeliest first.

    Moving function i down costs the square of the distance to its lower border, moving
    it up that to the upper one; sets of moves come out of a heap in the order of their
    total cost by shifting or extending the last move of a set."""
    home = np.floor(place)
    below = place - home
    k = len(place)
    cost = np.concatenate([below ** 2, (1 - below) ** 2])
    order = np.argsort(cost, kind="stable")
    cost, function = cost[order].tolist(), (order % k).tolist()
    step = np.where(order < k, -1, 1).tolist()
    out, heap = [home], [(cost[0], (0,))]
    while heap and len(out) < count:
        total, moves = heapq.heappop(heap)
        if len({function[m] for m in moves}) == len(moves):
            there = home.copy()
            for m in moves:
                there[function[m]] += step[m]
            out.append(there)
        last = moves[-1]
        if last + 1 < 2 * k:
            heapq.heappush(heap, (total + cost[last + 1], (*moves, last + 1)))
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*moves[:-1], last + 1)))
    return out


def _vectors(column) -> list[np.ndarray]:
    return [np.asarray(x.values, dtype=np.float64) for x in column]


def _send(tables: int, functions: int, width: float, seed: int, count: int):
    """Rows (table, bucket, key, v): a vector for each bucket that it belongs to
    (``count`` 1) or visits."""
    def run(batches):
        made: dict[tuple[int, int], Hashes] = {}
        for batch in batches:
            keys, column = np.asarray(batch.column("key")), batch.column("v")
            vectors = _vectors(column)
            for t in range(tables):
                buckets, which = [], []
                for i, v in enumerate(vectors):
                    if (t, len(v)) not in made:
                        made[t, len(v)] = Hashes(t, len(v), functions, width, seed)
                    h = made[t, len(v)]
                    there = probes(h.places(v[None, :])[0], count) if count > 1 else [np.floor(h.places(v[None, :])[0])]
                    buckets += [h.bucket(x) for x in there]
                    which += [i] * len(there)
                for at in range(0, len(which), 4096):
                    some = np.array(which[at:at + 4096])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(some), t, dtype=np.int32)), pa.array(buckets[at:at + 4096], pa.binary()),
                         pa.array(keys[some]), column.take(pa.array(some))], names=["table", "bucket", "key", "v"])
    return run


# --- distances --------------------------------------------------------------------

def nearest(keys: np.ndarray, points: np.ndarray, query: np.ndarray, k: int):
    """(keys, distances) of the ``k`` nearest points and of all that tie with the last."""
    distance = np.sqrt(((points - query) ** 2).sum(axis=1))
    if len(distance) > k:
        keep = distance <= np.partition(distance, k - 1)[k - 1]
        return keys[keep], distance[keep]
    return keys, distance


def _rerank(k: int):
    def run(batches):
        for batch in batches:
            for points, queries in zip(batch.column("points"), batch.column("queries")):
                p, q = points.values, queries.values
                size = len(p.field("v")[0])
                matrix = np.asarray(p.field("v").flatten(), dtype=np.float64).reshape(-1, size)
                asked = np.asarray(q.field("v").flatten(), dtype=np.float64).reshape(-1, size)
                keys, found = np.asarray(p.field("key")), []
                for key, query in zip(np.asarray(q.field("key")).tolist(), asked):
                    near, distance = nearest(keys, matrix, query, k)
                    found.append((np.full(len(near), key), near, distance))
                a, b, c = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(c)],
                                                 names=["asked", "point", "score"])
    return run


def _meet(points: DataFrame, queries: DataFrame, names: list[str], k: int, cell: int) -> DataFrame:
    """(asked, point, score): for every query the ``k`` nearest points of each bucket that
    both are in. Buckets with many vectors or queries are dealt over several cells, each
    vector meeting each query in one of them."""
    n = points.groupBy(*names).agg(F.ceil(F.count("*") / cell).cast("int").alias("np"))
    m = queries.groupBy(*names).agg(F.ceil(F.count("*") / cell).cast("int").alias("nq"))
    sizes = n.join(m, names)
    deal = lambda c: F.pmod(F.xxhash64("key"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    pair = F.struct("key", "v")
    none = F.lit(None).cast(points.select(pair.alias("p")).schema["p"].dataType)
    left = points.join(sizes, names).select(
        *names, deal("np").alias("i"), every("nq").alias("j"), pair.alias("p"), none.alias("q"))
    right = queries.join(sizes, names).select(
        *names, every("np").alias("i"), deal("nq").alias("j"), none.alias("p"), pair.alias("q"))
    cells = left.unionByName(right).groupBy(*names, "i", "j").agg(
        F.collect_list("p").alias("points"), F.collect_list("q").alias("queries"))
    return (cells.where("size(points) > 0 AND size(queries) > 0").select("points", "queries")
            .mapInArrow(_rerank(k), "asked long, point long, score double"))


def search(vectors: DataFrame, every: int = 100, k: int = 10, id_col: str = "vec_id",
           vector_col: str = "embedding", tables: int = TABLES, functions: int = FUNCTIONS, width: float = WIDTH,
           count: int = PROBES, seed: int = 11, cell: int = CELL, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each id divisible by ``every`` the ``k`` nearest
    vectors found, by Euclidean distance in double precision, ties to the smaller id.

    Rows with the query's own id are no candidates. Vectors that are null, empty or all
    zero, or hold a null or non-finite component, take no part, nor do rows without an
    id; vectors of another length never meet. A query that has met fewer than ``k``
    vectors is compared with all of its length, so it gets all there are if there are
    fewer. Equal vectors travel once, with their ``k`` + 1 smallest ids (more cannot be
    in a result); repeated rows are one. An empty table gives no rows.

    The width is in units of the root mean square distance of ``fit_rows`` vectors (by
    the hash of their ids) from their mean: the only sampled figure.
    """
    v = col(vector_col)
    usable = numbered(vectors, id=col(id_col), v=v).select("id", "v").where(
        F.col("id").isNotNull()).where(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0))
    once = usable.distinct()
    lowest = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    asking = F.col("id") % every == 0
    few = once.withColumn("n", lowest).where(F.col("n") <= k + 1)
    points = stored(
        few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "points")
    points = stored(points.withColumn("key", F.monotonically_increasing_id()), "keyed")
    askers = once.where(asking).join(points.select("key", "v"), "v").select("id", "key")
    askers = stored(askers, "askers")
    queries = points.join(askers.select("key").distinct(), "key", "left_semi").select("key", "v")
    sample = [np.asarray(r["v"], dtype=np.float64) for r in
              points.orderBy(F.xxhash64(F.col("ids")[0]), F.col("ids")[0]).limit(fit_rows).select("v").collect()]
    spread = 1.0
    if sample:
        same = np.stack([x for x in sample if len(x) == len(sample[0])])
        spread = float(np.sqrt(((same - same.mean(axis=0)) ** 2).sum(axis=1).mean()))
        spread = spread or float(np.sqrt((same ** 2).sum(axis=1).mean()))
    kind = points.schema["v"].dataType.simpleString()
    schema = f"table int, bucket binary, key long, v {kind}"
    index = points.select("key", "v").mapInArrow(_send(tables, functions, width * spread, seed, 1), schema)
    visits = queries.mapInArrow(_send(tables, functions, width * spread, seed, count), schema)
    names = ["table", "bucket"]
    met = stored(_meet(stored(index, "index"), stored(visits, "visits"), names, k + 1, cell)
                 .dropDuplicates(["asked", "point"]), "met")
    met = met.join(points.select(F.col("key").alias("point"), "ids"), "point")
    # those that have met too few for a full answer meet everything
    full = met.groupBy("asked").agg(F.sum(F.size("ids")).alias("n")).where(F.col("n") > k).select(
        F.col("asked").alias("key"))
    short = stored(queries.join(full, "key", "left_anti"), "short")
    if not short.isEmpty():
        alike = F.size("v").alias("length")
        rest = _meet(points.select(alike, "key", "v"), short.select(alike, "key", "v"), ["length"], k + 1, cell)
        rest = rest.join(points.select(F.col("key").alias("point"), "ids"), "point")
        met = met.join(short.select(F.col("key").alias("asked")), "asked", "left_anti").unionByName(
            rest, allowMissingColumns=False)
    order = lambda by: F.row_number().over(Window.partitionBy(by).orderBy("score", "vec_id"))
    best = (met.select("asked", "score", F.explode("ids").alias("vec_id")).distinct()
            .withColumn("n", order("asked")).where(F.col("n") <= k + 1))
    return (askers.select(F.col("id").alias("query_id"), F.col("key").alias("asked")).join(best, "asked")
            .where("vec_id <> query_id").withColumn("rank", order("query_id")).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
