"""Large JSON arrays of objects, read by many tasks.

``multiLine`` reads a file whole in one task. Here a file is split at every closing brace,
which Spark's text reader does in parallel over byte ranges. A brace may stand in a string
or close an inner object; a piece by itself cannot tell. So each piece says how it changes
the string state (whether its number of quotes is odd) and the bracket depth, once for a
start outside and once for a start inside a string. Running sums inside a byte range, and
then over the ranges of a file, give the true state and depth at every piece. An object ends
where the depth is back at 1 outside a string. Objects without inner objects are one piece
and stay where they are; only the pieces of others are brought together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stellata.session import checkpoint_dir


def _change(parts, place: int):
    """Depth change of the parts of a piece that lie outside strings: the even ones if it
    starts outside, the odd ones if inside."""
    own = F.array_join(F.filter(parts, lambda x, i: i % 2 == place), "")
    opened = F.regexp_count(own, F.lit(r"[\[{]"))
    closed = F.regexp_count(own, F.lit(r"[\]}]"))
    return (opened - closed).cast("long")


def array_objects(spark: SparkSession, path: str) -> DataFrame:
    """(arquivo, objeto): the text of each object of the JSON arrays in the files of ``path``.

    A file holds one array or several, one after the other, over any number of lines (or a
    single one); objects may be nested and strings may hold any bracket, brace or escaped
    quote. White space and commas between objects do not matter; an empty array gives no
    rows. No task reads more than its byte ranges, and only objects with inner objects are
    shuffled. Pieces are stored once in the shared checkpoint folder, so every pass sees the
    same ones.
    """
    checkpoint_dir(spark)
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("arquivo"), F.col("_metadata.file_block_start").alias("bloco"),
        F.monotonically_increasing_id().alias("n"), F.col("value").alias("texto"))
    # quotes that are escaped go first; the brace that ended the piece comes back
    plain = F.regexp_replace(F.concat("texto", F.lit("}")), r"(?s)\\.", "")
    marked = pieces.withColumn("_p", F.split(plain, '"', -1)).select(
        "arquivo", "bloco", "n", "texto", ((F.size("_p") - 1) % 2).alias("impar"),
        _change(F.col("_p"), 0).alias("d0"), _change(F.col("_p"), 1).alias("d1")).checkpoint(eager=True)
    here = Window.partitionBy("arquivo", "bloco").orderBy("n")
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    upto = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    zero = F.lit(0).cast("long")
    # state (0 outside, 1 inside a string) if the range starts outside; the other way round if not
    local = marked.withColumn("s", F.coalesce(F.sum("impar").over(before), zero) % 2)
    local = local.withColumn("c0", F.sum(F.when(F.col("s") == 0, F.col("d0")).otherwise(F.col("d1"))).over(upto))
    local = local.withColumn("c1", F.sum(F.when(F.col("s") == 0, F.col("d1")).otherwise(F.col("d0"))).over(upto))
    ranges = local.groupBy("arquivo", "bloco").agg(
        (F.sum("impar") % 2).alias("odd"), F.max_by("c0", "n").alias("t0"), F.max_by("c1", "n").alias("t1"))
    # one row per byte range of a file
    order = Window.partitionBy("arquivo").orderBy("bloco").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("start", F.coalesce(F.sum("odd").over(order), zero) % 2)
    ranges = ranges.withColumn("depth", F.coalesce(
        F.sum(F.when(F.col("start") == 0, F.col("t0")).otherwise(F.col("t1"))).over(order), zero))
    placed = local.join(ranges.select("arquivo", "bloco", "start", "depth"), ["arquivo", "bloco"])
    after = F.col("depth") + F.when(F.col("start") == 0, F.col("c0")).otherwise(F.col("c1"))
    inside = (F.col("start") + F.col("s") + F.col("impar")) % 2 == 1
    change = F.when((F.col("start") + F.col("s")) % 2 == 0, F.col("d0")).otherwise(F.col("d1"))
    placed = placed.select("arquivo", "bloco", "n", "texto", (after - change).alias("antes"),
                           ((after == 1) & ~inside).alias("fim"), ((F.col("start") + F.col("s")) % 2 == 0).alias("fora"))
    # a piece that starts between objects and ends one holds the whole object
    single = (F.col("antes") <= 1) & F.col("fora") & F.col("fim")
    clean = lambda t: F.regexp_extract(t, r"(?s)^[^{]*(\{.*)$", 1)
    whole = placed.where(single).select("arquivo", clean(F.concat("texto", F.lit("}"))).alias("objeto"))
    rest = placed.where(~single)
    ended = F.col("fim").cast("long")
    count = rest.withColumn("e", F.coalesce(F.sum(ended).over(before), zero))
    per = rest.groupBy("arquivo", "bloco").agg(F.sum(ended).alias("ends"))
    per = per.withColumn("ahead", F.coalesce(F.sum("ends").over(order), zero)).drop("ends")
    joint = (count.join(per, ["arquivo", "bloco"]).groupBy("arquivo", (F.col("ahead") + F.col("e")).alias("objeto_n"))
             .agg(F.sort_array(F.collect_list(F.struct("bloco", "n", "texto"))).alias("t"), F.max("fim").alias("ended")))
    nested = joint.where("ended").select("arquivo", clean(F.concat(F.array_join(
        F.transform("t", lambda x: x["texto"]), "}"), F.lit("}"))).alias("objeto"))
    return whole.unionByName(nested)


def read_json_array(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows of the objects of a JSON array, as ``schema`` (a StructType or DDL) names them.
    A value of another type, and an object that does not parse, give nulls."""
    found = array_objects(spark, path).select(F.from_json("objeto", schema).alias("o"))
    return found.select("o.*")
