"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key scaled by its quality weight; within a
source the documents are taken in the order of their keys until the source's token
budget is met. Complete epochs of a source come first, the fraction that is left is
selected by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stellata.llm.common import WORD, col, fresh, numbered, stored, text_of, with_row

#: Rows whose prefix sums are formed in one sort, about (at most four times this).
BUCKET = 2000
#: Weights of documents lie between 1 and this; only their ratios matter.
HEAVIEST = 4.0


def quality(size: Column, points: Column) -> Column:
    """Weight from 1 to 4: text made of words of usual length weighs most, long runs
    without white space least."""
    share = F.least(F.lit(1.0), F.lit(6.0) * size / F.greatest(points, F.lit(1)))
    return F.lit(1.0) + F.lit(HEAVIEST - 1.0) * share


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) from the text of ``key``; the same in every run."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights=(1, 2, 3), cap: float = 3.0) -> DataFrame:
    """(source, source_size, n, target) from one row per source (source, source_size, n).

    Sources in the order of their code points, null last, take the weights in turn
    and share the sum of all sizes. A target stops at ``cap`` times its source's size;
    what is over is shared again by weight among the others. The sources that stop
    are those with the smallest cap per weight: they are found by one pass over the
    sources in that order, so no loop is needed. Sources without words get 0.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = sizes.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                                                 (turn + 1).cast("int")))
    limit = F.lit(float(cap)) * F.col("source_size")
    ordered = Window.orderBy("ratio", F.col("source").isNull(), F.col("source"))
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    rest = ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (weighed.withColumn("limit", limit).withColumn("ratio", F.col("limit") / F.col("w"))
             .withColumn("left", F.sum("source_size").over(everything)
                         - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
             .withColumn("wsum", F.sum("w").over(rest))
             # the first source that stays below its cap fixes the level of all after it
             .withColumn("stops", F.col("left") * F.col("w") / F.col("wsum") >= F.col("limit"))
             .withColumn("open", F.min(F.when(~F.col("stops"), F.struct("ratio", F.col("source").isNull(),
                                                                      "source", "left", "wsum"))).over(everything)))
    return level.select("source", "source_size", "n", F.when(F.col("stops"), F.col("limit")).otherwise(
        F.col("open.left") * F.col("w") / F.col("open.wsum")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=(1, 2, 3), cap: float = 3.0, seed: int = 7, weight=quality, bucket: int = BUCKET,
        row_col: str | None = None) -> DataFrame:
    """One row per document: row, id, source, size, source_size, target, epochs (whole
    copies of its source), picked (taken once more for the fraction) and taken.

    The size is the number of words ``[^\\x20\\x09-\\x0D]+``; null and empty texts have
    0. Null is a source of its own, the last. The document at which the budget runs
    out is taken if at least half of it fits, so a source's taken words differ from
    its target by at most half a document. Keys come from the id alone: reruns agree,
    and rows that repeat an id follow each other, smaller ones first. An empty table
    gives no rows; other columns of ``docs`` are ignored. ``weight`` maps (size, code
    points) to a weight, taken as 1 below 1 and as 4 above 4.

    A source is split by ranges of its keys into parts of about ``bucket`` rows: their
    sums are few, so no task sees a whole source. ``row_col``: the row numbers of
    ``with_row``, if ``docs`` has them.
    """
    rows = numbered(docs, row_col, id=col(id_col), source=col(source_col).cast("string"), text=text_of(text_col))
    sized = stored(rows.select(
        "row", "id", "source", F.regexp_count("text", F.lit(WORD)).cast("long").alias("size"),
        F.length("text").cast("long").alias("points")), "sizes")
    heavy = F.greatest(F.lit(1.0), F.least(F.lit(HEAVIEST), weight(F.col("size"), F.col("points"))))
    sources = stored(targets(
        sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), weights, cap),
        "targets").withColumnRenamed("source", "s")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") / bucket))
    keyed = (sized.withColumn("key", -F.log(uniform(F.col("id"), seed)) / heavy)
             .join(sources, F.col("source").eqNullSafe(F.col("s"))).drop("s")
             .withColumn("epochs", whole.cast("long"))
             .withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
             # uniform for weight 1, at most four times as dense for heavier documents
             .withColumn("part", F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * parts)))
    sums = keyed.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("source").alias("s"), F.col("part").alias("p"),
                          F.coalesce(F.sum("part_size").over(before), F.lit(0)).alias("offset"))
    inside = (Window.partitionBy("source", "part").orderBy("key", F.col("id").isNull(), "id", "size", "row")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (keyed.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
              .withColumn("ahead", F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))))
    picked = (F.col("ahead") < F.col("budget")) & (F.col("ahead") + F.col("size") / 2 <= F.col("budget"))
    return placed.select(
        "row", "id", "source", "size", "source_size", "target", "epochs", picked.alias("picked"),
        (F.col("size") * (F.col("epochs") + picked.cast("long"))).alias("taken"))


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            source_col: str = "source", **kw) -> DataFrame:
    """The rows of ``docs``, all their columns, each as often as the mix takes it."""
    names = docs.columns
    whole, row = with_row(docs)
    copies, copy = fresh(docs, "__copies"), fresh(docs, "__copy")
    taken = (mix(whole, id_col, text_col, source_col, row_col=row, **kw)
             .select(F.col("row").alias(row), (F.col("epochs") + F.col("picked").cast("long")).cast("int")
                     .alias(copies)).where(F.col(copies) > 0))
    once = F.explode(F.array_repeat(F.lit(1), F.col(copies))).alias(copy)
    # the few bytes of `taken` are hashed: a merge join would hold and sort whole texts in memory
    return whole.join(taken.hint("shuffle_hash"), row).select(*[col(c) for c in names], once).select(*[col(c) for c in names])
