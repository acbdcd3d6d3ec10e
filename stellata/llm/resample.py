"""Importance resampling towards a target distribution, on Arrow kernels.

Words come from ``ascii_lower``, ``split_pattern_regex``, ``list_flatten`` and
``dictionary_encode``. Longer features are made of shifted dictionary indices: the code
of an n-gram is (code of its first n-1 words, index of its last word), encoded anew for
each length. Only distinct pairs are hashed: a CRC-32 is carried on from the CRC of the
first words. Feature weights are taken by code and reduced per document.

Two passes read the texts: one counts hashed features, one weighs documents. The counts
of a task are one vector of ``buckets`` numbers, whatever it reads.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stellata.llm.common import col, numbered, ship_code, slices, stored, text_of

#: What lies between words: every ASCII character but digits and lower-case letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS, SEED, LEAST_WORDS, PERCENT = 10_000, 2024, 20, 10
#: Bytes of text that are split at a time.
SLICE = 4 << 20


# --- kernels ---------------------------------------------------------------------

def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(first word of each text and the end, dictionary index of each word, distinct
    words) of a string array without nulls."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), BETWEEN)
    flat = pc.list_flatten(lists).dictionary_encode()
    index = np.asarray(flat.indices).astype(np.int64)
    words = [w.encode() for w in flat.dictionary.to_pylist()]
    ends = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists)))]).astype(np.int64)
    # text that begins or ends between words leaves empty strings
    there = np.array([w != b"" for w in words], dtype=bool)[index] if words else np.zeros(0, bool)
    before = np.concatenate([[0], np.cumsum(there)])
    return before[ends], index[there], words


def features(texts: pa.Array, longest: int):
    """For each length from 1 to ``longest``: (first feature of each text and the end,
    code of each feature, CRC-32 of each code)."""
    starts, index, words = words_of(texts)
    crcs = np.array([zlib.crc32(w) for w in words], dtype=np.int64)
    n_words = np.diff(starts)
    left = np.repeat(starts[1:], n_words) - np.arange(len(index))  # words from here to the end
    place, code, made = np.arange(len(index)), index, crcs
    for n in range(1, longest + 1):
        if n > 1:
            open_ = left[place] >= n
            place = place[open_]
            pairs = pa.array(code[open_] * max(len(words), 1) + index[place + n - 1]).dictionary_encode()
            distinct = np.asarray(pairs.dictionary).astype(np.int64)
            code = np.asarray(pairs.indices).astype(np.int64)
            made = np.array([zlib.crc32(b" " + words[w], crc) for crc, w in zip(
                made[distinct // max(len(words), 1)].tolist(), (distinct % max(len(words), 1)).tolist())],
                dtype=np.int64)
        at = np.concatenate([[0], np.cumsum(np.maximum(n_words - n + 1, 0))])
        yield at, code, made


def _texts(batch):
    column = batch.column("text")
    for begin, end in slices(column, SLICE):
        yield begin, end, column.slice(begin, end - begin)


# --- counts ----------------------------------------------------------------------

def feature_counts(rows: DataFrame, text_col: str = "text", longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of all texts fall in each bucket that has any."""
    texts = numbered(rows, text=text_of(text_col)).select("text")

    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, texts in _texts(batch):
                for _, code, crc in features(texts, longest):
                    total += np.bincount((crc % buckets)[code], minlength=buckets)
        some = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    return texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket, in thousandths of a natural logarithm, rounded down: the
    smoothed share of the target's features over that of the raw features. Both tables
    of counts have at most ``buckets`` rows, which the driver reads."""
    def vector(counts):
        out = [0] * buckets
        for r in counts.collect():
            out[r["bucket"]] = r["n"]
        return out

    s, t = vector(raw), vector(target)
    all_s, all_t = float(sum(s) + buckets), float(sum(t) + buckets)
    return np.array([math.floor(1000 * math.log((b + 1.0) * all_s / ((a + 1.0) * all_t))) for a, b in zip(s, t)],
                    dtype=np.int64)


# --- weights and the draw -----------------------------------------------------------

def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
            longest: int = 1) -> DataFrame:
    """id, n_words, n_features and weight (mean gain of the features, rounded down; 0
    without any) per document."""
    rows = numbered(docs, id=col(id_col), text=text_of(text_col))
    buckets = len(gain)

    def run(batches):
        for batch in batches:
            for begin, end, texts in _texts(batch):
                n_words, n, total = None, np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
                for at, code, crc in features(texts, longest):
                    taken = np.concatenate([[0], np.cumsum(gain[crc % buckets][code])])
                    total += taken[at[1:]] - taken[at[:-1]]
                    n += np.diff(at)
                    n_words = np.diff(at) if n_words is None else n_words
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(begin, end - begin), pa.array(n_words), pa.array(n),
                     pa.array(total // np.maximum(n, 1))], names=["id", "n_words", "n_features", "weight"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "text").mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long")


def luck(key: Column, seed: int) -> Column:
    """Gumbel noise of an id in thousandths, rounded down; the same in every run."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln(u))).cast("long")


def ranked(rows: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``rows`` numbered from 1 in that order, without a sort in one task: they are dealt
    by ranges and stored, and each part adds the number of rows in those before it. The
    only table that one task sees whole has a row per part."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = stored(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                    .withColumn("at__", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("at__", 33)
    before = Window.orderBy("part__").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(part.alias("part__")).agg(F.count("*").alias("n__")).select(
        "part__", F.coalesce(F.sum("n__").over(before), F.lit(0)).alias("ahead__"))
    local = F.col("at__").bitwiseAND(F.lit((1 << 33) - 1))
    # one row per part
    return (placed.join(F.broadcast(offsets), part == F.col("part__"))
            .withColumn(name, F.col("ahead__") + local + 1).drop("at__", "part__", "ahead__"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text", longest: int = 1, buckets: int = BUCKETS, seed: int = SEED,
             least: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: id, n_words, n_features, weight, score and rank (null if the
    document is not drawn).

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased;
    features are all runs of 1 to ``longest`` words. The score is the weight plus Gumbel
    noise of the id, so the highest scores are a draw without replacement in proportion
    to the exponential of the weight. Of the N documents with ``least`` words or more,
    floor(percent * N / 100) are drawn; ties go to the smaller id, null last. Null and
    empty texts have no features and weight 0. Rows that repeat an id share its noise
    and are ranked apart. An empty table gives no rows, an empty target leaves the
    smoothing alone; other columns are ignored.
    """
    ship_code(docs.sparkSession)
    gain = gains(feature_counts(docs, text_col, longest, buckets), feature_counts(target, target_col, longest, buckets),
                 buckets)
    scored = stored(weights(docs, gain, id_col, text_col, longest)
                    .withColumn("score", F.col("weight") + luck(F.col("id"), seed)), "scored")
    able = scored.where(F.col("n_words") >= least)
    draw = able.count() * percent // 100
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    placed = ranked(able, order).withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")).cast("long"))
    others = scored.where(F.col("n_words") < least).withColumn("rank", F.lit(None).cast("long"))
    return placed.unionByName(others)
