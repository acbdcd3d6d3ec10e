"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import io
import os
import uuid
import zipfile

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellata.session import checkpoint_dir

#: The white space that all contracts name: blank and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: Spark's setting to remove the shuffle files of a query when it ends.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_path(spark, label: str) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def ship_code(spark) -> None:
    """Send this package to the executors, once per application, so that their Python
    workers can import it wherever the driver found it. The archive is written to the
    shared folder."""
    sc = spark.sparkContext
    if getattr(sc, "_stellata_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    target = spark._jvm.org.apache.hadoop.fs.Path(shared_path(spark, "code") + "/stellata.zip")
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(archive.getvalue()))
    out.close()
    sc.addPyFile(target.toString())
    sc._stellata_shipped = True


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: the lineage
    ends there, so a lost executor costs at most the reading of the table, and the
    shuffle files that it was made from go at once."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    before = spark.conf.get(_DROP_SHUFFLES)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)
    back = spark.read.schema(df.schema).parquet(path)
    back.stored_path = path
    return back


def dropped(*tables: DataFrame) -> None:
    """Delete what ``stored`` wrote for these tables, once nothing reads them any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def col(name: str) -> Column:
    """A column by its plain name (dots and blanks are part of the name)."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def numbered(df: DataFrame, by: str | None = None, **columns: Column) -> DataFrame:
    """The named columns of ``df`` and ``row``, a number for each row.

    The numbers are those of the column ``by`` (see ``with_row``). Without it they are
    those of one scan: another scan may number the rows otherwise, so they must not
    be matched with those of a second pass. Other columns of ``df`` are left behind,
    so their names cannot clash.
    """
    ship_code(df.sparkSession)
    row = F.monotonically_increasing_id() if by is None else col(by)
    return df.select(row.alias("row"), *[c.alias(k) for k, c in columns.items()])


#: A key with more than one in so many rows is hot: there are at most as many such keys.
HOT_SHARE = 1000


def joined(left: DataFrame, right: DataFrame, keys: list[str], weight: str, inner: bool = False) -> DataFrame:
    """``left`` joined with ``right`` (one row per key; ``weight``: how many rows of ``left`` have
    the key) without sending the rows of a hot key to one task.

    The rows of ``right`` for keys that hold more than one in ``HOT_SHARE`` rows are fewer than
    that; they are broadcast, and the rows of ``left`` with them stay where they are."""
    total = right.agg(F.sum(weight)).first()[0] or 0
    hot = F.broadcast(right.where(F.col(weight) * HOT_SHARE > total))
    how = "inner" if inner else "left"
    rest = left.join(hot.select(*keys), keys, "left_anti").join(
        right.where(F.col(weight) * HOT_SHARE <= total), keys, how)
    return left.join(hot, keys).unionByName(rest)


def slices(column, size: int):
    """Ranges (begin, end) of the rows of an Arrow string or binary column with about
    ``size`` bytes each, one row at least: what Python objects are made of at a time."""
    begin = total = 0
    lengths = pc.binary_length(column).to_pylist()
    for i, n in enumerate(lengths):
        total += n or 0
        if total >= size:
            yield begin, i + 1
            begin, total = i + 1, 0
    if begin < len(lengths):
        yield begin, len(lengths)


def release() -> None:
    """Return to the system what Arrow and the C library hold though it is free."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU C library
        pass


def tidy(run):
    """``run``, a function for mapInArrow, with ``release`` at the end of each task: Spark
    keeps its Python workers beside the tasks of the stages that follow."""
    def tidied(batches):
        yield from run(batches)
        release()

    return tidied


def without(whole: DataFrame, gone: DataFrame, row: str) -> DataFrame:
    """The rows of ``whole`` whose number ``row`` is not in ``gone`` (one column, ``row``).

    The numbers of a partition are hashed and the whole rows streamed past them: a merge
    join would hold and sort their texts in memory."""
    return whole.join(gone.hint("shuffle_hash"), row, "left_anti")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, longer if ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Bits of a row number that say the place in the file and, above them, which file it is.
_PLACE_BITS, _FILE_BITS = 32, 31


def _is_parquet_scan(df: DataFrame) -> bool:
    """Whether ``df`` only reads Parquet files, each of them once."""
    plan = df._jdf.queryExecution().analyzed()
    if plan.getClass().getSimpleName() != "LogicalRelation" or "_metadata" in [c.lower() for c in df.columns]:
        return False
    relation = plan.relation()
    if (relation.getClass().getSimpleName() != "HadoopFsRelation"
            or relation.fileFormat().getClass().getSimpleName() != "ParquetFileFormat"):
        return False
    files = list(relation.location().inputFiles())
    return len(set(files)) == len(files)


def _number_in_files(df: DataFrame) -> Column | None:
    """A row number made of a hash of the file's path and the place in the file, if some
    hash tells all files of ``df`` apart."""
    path, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    hashes = [F.xxhash64(path, F.lit(seed)).bitwiseAND(F.lit((1 << _FILE_BITS) - 1)) for seed in range(8)]
    files = df.select(path.alias("path"), place.alias("place"), *[h.alias(f"h{k}") for k, h in enumerate(hashes)])
    files = files.groupBy("path", *[f"h{k}" for k in range(len(hashes))]).agg(F.max("place").alias("last"))
    n, last, *apart = files.agg(F.count("*"), F.max("last"), *[
        F.count_distinct(f"h{k}") for k in range(len(hashes))]).first()
    if n not in apart or (last or 0) >= 1 << _PLACE_BITS:
        return None
    return F.shiftleft(hashes[apart.index(n)], _PLACE_BITS).bitwiseOR(place)


def with_row(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with a row number beside all its columns, and the name of that column.

    Every pass over the result has the same numbers, however its scan is split: those
    of a Parquet table are made of the file and the place in it, any other plan is
    written once with its numbers and read back."""
    name = fresh(df, "__row")
    row = _number_in_files(df) if _is_parquet_scan(df) else None
    if row is None:
        return stored(df.withColumn(name, F.monotonically_increasing_id()), "numbered"), name
    return df.select(*[col(c) for c in df.columns], row.alias(name)), name
