"""The hourly weather ingest run incrementally with Structured Streaming.

New station-year files dropped under the weather folder are picked up by a
file stream (``binaryFile`` source, same name filter as the batch reader),
turned into hourly readings by the same per-file expressions, aggregated to
daily rows and written to a Parquet table (one folder per micro-batch). Each file is one station-year, so a
(station, day) group never spans two files and the daily aggregate of a
micro-batch is final; no state has to be kept between batches. The stream's
checkpoint (offsets + commit log) lives in the shared checkpoint folder, so a
restarted query skips files it already committed.

``trigger(availableNow=True)`` processes what is there and stops, which makes
the same code usable as a scheduled incremental batch.

Limit: a second copy of a station-year file under another path is merged with
the first by the batch reader (as the source tool does) but, if it arrives in a
later micro-batch, gives its own daily rows here. Re-run the batch job
(``hourly_to_daily(read_weather_hourly(...))``) over folders where copies are
possible.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stellata.operators.aggregates import hourly_to_daily
from stellata.sources.tables import YEARS
from stellata.sources.weather import NAME_GLOB, hourly_from_files
from stellata.session import checkpoint_dir

# the fixed schema of the binaryFile source
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def weather_file_stream(spark: SparkSession, root: str, years=YEARS,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("recursiveFileLookup", True)
              .option("pathGlobFilter", NAME_GLOB))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    files = reader.load(root).select(F.col("path").alias("arquivo"), "content")
    tail = re.escape(root.rstrip("/").split("/")[-1])
    year = F.regexp_extract("arquivo", f"{tail}/([0-9]{{4}})/", 1)
    files = (files.withColumn("ano", F.when(year != "", year.cast("int")))
             .where(F.col("ano").isin(*years)))
    return files.select("arquivo", "ano", F.decode("content", "ISO-8859-1").alias("texto"))


def start_daily_ingest(spark: SparkSession, root: str, output: str,
                       checkpoint: str | None = None, available_now: bool = True,
                       processing_time: str = "1 minute",
                       max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the incremental hourly -> daily ingest; returns the running query."""
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/weather-daily-stream"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # one folder per micro-batch, overwritten if the batch is replayed
        # after a failure: the output stays exactly-once
        daily = hourly_to_daily(hourly_from_files(batch))
        daily.write.mode("overwrite").parquet(f"{output.rstrip('/')}/lote={batch_id}")

    writer = (weather_file_stream(spark, root, max_files_per_trigger=max_files_per_trigger).writeStream
              .foreachBatch(write_batch).option("checkpointLocation", ckpt))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=processing_time)
    return writer.start()
