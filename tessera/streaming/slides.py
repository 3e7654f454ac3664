"""Slides as a stream of files: each run handles those that the checkpoint hasn't met."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names

_FILES = "path string, modificationTime timestamp, length long, content binary"


def slide_stream(spark: SparkSession, path: str, recursive: bool = False, max_files: int | None = None) -> DataFrame:
    """A stream of (path, slide_id, modificationTime, length) of slide files."""
    reader = spark.readStream.format("binaryFile").schema(_FILES).option("recursiveFileLookup", str(recursive).lower())
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    files = reader.load(path).where(names.is_slide(F.col("path")))
    return files.select("path", names.sample_id(F.col("path")).alias("slide_id"), "modificationTime", "length")


def run_new(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hands the slides that are new since the last run to `each`, in batches, and ends. A batch that failed comes again with the same number."""
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def error_rates(events: DataFrame, late: str = "1 hour", window: str = "1 day") -> DataFrame:
    """Events a window and type, from a stream or a table; rows later than the watermark are left out of a stream's windows."""
    marked = events.withWatermark("ts", late) if events.isStreaming else events
    out = marked.groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("start"), "event_type", "n", "total")
