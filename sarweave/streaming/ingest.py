"""Streams: new files of a growing tree, and windowed counts of vessel reports with late data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sarweave.functions import names as N
from sarweave.sources.files import read_header

BINARY = "path string, modificationTime timestamp, length long, content binary"


def new_rasters(spark: SparkSession, root: str, per_trigger: int = 1000) -> DataFrame:
    """Headers of rasters as they arrive below root; each file is read once."""
    s = spark.readStream.format("binaryFile").schema(BINARY).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", per_trigger).load(root)
    p = F.col("path")
    return s.where(N.is_raster(p)).select("path", N.stem(p).alias("stem"), N.pairing_key(N.stem(p)).alias("key"), N.is_mask_name(N.stem(p)).alias("is_mask"), read_header("content").alias("h")).select("path", "stem", "key", "is_mask", "h.*")


def track_windows(events: DataFrame, minutes: int = 60, late: str = "2 hours") -> DataFrame:
    """Reports, vessels and mean speed in windows of time; later rows than the watermark are dropped by the engine."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return e.groupBy(F.window("ts", f"{minutes} minutes").alias("w"), "event_type").agg(F.count("*").alias("reports"), F.approx_count_distinct("user_id").alias("vessels"), F.avg("value").alias("mean_value")).select("w.start", "w.end", "event_type", "reports", "vessels", "mean_value")


def into_folder(stream: DataFrame, path: str, checkpoint: str, each: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Run a stream over all that is there, exactly once per file, as Parquet or through a function of each batch."""
    w = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return (w.foreachBatch(each) if each else w.format("parquet").option("path", path)).start()
