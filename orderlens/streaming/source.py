"""File-log sources.  A connector frame (key, value) goes through ``ingest.from_log`` instead."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.schemas import BASE


def file_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
    """A stream over a parquet folder, or over one file inside its folder."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if fs.getFileStatus(fs_path).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", fs_path.getName()).parquet(str(fs_path.getParent()))


def event_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Events with a zoned event time: watermarks need TIMESTAMP, the files hold zone-free ones."""
    raw = file_stream(spark, f"{folder}/events.parquet", BASE["events"], files_per_batch)
    return raw.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("value", F.col("value").cast("decimal(12,2)"))


def run_available(writer, checkpoint: str) -> None:
    """Consumes what is there and stops; offsets move on with the checkpoint."""
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
