"""Ingestion: incremental pulls, text files with quarantine, validated events."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions import ntz
from orderlens.schemas import EVENT_TYPES
from orderlens.session import run_dir

CORRUPT = "_corrupt"


def incremental_pull(source: DataFrame, loaded: DataFrame, ts: str, keys: Sequence[str]) -> DataFrame:
    """Source rows from the newest loaded time on that are not loaded yet.

    The mark is a scalar (one row on the driver), so the filter is a literal that
    reaches the scans.  Rows at the mark itself are compared by key, so one that ties
    with the mark and arrives later is not lost.
    """
    mark = loaded.agg(F.max(ts).alias("mark")).first()["mark"]
    if mark is None:
        return source
    at = ntz(mark.isoformat(sep=" "))
    return source.filter(F.col(ts) >= at).join(loaded.filter(F.col(ts) == at).select(*keys).distinct(), list(keys), "left_anti")


def csv_stream(spark: SparkSession, folder: str, schema: str, pattern: str = "*.csv", files_per_batch: int = 1000):
    """A file stream of CSV text; lines that do not fit the schema keep their text in ``_corrupt``."""
    return (
        spark.readStream.schema(f"{schema}, {CORRUPT} string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )


def json_stream(spark: SparkSession, folder: str, schema: str, pattern: str = "*.json", files_per_batch: int = 1000):
    return (
        spark.readStream.schema(f"{schema}, {CORRUPT} string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(folder)
    )


def land(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Consumes what has arrived and writes good and quarantined rows in one pass.

    A batch's folder is named by its id and overwritten, so a replayed batch does
    not add its rows twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        split = batch.withColumn("outcome", F.when(F.col(CORRUPT).isNull(), "good").otherwise("quarantine"))
        split.write.mode("overwrite").partitionBy("outcome").parquet(f"{target}/batch_id={batch_id}")

    (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def landed(spark: SparkSession, target: str, schema: str) -> DataFrame:
    full = f"{schema}, {CORRUPT} string, outcome string, batch_id bigint"
    return spark.read.schema(full).parquet(target)


@dataclass(frozen=True)
class Pipe:
    """One ingestion definition: where files arrive, how they look, where they go."""

    name: str
    stage: str
    table: str
    file_format: str
    schema: str
    pattern: str


READERS = {"csv": csv_stream, "json": json_stream}


def run_pipes(spark: SparkSession, pipes: Sequence[Pipe], target_root: str) -> dict[str, DataFrame]:
    """Loads every definition into its table; the list of definitions is configuration."""
    out = {}
    for pipe in pipes:
        stream = READERS[pipe.file_format](spark, pipe.stage, pipe.schema, pipe.pattern)
        land(stream, f"{target_root}/{pipe.table}", f"{target_root}/_checkpoints/{pipe.name}")
        out[pipe.table] = landed(spark, f"{target_root}/{pipe.table}", pipe.schema)
    return out


# --- events ------------------------------------------------------------------


def problem(payload: Column, event_type: Column, value: Column, max_value: float = 100.0) -> Column:
    """First rule an event breaks, NULL for a valid one."""
    return (
        F.when(event_type.isNull() | ~event_type.isin(*EVENT_TYPES), "unknown event type")
        .when(F.get_json_object(payload, "$.k").isNull(), "payload lacks k")
        .when(value.isNull() | (value <= 0) | (value > max_value), "value out of range")
    )


def validate(events: DataFrame) -> DataFrame:
    """Events with ``problem`` and the parsed payload; works on static and streaming frames."""
    parsed = F.from_json("props", "k int")
    return events.withColumn("k", parsed["k"]).withColumn(
        "problem", problem(F.col("props"), F.col("event_type"), F.col("value"))
    )


def from_log(frame: DataFrame, schema: str) -> DataFrame:
    """Rows of a keyed log (``key``, ``value`` text as a log connector delivers) parsed and validated."""
    body = F.from_json(F.col("value").cast("string"), schema)
    return validate(frame.select(body.alias("e")).select("e.*"))


def stage_folder(spark: SparkSession, name: str) -> str:
    return run_dir(spark, name)
