"""Incremental intake: new record files become rows once, however often they are delivered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from inkweave.sources.files import SCHEMAS


def arriving(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Record files of ``table`` as they arrive in ``folder``, with loaded_at."""
    return spark.readStream.schema(f"{SCHEMAS[table]}, loaded_at timestamp").json(folder)


def once_within(stream: DataFrame, late: str = "60 days") -> DataFrame:
    """Each (vol, id) once: a repeated delivery within ``late`` of the newest row is dropped, and its state forgotten after that."""
    return stream.withWatermark("loaded_at", late).dropDuplicatesWithinWatermark(["vol", "id"])


def figures_by_day(stream: DataFrame, late: str = "60 days") -> DataFrame:
    """day, vol, rows, chars of what has arrived, by day of loading."""
    day = F.window("loaded_at", "1 day")
    counted = stream.withWatermark("loaded_at", late).groupBy(day, "vol")
    return counted.agg(F.count("*").alias("rows"), F.sum(F.length(F.coalesce("text", F.lit("")))).alias("chars")).select(F.col("window.start").alias("day"), "vol", "rows", "chars")


def append_once(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes what is there now to Parquet by volume and ends; a later run goes on from the checkpoint."""
    return (
        stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).partitionBy("vol")
        .outputMode("append").trigger(availableNow=True).start(path)
    )
