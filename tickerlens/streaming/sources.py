"""Streaming inputs: the file source and the bus source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlens.schemas import POST


def read_post_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Streaming posts from a folder of JSON-line files (SRC-4 via a file
    source, JSON data source with the explicit schema). A bus source plugs in
    through ``kafka_value_stream`` + ``readers.parse_posts``."""
    return (spark.readStream.schema(POST).option("mode", "PERMISSIVE")
            .option("maxFilesPerTrigger", max_files_per_trigger).json(path)
            .where(F.col("text").isNotNull()))


def read_tick_stream(spark: SparkSession, path: str) -> DataFrame:
    """Ticks (``ts``) from a folder, the staged form of ``trending.clock_ticks``."""
    return spark.readStream.schema("ts timestamp").parquet(path)


def kafka_value_stream(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest",
                       max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Bus source: message values as strings (SRC-4, STM-10). Needs the Kafka
    connector on the classpath; the key is dropped as in the reference.
    ``max_offsets_per_trigger`` bounds a micro-batch, as the poll size does there."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select(F.col("value").cast("string").alias("value"), "timestamp")
