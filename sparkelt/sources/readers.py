"""Batch and streaming readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkelt.sources.storage import is_file


def read_kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    *,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """One topic from its earliest offset. Offsets live in the checkpoint, so no group id is set.

    ``min_partitions`` splits large topic partitions over more tasks than the topic has partitions.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    if min_partitions is not None:
        reader = reader.option("minPartitions", min_partitions)
    return reader.load()


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def stream_parquet(
    spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None
) -> DataFrame:
    """A parquet file or folder as a bounded stream: the offline twin of the topic source."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if is_file(spark, path):  # the file source wants a folder
        folder, _, name = path.rpartition("/")
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)
