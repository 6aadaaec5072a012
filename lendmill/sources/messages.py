"""Raw input: broker messages, message files and plain JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)
LINE_ORDER = ("source_file", "source_block", "source_line")


def broker_messages(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int = 100_000,
) -> DataFrame:
    """Stream of one topic. Needs Spark's Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", "false")
        .option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        .load()
    )


def message_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of parquet files that hold messages in the shape of the broker source."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def decode(messages: DataFrame) -> DataFrame:
    """Messages as text with their coordinates."""
    return messages.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_value"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    )


def raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """One record per line, verbatim, with columns that restore the order of arrival:
    file name, start of the split, line within the split (``LINE_ORDER``)."""
    return spark.read.text(path).select(
        F.col("value").alias("raw_value"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("source_block"),
        F.monotonically_increasing_id().alias("source_line"),
    )
