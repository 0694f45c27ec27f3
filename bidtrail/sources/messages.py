"""Message sources and sinks.

The Kafka functions need the Kafka package of the cluster's Spark; every operator takes a frame with the
columns key, value, topic, partition and offset, so any other source of that shape works as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Start positions as older consumers name them.
START_NAMES = {"smallest": "earliest", "largest": "latest"}


def kafka_options(
    servers: str,
    topics: str,
    start: str = "latest",
    group: str | None = None,
    min_partitions: int | None = None,
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of a topic subscription; `topics` is a comma-separated list."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics,
        "startingOffsets": START_NAMES.get(start, start),
    }
    if group:
        options["kafka.group.id"] = group
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def as_messages(raw: DataFrame) -> DataFrame:
    """Binary key and value as UTF-8 text, with the position columns."""
    return raw.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset",
    )


def kafka_stream(spark: SparkSession, **options) -> DataFrame:
    return as_messages(spark.readStream.format("kafka").options(**kafka_options(**options)).load())


def kafka_range(spark: SparkSession, servers: str, topic: str, partition: int, start: int | str = "earliest") -> DataFrame:
    """Messages of one topic partition from a given offset (or 'earliest') to the present end."""
    position = {"earliest": -2, "latest": -1}.get(start, start)
    reader = spark.read.format("kafka").options(
        **{
            "kafka.bootstrap.servers": servers,
            "assign": f'{{"{topic}":[{partition}]}}',
            "startingOffsets": f'{{"{topic}":{{"{partition}":{position}}}}}',
            "endingOffsets": f'{{"{topic}":{{"{partition}":-1}}}}',
        }
    )
    return as_messages(reader.load())


def kafka_publish(lines: DataFrame, servers: str, topic: str) -> None:
    """One message per line, without a key."""
    lines.select("value").write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def file_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Parquet files as a stream; max_files bounds a micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(path)
