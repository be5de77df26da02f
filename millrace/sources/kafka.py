"""Kafka-shaped rows: decoding, encoding and connector options."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def kafka_source_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    committed_only: bool = False,
) -> dict[str, str]:
    """Options of a Kafka read."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting_offsets}
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if committed_only:
        options["kafka.isolation.level"] = "read_committed"
    return options


def read_kafka(spark: SparkSession, **kwargs: object) -> DataFrame:
    """A Kafka stream; needs the connector package on the cluster."""
    return spark.readStream.format("kafka").options(**kafka_source_options(**kwargs)).load()


def kafka_decode(messages: DataFrame, schema: StructType | str, offsets: bool = True) -> DataFrame:
    """Bytes to typed columns; a value that is not JSON gives NULLs.

    ``offsets`` keeps key, topic, partition, offset and the broker's time.
    """
    data = F.from_json(F.col("value").cast("string"), schema).alias("data")
    if not offsets:
        return messages.select(data).select("data.*")
    return messages.select(
        F.col("key").cast("string").alias("key"),
        data,
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
    ).select("key", "data.*", "topic", "partition", "offset", "kafka_timestamp")


def kafka_encode(df: DataFrame, key: Column | str, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows as ``key`` and JSON ``value``, ready for a topic."""
    key_column = F.col(key) if isinstance(key, str) else key
    return df.select(
        key_column.cast("string").alias("key"), F.to_json(F.struct(*(columns or df.columns))).alias("value")
    )


def write_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """Send encoded rows; needs the connector package on the cluster."""
    df.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
