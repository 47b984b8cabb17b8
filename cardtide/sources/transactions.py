"""The keyed event log as a stream: from a broker, or from a folder of recorded events."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardtide.schema import KEYED_EVENT, TOPIC


@dataclass(frozen=True)
class KafkaSource:
    """A topic of a Kafka-compatible broker; needs Spark's Kafka connector on the class path.

    ``starting_offsets`` holds for the first start only: later starts go on from the checkpoint.
    ``options`` passes anything else to the connector, above all ``maxOffsetsPerTrigger`` (the
    first start reads all that is retained) and ``minPartitions`` (to read a topic of few
    partitions, or one with a hot card, in more tasks than it has partitions).
    """

    bootstrap_servers: str
    topic: str = TOPIC
    starting_offsets: str = "earliest"
    options: Mapping[str, str] = field(default_factory=dict)

    def reader_options(self) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "subscribe": self.topic,
            "startingOffsets": self.starting_offsets,
            **self.options,
        }


@dataclass(frozen=True)
class FolderSource:
    """A folder that receives files: Parquet with ``key`` and ``value``, or text with one object per line.

    ``options`` goes to the file source: ``maxFilesPerTrigger``, ``maxBytesPerTrigger`` and so on.
    """

    path: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)


def read_transactions(spark: SparkSession, source: KafkaSource | FolderSource) -> DataFrame:
    """An unbounded DataFrame with the ``key`` and ``value`` bytes of each event."""
    if isinstance(source, KafkaSource):
        log = spark.readStream.format("kafka").options(**source.reader_options()).load()
        return log.select("key", "value")
    reader = spark.readStream.options(**source.options)
    if source.format == "parquet":
        return reader.schema(KEYED_EVENT).parquet(source.path)
    if source.format == "text":
        lines = reader.text(source.path)
        return lines.select(
            F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value")
        )
    raise ValueError(f"unknown folder format: {source.format}")
