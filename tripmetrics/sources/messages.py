"""Message-log sources (S1) and the payload splitter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmetrics.schema import MESSAGE_SCHEMA

LINE_SEPARATOR = "\r\n"
MAX_OFFSETS_PER_TRIGGER = 5_000_000


def kafka_available(spark: SparkSession) -> bool:
    """True when the Kafka connector is on the classpath."""
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:  # noqa: BLE001 - any JVM lookup failure means "absent"
        return False


def record_id(topics: list[str]) -> Column:
    """A BIGINT that no two records of ``topics`` share: offsets repeat across
    topics and partitions, so both are part of the id.  Up to 64 topics of
    4,096 partitions and offsets below 2**45; beyond that it raises."""
    if len(topics) > 64:
        raise ValueError("at most 64 topics per stream")
    names = ", ".join("'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'" for t in sorted(topics))
    return F.expr(
        "CASE WHEN partition < 4096 AND offset < 35184372088832 "
        f"THEN (offset * 64 + array_position(array({names}), topic) - 1) * 4096 + partition "
        "ELSE raise_error('record outside the id range') END").cast("long")


def message_stream(spark: SparkSession, *, topics: list[str] | None = None,
                   bootstrap_servers: str | None = None, path: str | None = None,
                   file_format: str = "parquet", max_files_per_trigger: int | None = None,
                   starting_offsets: str = "latest",
                   max_offsets_per_trigger: int = MAX_OFFSETS_PER_TRIGGER) -> DataFrame:
    """Streaming DataFrame ``(event_id, ts, value)`` of trip messages.

    With ``topics`` and ``bootstrap_servers`` it reads Kafka (``event_id`` is
    made of record offset, topic and partition, see ``record_id``; ``ts`` is
    the record time; starting at the latest offset like the original job).
    ``max_offsets_per_trigger`` bounds a catch-up batch.  With ``path`` it reads a folder of
    message files with the fixed envelope schema -- the same downstream plan.
    """
    if topics:
        if not kafka_available(spark):
            raise RuntimeError("Kafka source requested but the spark-sql-kafka connector is not on the classpath")
        raw = (spark.readStream.format("kafka")
               .option("kafka.bootstrap.servers", bootstrap_servers)
               .option("subscribe", ",".join(topics))
               .option("startingOffsets", starting_offsets)
               .option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
               .load())
        return raw.select(
            record_id(topics).alias("event_id"),
            F.col("timestamp").alias("ts"),
            F.col("value").cast("string").alias("value"))
    if not path:
        raise ValueError("message_stream needs topics or a path")
    reader = spark.readStream.format(file_format).schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def read_messages(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Batch read of a message folder with the envelope schema."""
    return spark.read.format(file_format).schema(MESSAGE_SCHEMA).load(path)


def split_payloads(messages: DataFrame) -> DataFrame:
    """One row per non-blank CRLF-separated line of each message.

    Output ``(event_id, line_no, ts, line)``; ``line_no`` is the 0-based
    position in the payload, so ``(event_id, line_no)`` identifies a trip.
    Blank segments (including the one after a trailing CRLF) are dropped.
    """
    exploded = messages.select(
        "event_id", "ts",
        F.posexplode(F.split(F.col("value"), LINE_SEPARATOR)).alias("line_no", "line"))
    return exploded.where(F.length(F.trim(F.col("line"))) > 0)


def print_messages(messages: DataFrame, truncate: bool = False):
    """S3: echo every raw message of a stream to the console (debug sink)."""
    return (messages.writeStream.format("console").option("numRows", str(2 ** 31 - 2))
            .option("truncate", str(truncate).lower()))
