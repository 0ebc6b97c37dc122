"""Readers for the parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, data_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read ``<data_dir>/<name>.parquet``, projecting ``columns`` at the scan."""
    df = spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    return df


def read_events(spark: SparkSession, data_dir: str, columns: list[str] | None = None) -> DataFrame:
    """The ``events`` table with ``ts`` as a zoned TIMESTAMP (session zone).

    The file stores TIMESTAMP_NTZ; watermarks and zone-aware day/hour keys
    need TIMESTAMP, so the cast happens once here, right after the scan.
    """
    cols = columns or ["event_id", "ts", "user_id", "event_type", "value", "props"]
    df = read_table(spark, data_dir, "events", cols)
    if "ts" in cols:
        df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    return df
