"""Exported resource-usage metrics: one row per data point and series."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locusdeck.functions.minutes import ceil_minute, floor_minute, parse_utc

# --- fixed values: the series that are billed ---
RESOURCES = ("vcpu", "mem", "storage")
WORKER_TYPES = ("Spark_Driver", "Spark_Executor", "Spark_Kernel")
CAPACITY_TYPES = ("OnDemandCapacity", "PreInitCapacity")
# --- end of fixed values ---


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return billed(spark.read.parquet(path))


def billed(metrics: DataFrame) -> DataFrame:
    """Only the billed series, as (ts, resource, worker_type, capacity_type, value)."""
    return metrics.select("ts", "resource", "worker_type", "capacity_type", "value").filter(
        F.col("resource").isin(*RESOURCES)
        & F.col("worker_type").isin(*WORKER_TYPES)
        & F.col("capacity_type").isin(*CAPACITY_TYPES)
    )


def _utc(time: datetime | str) -> datetime:
    return parse_utc(time) if isinstance(time, str) else time


def between(metrics: DataFrame, start: datetime | str, end: datetime | str) -> DataFrame:
    """Points of [floor(start), ceil(end)), both given in UTC and widened to full minutes.

    The bounds are literals of the column's own type, so the range reaches the file scan.
    """
    kind = metrics.schema["ts"].dataType
    zone = "" if isinstance(kind, T.TimestampNTZType) else "Z"
    low = floor_minute(F.lit(_utc(start).isoformat(" ") + zone).cast(kind))
    high = ceil_minute(F.lit(_utc(end).isoformat(" ") + zone).cast(kind))
    return metrics.filter((F.col("ts") >= low) & (F.col("ts") < high))
