"""Partition-key expressions: truncation, hash buckets, identity copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusdeck.schemas import Bucket, Identity, PartitionKey, TableSpec, Truncate


def truncated(column: str | Column, width: int) -> Column:
    """Floor to a multiple of ``width``, towards minus infinity."""
    value = F.col(column) if isinstance(column, str) else column
    return value - F.pmod(value, F.lit(width))


def bucketed(column: str | Column, count: int) -> Column:
    """Hash bucket by Spark's own hash; a NULL has a bucket too."""
    value = F.col(column) if isinstance(column, str) else column
    return F.pmod(F.hash(value), F.lit(count))


def bucket_of(value: str, count: int) -> Column:
    """The bucket of a literal; folded to a constant before the scan is planned."""
    return bucketed(F.lit(value), count)


def key_column(key: PartitionKey) -> Column:
    if isinstance(key, Truncate):
        return truncated(key.column, key.width)
    if isinstance(key, Bucket):
        return bucketed(key.column, key.count)
    if isinstance(key, Identity):
        return F.col(key.column)
    raise TypeError(f"unknown partition key {key!r}")


def with_layout_keys(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.withColumns({key.name: key_column(key) for key in spec.partition_by})
