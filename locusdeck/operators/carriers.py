"""Carrier counts: distinct samples per group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusdeck.operators.joins import fits_broadcast, locus_join
from locusdeck.schemas import LOCUS

SAMPLE = "sample_name"


def carriers(df: DataFrame, by: Sequence[str | Column], rows: str | None = None) -> DataFrame:
    """Distinct samples per group, with the row count under the name ``rows`` if asked for.

    A single distinct needs no row expansion: Spark merges per (group, sample) in the map
    tasks and shuffles on both, so a group that holds most rows is still spread by sample.
    """
    counts = [F.countDistinct(SAMPLE).alias("carrier_count")]
    if rows:
        counts.insert(0, F.count("*").alias(rows))
    return df.groupBy(*by).agg(*counts)


def cohort_carriers(
    df: DataFrame, by: Sequence[str | Column], cohorts: Mapping[str, Column]
) -> DataFrame:
    """Distinct samples per group and cohort, all cohorts side by side.

    Two plain aggregations: first whether a sample is seen in each cohort of a group, then
    how many are. Several conditional distinct counts in one step would multiply each row
    by the number of cohorts.
    """
    flags = [
        F.max(F.coalesce(condition, F.lit(False)).cast("int")).alias(name)
        for name, condition in cohorts.items()
    ]
    per_sample = df.groupBy(*by, SAMPLE).agg(*flags)
    groups = [c for c in per_sample.columns if c != SAMPLE and c not in cohorts]
    # A NULL sample is no carrier, but its group stays in the result.
    counted = [
        F.sum(F.when(F.col(SAMPLE).isNotNull(), F.col(name)).otherwise(0)).cast("long").alias(name)
        for name in cohorts
    ]
    return per_sample.groupBy(*groups).agg(*counted)


def rows_by_annotation(
    variants: DataFrame,
    annotations: DataFrame,
    group: str,
    name: str,
    count_first: bool | None = None,
) -> DataFrame:
    """Variant rows per value of an annotation column, over the locus join.

    Counting per locus before the join leaves one row per locus to shuffle, however many rows
    a locus has; it is right because a locus has one annotation. Where the annotations can be
    broadcast there is no shuffle by locus to save, so rows are joined first. ``count_first``
    overrides the choice.
    """
    fits = fits_broadcast(annotations)
    if count_first is None:
        count_first = not fits
    if count_first:
        variants = variants.groupBy(*LOCUS).agg(F.count("*").alias("_rows"))
        total = F.sum("_rows")
    else:
        total = F.count("*")
    joined = locus_join(variants, annotations, fits=fits)
    return joined.groupBy(F.col(f"a_{group}").alias(group)).agg(total.alias(name))
