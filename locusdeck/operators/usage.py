"""Unit-hours and cost of a run from minute-level resource metrics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusdeck.functions.minutes import floor_minute
from locusdeck.sources.usage_metrics import between, billed

# --- fixed values: USD per unit-hour, and the sampling period in seconds ---
RATES = {
    "ap-southeast-1": {"vcpu": 0.0633, "mem": 0.00696, "storage": 0.000111},
    "us-east-1": {"vcpu": 0.0520, "mem": 0.00571, "storage": 0.000111},
}
PERIOD_SECONDS = 60
# --- end of fixed values ---

SERIES = ("resource", "worker_type", "capacity_type")


def minutes(metrics: DataFrame, start: datetime | str, end: datetime | str) -> DataFrame:
    """Average value per series and minute inside the window."""
    minute = floor_minute(F.col("ts")).alias("minute")
    return (
        between(billed(metrics), start, end)
        .groupBy(*SERIES, minute)
        .agg(F.avg("value").alias("value"))
    )


def unit_hours(per_minute: DataFrame) -> DataFrame:
    """Unit-hours per series; a series without points has no row."""
    hours = F.sum("value") * F.lit(PERIOD_SECONDS / 3600)
    return per_minute.groupBy(*SERIES).agg(hours.alias("unit_hours"))


def rollup(per_minute: DataFrame) -> DataFrame:
    """Series above zero, resource totals and the grand total, in key order."""
    totals = unit_hours(per_minute).groupingSets(
        [list(SERIES), ["resource"], []], *SERIES
    ).agg(F.grouping_id().alias("level"), F.sum("unit_hours").alias("unit_hours"))
    names = {0: "series", 3: "resource", 7: "total"}
    level = F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), F.col("level").cast("int"))
    return (
        totals.filter((F.col("level") > 0) | (F.col("unit_hours") > 0))
        .select(level.alias("level"), *SERIES, "unit_hours")
        .orderBy(*[F.col(c).asc_nulls_last() for c in SERIES])
    )


def cost(per_minute: DataFrame, region: str) -> DataFrame:
    """Unit-hours, rate and cost per resource, and the total cost, at a region's rates.

    A resource without any points is reported with zero hours.
    """
    if region not in RATES:
        raise ValueError(f"no rates for region {region!r}")
    spark = per_minute.sparkSession
    listed = ", ".join(f"('{resource}', {rate}D)" for resource, rate in RATES[region].items())
    card = spark.sql(f"SELECT * FROM VALUES {listed} AS card(resource, rate)")
    used = unit_hours(per_minute).groupBy("resource").agg(F.sum("unit_hours").alias("unit_hours"))
    priced = card.join(used, "resource", "left").select(
        "resource", F.coalesce("unit_hours", F.lit(0.0)).alias("unit_hours"), "rate"
    )
    lines = priced.withColumn("cost", F.col("unit_hours") * F.col("rate"))
    total = lines.groupingSets([["resource"], []], "resource").agg(
        F.when(F.grouping("resource") == 0, F.sum("unit_hours")).alias("unit_hours"),
        F.when(F.grouping("resource") == 0, F.max("rate")).alias("rate"),
        F.sum("cost").alias("cost"),
    )
    return total.select(F.coalesce("resource", F.lit("TOTAL")).alias("resource"), "unit_hours", "rate", "cost")
