"""Path manifests: one JSON object with a ``path`` per line.

Lines are numbered without gathering the file: each split numbers its own lines, and only
the per-split line counts (one row per split) are added up across the file.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_SLICE = re.compile(r"(?P<path>.+):::(?P<first>\d+)-(?P<last>\d+)")


def split_range(name: str) -> tuple[str, tuple[int, int] | None]:
    """``file:::a-b`` as (file, (a, b)); a plain name has no range."""
    match = _SLICE.fullmatch(name)
    if match is None:
        return name, None
    return match["path"], (int(match["first"]), int(match["last"]))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines as (ordinal, value), counted from 0 in file order."""
    lines = (
        spark.read.text(path)
        .filter(F.trim("value") != "")
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line_id"),
            "value",
        )
    )
    per_block = lines.groupBy("file", "block").agg(
        F.count("*").alias("n"), F.min("line_id").alias("first_id")
    )
    # One row per file split: the running sum sees split counts, never lines.
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.select(
        "file", "block", "first_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    return lines.join(offsets, ["file", "block"]).select(
        (F.col("offset") + F.col("line_id") - F.col("first_id")).alias("ordinal"), "value"
    )


def read_manifest(spark: SparkSession, name: str) -> DataFrame:
    """(ordinal, path) of a manifest, or of the inclusive slice ``name:::a-b`` of it."""
    path, wanted = split_range(name)
    listed = numbered_lines(spark, path).select(
        "ordinal", F.from_json("value", "path string")["path"].alias("listed")
    )
    if wanted:
        listed = listed.filter(F.col("ordinal").between(*wanted))
    # Paths without a scheme are relative to where the driver runs.
    local = F.regexp_replace("listed", "^~", str(Path.home()))
    rooted = F.when(local.startswith("/"), local).otherwise(F.concat(F.lit(f"{Path.cwd()}/"), local))
    return listed.select(
        "ordinal",
        F.when(F.col("listed").contains("://"), F.col("listed")).otherwise(rooted).alias("path"),
    )
