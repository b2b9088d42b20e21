"""Helpers of the corpus operators: cut lineage, bounded broadcasts, hot keys, text blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusdeck.session import shared_folder

#: A side of a join is broadcast when its rows, measured beforehand, take no more than this.
BROADCAST_BYTES = 64 * 1024 * 1024
#: Keys above the larger of this many rows and a HOT_SHARE-th of all rows are hot: HOT_SHARE at most.
HOT_LEAST, HOT_SHARE = 2_000, 5_000
#: Python code inside tasks looks at about this many characters at a time.
BLOCK = 1 << 20


def cut(df: DataFrame) -> DataFrame:
    """The same rows from the folder in spark.checkpoint.dir; computed once, without lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def fits(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> bool:
    """Whether rows of at most ``row_bytes`` each may be broadcast; counts them."""
    return df.count() * row_bytes <= limit


def bounded(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """With a broadcast hint if the rows are known to fit; Spark joins it by shuffle otherwise."""
    return F.broadcast(df) if fits(df, row_bytes, limit) else df


def attach(left: DataFrame, right: DataFrame, key: str, weight: str, least: int = HOT_LEAST) -> DataFrame:
    """Left outer join to ``right``, which has one row per ``key`` and its row count in ``weight``.

    Keys that hold a large part of the rows (HOT_SHARE of them at most) are broadcast. Rows they
    match, and rows without a key, take a key of their own in the shuffled join with the rest,
    so no task gets a hot key whole. Columns of ``right`` arrive as they are, without the weight.
    """
    values = [c for c in right.columns if c not in (key, weight)]
    total = right.agg(F.sum(weight)).first()[0] or 0
    bar = max(least, total // HOT_SHARE)
    packed = F.struct(*values)
    hot = F.broadcast(right.filter(F.col(weight) >= bar).select(F.col(key).alias("_hk"), packed.alias("_hot")))
    cold = right.filter(F.col(weight) < bar).select(
        F.col(key).alias("_ck"), F.lit(0).cast("bigint").alias("_cs"), packed.alias("_cold")
    )
    own = F.pmod(F.xxhash64(*left.columns), F.lit(1 << 40)) + 1
    first = left.join(hot, left[key] == F.col("_hk"), "left").withColumn(
        "_salt", F.when(F.col("_hk").isNotNull() | F.col(key).isNull(), own).otherwise(F.lit(0))
    )
    joined = first.join(cold, (F.col(key) == F.col("_ck")) & (F.col("_salt") == F.col("_cs")), "left")
    picked = F.coalesce(F.col("_hot"), F.col("_cold"))
    return joined.select(*left.columns, *[picked[v].alias(v) for v in values])


def remainder(column: str, by: int) -> Column:
    """crc32 of the value as text, modulo ``by``; NULL for NULL."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % by


def pieces(texts: Iterable[str], block: int = BLOCK) -> Iterator[list[tuple[int, str]]]:
    """(index, text) lists of about ``block`` characters together; longer texts are cut at spaces.

    A cut falls behind a space, or after ``block`` characters where there is none.
    """
    held: list[tuple[int, str]] = []
    size = 0
    for i, text in enumerate(texts):
        start = 0
        while True:
            end = len(text)
            if end - start > block:
                end = text.rfind(" ", start, start + block) + 1
                end = end if end > start else start + block
            held.append((i, text[start:end]))
            size += end - start
            if size >= block:
                yield held
                held, size = [], 0
            start = end
            if start >= len(text):
                break
    if held:
        yield held


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits, in order; none for NULL."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    # Only the first and the last part can be empty.
    first = lambda t: F.when(F.get(t, F.lit(0)) == "", 2).otherwise(1)
    last = lambda t: F.when(F.get(t, F.size(t) - 1) == "", 1).otherwise(0)
    return let(parts, lambda t: F.slice(t, first(t), F.greatest(F.lit(0), F.size(t) - last(t) - first(t) + 1)))


def indices(count: Column) -> Column:
    """0 to ``count`` - 1; nothing for 0 or less."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
