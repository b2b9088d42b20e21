"""The locus join and its distribution strategies.

``auto`` measures the filtered dimension with one aggregate over its own small columns. Within
a byte bound it is broadcast and the fact table is not shuffled at all. Beyond the bound both
sides are shuffled by locus, and adaptive execution splits the partitions of hot loci: no pass over the
fact rows comes before the join. ``salt`` asks for that pass, for sessions without adaptive execution
or joins whose output partitioning a later step relies on: loci that hold more than one task's share
of the fact rows are found and spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locusdeck.functions.layout_keys import key_column
from locusdeck.schemas import ANNOTATION_LOCUS, LOCUS, TableSpec

# Far less than an executor holds, far more than Spark broadcasts by itself: a fact table of
# many terabytes is worth not shuffling.
BROADCAST_BYTES = 256 * 1024 * 1024
# Per value, for the row format and the hash table around the payload.
VALUE_OVERHEAD = 16
# What the sketch can tell apart; more partitions than this do not make finer shares.
MOST_SHARE = 50_000

STRATEGIES = ("auto", "broadcast", "shuffle", "salt")


def _width(field: T.StructField) -> Column:
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)) + VALUE_OVERHEAD
    return F.lit(VALUE_OVERHEAD)


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of what a flat relation takes when it is broadcast; one aggregate job."""
    if any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) for f in df.schema.fields):
        raise ValueError("only flat relations are measured")
    row = sum((_width(f) for f in df.schema.fields), F.lit(0).cast("long"))
    return df.agg(F.sum(row)).first()[0] or 0


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= limit


def hot_keys(df: DataFrame, keys: Sequence[str], share: int) -> list[int]:
    """Hashes of keys that hold at least one ``share``-th of all rows.

    A frequent-items sketch finds them in one pass without a shuffle by key. There are at
    most ``share`` such keys, whatever the size of the data, and all of them are returned.
    """
    top = share = min(share, MOST_SHARE)
    sketch = df.select(F.xxhash64(*keys).alias("_key")).agg(
        F.expr(f"approx_top_k(_key, {top}, {20 * top})").alias("_top"), F.count("*").alias("_rows")
    )
    found = sketch.select(F.explode("_top").alias("_item"), "_rows").filter(
        F.col("_item.count") * share >= F.col("_rows")
    )
    return [row[0] for row in found.select("_item.item").collect()]


def salted_join(
    fact: DataFrame, dimension: DataFrame, keys: Sequence[str], share: int | None = None
) -> DataFrame:
    """Inner join on ``keys`` that spreads hot keys of the fact side over ``share`` tasks.

    Fact rows of a hot key get a salt from a hash of all other columns, so a retried task
    makes the same choice; the few dimension rows of hot keys are repeated once per salt.
    All other rows take salt 0. No row is lost or doubled for any choice of hot keys, as long
    as both sides use the same: they are found once and then stand in the plan as literals.
    """
    share = share or int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(fact.dropna(subset=list(keys)), keys, share)
    if not hot:
        return fact.join(dimension, list(keys))
    is_hot = F.xxhash64(*keys).isin(hot)
    spread = F.xxhash64(*([c for c in fact.columns if c not in keys] or keys))
    salt = F.when(is_hot, F.pmod(spread, F.lit(share).cast("long"))).otherwise(F.lit(0).cast("long"))
    last = F.when(is_hot, F.lit(share - 1).cast("long")).otherwise(F.lit(0).cast("long"))
    copies = F.explode(F.sequence(F.lit(0).cast("long"), last))
    return (
        fact.withColumn("_salt", salt)
        .join(dimension.withColumn("_salt", copies), [*keys, "_salt"])
        .drop("_salt")
    )


def join_dimension(
    fact: DataFrame,
    dimension: DataFrame,
    keys: Sequence[str],
    strategy: str = "auto",
    limit: int = BROADCAST_BYTES,
    fits: bool | None = None,
) -> DataFrame:
    """Inner join on equally named ``keys`` under one of STRATEGIES.

    ``broadcast`` asks for a broadcast but keeps the bound: a dimension beyond it is shuffled.
    ``fits`` is the outcome of ``fits_broadcast`` where the caller has asked already.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy is one of {STRATEGIES}")
    if strategy in ("auto", "broadcast"):
        if fits if fits is not None else fits_broadcast(dimension, limit):
            return fact.join(F.broadcast(dimension), list(keys))
    if strategy == "salt":
        return salted_join(fact, dimension, keys)
    return fact.join(dimension.hint("merge"), list(keys))


def locus_join(
    variants: DataFrame,
    annotations: DataFrame,
    strategy: str = "auto",
    limit: int = BROADCAST_BYTES,
    fits: bool | None = None,
    layout: TableSpec | None = None,
) -> DataFrame:
    """Variants with the annotation of their locus; ``annotations`` has one row per locus.

    Annotation columns arrive as ``a_<name>``, so equal names on both sides stay apart.
    Callers select the columns they need beforehand: the bound is on what is broadcast.

    ``layout`` is that of a stored variant table. Its position keys are then computed for the
    annotations too and joined on, so that Spark prunes folders by the loci that are left
    after the annotation filter: a gene reads its own stretch of the genome only.
    """
    as_locus = dict(zip(ANNOTATION_LOCUS, LOCUS))
    dimension = annotations.select(
        *[F.col(c).alias(as_locus.get(c, f"a_{c}")) for c in annotations.columns]
    )
    keys = list(LOCUS)
    for key in layout.partition_by if layout else ():
        if key.column in LOCUS:
            dimension = dimension.withColumn(key.name, key_column(key))
            keys.append(key.name)
    return join_dimension(variants, dimension, keys, strategy, limit, fits)


def joined_counts(
    left: DataFrame, right: DataFrame, keys: Sequence[str], value: str, name: str
) -> DataFrame:
    """Number of non-NULL ``value`` cells of ``left`` over all pairs of a many-to-many join.

    Both sides are counted per key first, so pairs are multiplied instead of produced.
    """
    a = left.groupBy(*keys).agg(F.count(value).alias("_values"))
    b = right.groupBy(*keys).agg(F.count("*").alias("_rows"))
    pairs = F.sum(F.col("_values") * F.col("_rows"))
    return a.join(b, list(keys)).agg(F.coalesce(pairs, F.lit(0)).cast("long").alias(name))
