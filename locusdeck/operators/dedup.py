"""One row per locus.

Every form reduces inside the map tasks before rows are moved, so a locus that holds a large
part of all rows arrives as a few rows per task. Survivors are chosen by a total order: the
asked-for columns first, all other columns as tie-break, NULLs placed explicitly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusdeck.schemas import ANNOTATION_LOCUS


def _ordering(columns: Sequence[str], nulls: str) -> list[Column]:
    if nulls == "last":
        return [F.col(c).asc_nulls_last() for c in columns]
    if nulls == "first":
        return [F.col(c).asc_nulls_first() for c in columns]
    raise ValueError("nulls is 'first' or 'last'")


def by_rank(
    df: DataFrame,
    order: Sequence[str] = ("gene",),
    keys: Sequence[str] = ANNOTATION_LOCUS,
    nulls: str = "last",
    copies: bool = True,
) -> DataFrame:
    """First row per key by window rank.

    Copies of whole rows go first, by hash aggregation; ``copies=False`` says there are hardly
    any. Spark then limits each key to one row per map task before the exchange, because
    only rank 1 is asked for.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    window = Window.partitionBy(*keys).orderBy(*_ordering([*order, *rest], nulls))
    return (
        (df.distinct() if copies else df)
        .withColumn("_rank", F.row_number().over(window))
        .filter("_rank = 1")
        .drop("_rank")
    )


def by_minimum(
    df: DataFrame,
    order: Sequence[str] = ("gene",),
    keys: Sequence[str] = ANNOTATION_LOCUS,
    nulls: str = "last",
) -> DataFrame:
    """The same rows by a minimum over a struct: one exchange, at the price of a local sort."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    if nulls not in ("first", "last"):
        raise ValueError("nulls is 'first' or 'last'")
    fields: list[Column] = []
    for name in [*order, *rest]:
        # Structs compare field by field with NULLs first; a flag before the value moves them.
        if nulls == "last":
            fields.append(F.col(name).isNull().alias(f"_null_{name}"))
        fields.append(F.col(name).alias(name))
    least = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_least"))
    return least.select(*[c if c in keys else F.col(f"_least.{c}").alias(c) for c in df.columns])


def first_seen(
    df: DataFrame, order: Sequence[str], keys: Sequence[str] = ANNOTATION_LOCUS
) -> DataFrame:
    """The row that comes first in ``order`` (such as file path, line) for each key.

    Unlike ``dropDuplicates`` the survivor does not depend on task timing. The order columns
    are not part of the result.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    window = Window.partitionBy(*keys).orderBy(*_ordering([*order, *rest], "last"))
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .filter("_rank = 1")
        .drop("_rank", *order)
    )


def unseen(df: DataFrame, existing: DataFrame, keys: Sequence[str] = ANNOTATION_LOCUS) -> DataFrame:
    """Rows whose key is not stored yet."""
    return df.join(existing.select(*keys), list(keys), "left_anti").select(*df.columns)
