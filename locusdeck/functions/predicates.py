"""Row predicates of cohort queries.

Thresholds on ``float`` columns are compared as ``float``: a stored 0.01 must not count as
smaller than the literal 0.01, which it would once both sides are widened to double.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from locusdeck.functions.layout_keys import bucket_of
from locusdeck.schemas import Bucket, Identity, TableSpec, Truncate

# --- fixed values ---
RARE_BELOW = 0.01
MIN_DEPTH = 10
LOW_QUALITY = "%LowQ%"
REFERENCE_GENOTYPE = "0/0"
NO_CALLS = ("./.", ".|.")
# --- end of fixed values ---


def f32(value: float) -> Column:
    return F.lit(value).cast("float")


def rare(column: str = "gnomad_af", below: float = RARE_BELOW) -> Column:
    """Population frequency below the threshold, or never observed."""
    return (F.col(column) < f32(below)) | F.col(column).isNull()


def quality(min_depth: int = MIN_DEPTH) -> Column:
    """A carrier call of enough depth that is not flagged; NULL filters do not pass."""
    return (
        (F.col("genotype") != REFERENCE_GENOTYPE)
        & (F.col("read_depth") >= min_depth)
        & ~F.col("filters").like(LOW_QUALITY)
    )


def mentions(column: str, word: str) -> Column:
    """Case-blind substring test."""
    return F.lower(F.col(column)).like(f"%{word}%")


def on_contig(contig: str, *, column: str = "contig", layout: TableSpec | None = None) -> Column:
    """Rows of one contig; on a stored table only its folders are read."""
    found = F.col(column) == contig
    key = layout.key(Identity, column) if layout else None
    return found & (F.col(key.name) == contig) if key else found


def region(
    contig: str,
    low: int,
    high: int,
    *,
    half_open: bool = False,
    columns: tuple[str, str] = ("contig", "pos_start"),
    layout: TableSpec | None = None,
) -> Column:
    """Rows of one genomic interval.

    With ``layout`` the partition keys of a stored table are bounded too, so that only the
    folders that can hold the interval are read.
    """
    name, position = columns
    at = F.col(position)
    upper = at < high if half_open else at <= high
    found = on_contig(contig, column=name, layout=layout) & (at >= low) & upper
    if layout is None:
        return found
    by_position = layout.key(Truncate, position)
    if by_position:
        last = high - 1 if half_open else high
        width = by_position.width
        found = found & F.col(by_position.name).between(low - low % width, last - last % width)
    return found


def region_keys(
    contig: str, low: int, high: int, layout: TableSpec, columns: tuple[str, str] = ("contig", "pos_start")
) -> list[tuple] | None:
    """The values of a stored table's leading partition keys that rows of an interval can have.

    None for a table whose leading keys are not a contig and then maybe a position. An upper bound that
    is exclusive costs one more value at most.
    """
    name, position = columns
    first, *rest = layout.partition_by
    if not (isinstance(first, Identity) and first.column == name):
        return None
    if rest and isinstance(rest[0], Truncate) and rest[0].column == position:
        width = rest[0].width
        return [(contig, at) for at in range(low - low % width, high + 1, width)]
    return [(contig,)]


def regions(intervals: Iterable[tuple[str, int, int]], **how) -> Column:
    return reduce(lambda a, b: a | b, [region(c, lo, hi, **how) for c, lo, hi in intervals])


def any_of(columns: Sequence[str], values: Iterable[tuple]) -> Column:
    """Rows whose columns have one of the value tuples; gathered by the values before the last."""
    groups: dict[tuple, list] = {}
    for value in values:
        groups.setdefault(tuple(value[:-1]), []).append(value[-1])
    *front, last = columns

    def one(head: tuple, tails: list) -> Column:
        found = F.col(last).isin([t for t in tails if t is not None])
        found = (found | F.col(last).isNull()) if None in tails else found
        return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(front, head)] + [found])

    return reduce(lambda a, b: a | b, [one(head, tails) for head, tails in groups.items()], F.lit(False))


def of_samples(
    samples: Iterable[str], column: str = "sample_name", layout: TableSpec | None = None
) -> Column:
    """Rows of some samples; on a stored table only their buckets are read."""
    wanted = list(samples)
    found = F.col(column).isin(wanted)
    key = layout.key(Bucket, column) if layout else None
    if key:
        found = found & F.col(key.name).isin([bucket_of(s, key.count) for s in wanted])
    return found

