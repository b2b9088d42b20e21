"""What the named questions are asked of."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from locusdeck.schemas import TableSpec


@dataclass(frozen=True)
class Tables:
    """The tables of a cohort; a question needs those that it names only.

    ``annotations`` has one row per locus (``dedup.by_rank`` makes them so). The layouts are those of stored tables
    (``stored_layout``): look-ups then read only the folders that can hold their rows.
    """

    variants: DataFrame | None = None
    annotations: DataFrame | None = None
    expression: DataFrame | None = None
    variants_layout: TableSpec | None = None
    annotations_layout: TableSpec | None = None
