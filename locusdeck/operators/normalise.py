"""Schema normalisation and projections between the tables."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Where each annotation column comes from, in the order of the annotation table.
ANNOTATION_SOURCES = {
    "chrom": "contig",
    "pos": "pos_start",
    "ref": "ref",
    "alt": "alt",
    "gene": "vep_gene",
    "symbol": "vep_symbol",
    "consequence": "vep_consequence",
    "impact": "vep_impact",
    "gnomad_af": "gnomad_af",
    "gnomad_af_popmax": "gnomad_af_popmax",
    "pathogenecity": "pathogenecity",
}


def to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns in declared order, cast to their declared types."""
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def annotations_of(variants: DataFrame, *keep: str) -> DataFrame:
    """The locus-level columns of variant rows, one output row per input row.

    ``keep`` names further columns to carry along, such as an order to pick survivors by.
    """
    renamed = [F.col(source).alias(name) for name, source in ANNOTATION_SOURCES.items()]
    return variants.select(*renamed, *keep)


def merged(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of per-file results, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)
