"""Derived classes that cohort reports group by."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from locusdeck.functions.predicates import mentions


def pathogenicity_class(column: str = "pathogenecity") -> Column:
    """`likely` is looked for first, so likely-benign lands in the likely class as well."""
    return (
        F.when(mentions(column, "likely"), "likely_pathogenic")
        .when(mentions(column, "pathogenic"), "pathogenic")
        .otherwise("other")
    )


def cohort_group(source: str = "data_source", impact: str = "vep_impact") -> Column:
    in_a = F.col(source) == "ICGC-ARGO"
    return (
        F.when(in_a & (F.col(impact) == "HIGH"), "cohort_A_high")
        .when(in_a, "cohort_A")
        .when(F.col(source).like("%TCGA%"), "cohort_B")
        .otherwise("full_cohort")
    )
