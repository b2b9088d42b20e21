"""The named cohort questions.

Q answers them from the variant table alone, S from variants joined to the deduplicated
annotations, E for a whole chromosome, R with an explicit broadcast. Each is a function of a
cohort's tables. Row-returning questions show ``allele_depth`` as text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusdeck.functions.classes import cohort_group, pathogenicity_class
from locusdeck.functions.predicates import (
    NO_CALLS,
    f32,
    mentions,
    of_samples,
    on_contig,
    quality,
    rare,
    region,
    regions,
)
from locusdeck.operators.carriers import carriers, cohort_carriers, rows_by_annotation
from locusdeck.operators.joins import fits_broadcast, joined_counts, locus_join
from locusdeck.plans.tables import Tables
from locusdeck.schemas import VARIANTS, TableSpec

Question = Callable[[Tables], DataFrame]

# --- fixed values: what the questions ask for ---
ACTIONABLE = ("TP53", "BRCA1", "KMT2C")
SEVERE = ("HIGH", "MODERATE")
RARE_CLASSES = ("pathogenic", "uncertain_significance")
UNCERTAIN = "uncertain_significance,pathogenic"
PROTECTIVE_OR_OTHER = ("protective&likely_pathogenic", "other")
HOTSPOT_SOURCES = ("ICGC-ARGO", "TCGA-GDC")
# --- end of fixed values ---

HOTSPOT = ("chr1", 1, 100_000_000)


def shown(df: DataFrame) -> DataFrame:
    """Arrays as text, so that results compare and export as flat rows."""
    depth = F.array_join(F.col("allele_depth").cast("array<string>"), ",")
    return df.withColumn("allele_depth", depth)


def ranked(df: DataFrame, count: str, *keys: str) -> DataFrame:
    """Largest count first; keys make the order total."""
    return df.orderBy(F.col(count).desc_nulls_last(), *[F.col(k).asc_nulls_last() for k in keys])


def _dimension(t: Tables, where: Column | None, *columns: str) -> DataFrame:
    """Filtered annotations with the locus and the columns that are asked for."""
    found = t.annotations if where is None else t.annotations.filter(where)
    return found.select("chrom", "pos", "ref", "alt", *columns)


def _severe(impact: str, pathogenicity: str) -> Column:
    return (F.col(impact) == "HIGH") | mentions(pathogenicity, "pathogenic")


# --- variant table alone ---------------------------------------------------------------------


def q1(t: Tables) -> DataFrame:
    """Carriers per gene of rare pathogenic variants in a region (annotations joined)."""
    where = region(
        "chr6", 1, 200_000_000, half_open=True, columns=("chrom", "pos"), layout=t.annotations_layout
    )
    loci = t.annotations.filter(where & rare() & mentions("pathogenecity", "pathogenic")).select(
        "chrom", "pos", "ref", "alt", "symbol", F.lower("pathogenecity").alias("pathogenecity")
    )
    calls = t.variants.filter(
        quality() & region("chr6", 1, 200_000_000, half_open=True, layout=t.variants_layout)
    )
    return _carriers_by_gene(calls, loci, t.variants_layout)


def _carriers_by_gene(
    calls: DataFrame, loci: DataFrame, layout: TableSpec | None, strategy: str = "auto"
) -> DataFrame:
    joined = locus_join(calls, loci, strategy, layout=layout)
    groups = [F.col("a_symbol").alias("gene"), F.col("a_pathogenecity").alias("pathogenecity")]
    return ranked(carriers(joined, groups), "carrier_count", "gene", "pathogenecity")


def _rows(where: Callable[[TableSpec | None], Column]) -> Question:
    """Variant rows; ``where`` gets the layout that the table is stored by."""

    def question(t: Tables) -> DataFrame:
        return shown(t.variants.filter(where(t.variants_layout)).select(*VARIANTS.names))

    return question


def q9(t: Tables) -> DataFrame:
    found = t.variants.filter(
        F.col("PATHOGENECITY").isin(*PROTECTIVE_OR_OTHER) & (F.col("filters") == "PASS")
    )
    return found.select("sample_name").distinct()


def q11(t: Tables) -> DataFrame:
    per_sample = (
        t.variants
        .groupBy("sample_name")
        .agg(F.count("*").alias("variant_count"), F.avg("read_depth").alias("mean_depth"))
    )
    return ranked(per_sample, "variant_count", "sample_name")


def q12(t: Tables) -> DataFrame:
    counts = t.variants.groupBy("pathogenecity").agg(F.count("*").alias("n"))
    return counts.orderBy(F.col("pathogenecity").asc_nulls_last())


def q13(t: Tables) -> DataFrame:
    found = t.variants.filter(
        (F.col("pathogenecity") == UNCERTAIN)
        & F.col("vep_impact").isin(*SEVERE)
        & (F.col("vep_consequence") != "synonymous_variant")
        & (F.col("read_depth") >= 10)
        & ~F.col("genotype").isin(*NO_CALLS)
    )
    counts = found.groupBy("vep_symbol").agg(F.count("*").alias("vus_count"))
    return ranked(counts, "vus_count", "vep_symbol")


def _rare_class_calls() -> Column:
    return (
        (F.col("genotype") != "0/1")
        & (F.col("read_depth") >= 10)
        & ~F.col("filters").like("%LowQ%")
    )


def q15(t: Tables) -> DataFrame:
    found = t.variants.filter(
        rare() & mentions("pathogenecity", "pathogenic") & quality()
    )
    groups = [F.col("vep_symbol").alias("gene"), F.lower("pathogenecity").alias("pathogenicity")]
    return ranked(carriers(found, groups), "carrier_count", "gene", "pathogenicity")


def _cohorts(tcga: Column) -> dict[str, Column]:
    return {"icgc_carriers": F.col("data_source") == "ICGC-ARGO", "tcga_carriers": tcga}


def q16(t: Tables) -> DataFrame:
    found = t.variants.filter(
        rare()
        & _severe("vep_impact", "pathogenecity")
        & quality()
        & (F.col("data_type") == "real")
    )
    cohorts = _cohorts(F.col("data_source").like("%TCGA%"))
    per_gene = cohort_carriers(found, [F.col("vep_symbol").alias("gene")], cohorts)
    return ranked(per_gene, "icgc_carriers", "gene")


def _hotspot_calls() -> Column:
    return (
        (F.col("genotype") != "0/0")
        & (F.col("read_depth") >= 10)
        & (F.col("filters") == "PASS")
        & F.col("data_source").isin(*HOTSPOT_SOURCES)
    )


def q17(t: Tables) -> DataFrame:
    found = t.variants.filter(
        (region(*HOTSPOT) | (F.col("vep_symbol") == "TP53")) & _hotspot_calls() & rare()
    )
    groups = [F.col("vep_symbol").alias("gene"), "contig", "pos_start", "data_source"]
    return ranked(
        carriers(found, groups, rows="variant_rows"), "variant_rows", "gene", "contig", "pos_start", "data_source"
    )


def _matrix(found: DataFrame, gene: str, impact: str, pathogenicity: str) -> DataFrame:
    groups = [
        F.col(gene).alias("gene"),
        pathogenicity_class(pathogenicity).alias("pathogenicity_class"),
        cohort_group("data_source", impact).alias("cohort_group"),
    ]
    return carriers(found, groups, rows="variant_count").orderBy(
        "gene", "cohort_group", "pathogenicity_class"
    )


def q18(t: Tables) -> DataFrame:
    found = t.variants.filter(
        rare()
        & F.col("vep_symbol").isin(*ACTIONABLE)
        & _severe("vep_impact", "pathogenecity")
        & quality()
    )
    return _matrix(found, "vep_symbol", "vep_impact", "pathogenecity")


# --- variants joined to annotations ----------------------------------------------------------


def s1(t: Tables) -> DataFrame:
    loci = _dimension(t, F.col("symbol") == "WASH8P")
    calls = t.variants.filter(of_samples(["S2"], layout=t.variants_layout))
    return shown(locus_join(calls, loci, layout=t.variants_layout).select(*VARIANTS.names))


def s2(t: Tables) -> DataFrame:
    loci = _dimension(t, F.col("pathogenecity").isin(*PROTECTIVE_OR_OTHER))
    calls = t.variants.filter(F.col("filters") == "PASS")
    return locus_join(calls, loci).select("sample_name").distinct()


def s3(t: Tables) -> DataFrame:
    where = region("chr15", 1, 200_000_000, columns=("chrom", "pos"), layout=t.annotations_layout)
    loci = t.annotations.filter(where & (F.col("consequence") == "transcript_ablation")).select(
        "chrom", "pos", "ref", "alt"
    )
    calls = t.variants.filter(
        region("chr15", 1, 200_000_000, layout=t.variants_layout)
        & (F.col("read_depth") >= 20)
        & (F.col("variant_allele_frequency") >= f32(0.05))
    )
    return shown(locus_join(calls, loci, layout=t.variants_layout).select(*VARIANTS.names))


def s4(t: Tables) -> DataFrame:
    gene = F.col("gene_symbol") == "DNAH2"
    expressed = t.expression.filter(gene)
    calls = (
        t.variants
        .filter(F.col("data_source") == "ICGC-ARGO")
        .select(F.col("sample_name").alias("sample_id"), F.col("vep_symbol").alias("gene_symbol"))
        .filter(gene)
    )
    return joined_counts(expressed, calls, ["sample_id", "gene_symbol"], "expression", "n")


def s5(t: Tables) -> DataFrame:
    loci = _dimension(t, None, "pathogenecity")
    calls = t.variants
    counts = rows_by_annotation(calls, loci, "pathogenecity", "vus_count", count_first=True)
    return counts.orderBy(F.col("pathogenecity").asc_nulls_last())


def s6(t: Tables) -> DataFrame:
    where = (
        (F.col("pathogenecity") == UNCERTAIN)
        & F.col("impact").isin(*SEVERE)
        & (F.col("consequence") != "synonymous_variant")
    )
    calls = t.variants.filter(
        (F.col("read_depth") >= 10) & ~F.col("genotype").isin(*NO_CALLS)
    )
    loci = _dimension(t, where, "symbol")
    counts = rows_by_annotation(calls, loci, "symbol", "vus_count")
    return ranked(counts, "vus_count", "symbol")


def s7(t: Tables) -> DataFrame:
    where = (F.col("gnomad_af") < f32(0.01)) & F.col("pathogenecity").isin(*RARE_CLASSES)
    others = [
        "gene", "symbol", "consequence", "impact", "gnomad_af", "gnomad_af_popmax", "pathogenecity",
    ]
    loci = t.annotations.filter(where).select("chrom", "pos", "ref", "alt", *others)
    calls = t.variants.filter(_rare_class_calls())
    locus = {"a_chrom": "contig", "a_pos": "pos_start", "a_ref": "ref", "a_alt": "alt"}
    return shown(
        locus_join(calls, loci).select(
            *VARIANTS.names,
            *[F.col(c).alias(name) for name, c in locus.items()],
            *[f"a_{c}" for c in others],
        )
    )


def s8(t: Tables) -> DataFrame:
    where = rare() & mentions("pathogenecity", "pathogenic")
    loci = _dimension(
        t, where, "symbol", F.lower("pathogenecity").alias("pathogenicity")
    )
    joined = locus_join(t.variants.filter(quality()), loci)
    groups = [F.col("a_symbol").alias("gene"), F.col("a_pathogenicity").alias("pathogenicity")]
    return ranked(carriers(joined, groups), "carrier_count", "gene", "pathogenicity")


def s9(t: Tables) -> DataFrame:
    loci = _dimension(t, rare() & _severe("impact", "pathogenecity"), "symbol")
    joined = locus_join(t.variants.filter(quality()), loci)
    cohorts = _cohorts(F.col("data_source") == "TCGA-GDC")
    per_gene = cohort_carriers(joined, [F.col("a_symbol").alias("gene")], cohorts)
    return ranked(per_gene, "icgc_carriers", "gene")


def _hotspots(joined: DataFrame) -> DataFrame:
    groups = [F.col("a_symbol").alias("gene"), "contig", "pos_start", "data_source"]
    return ranked(
        carriers(joined, groups, rows="variant_rows"), "variant_rows", "gene", "contig", "pos_start", "data_source"
    )


def s10(t: Tables) -> DataFrame:
    """Region or gene, where the region is a variant column and the gene an annotation.

    The condition can only be tested after the join, so all rare loci take part. Where they
    are too many to broadcast, the two disjoint branches are joined by themselves.
    """
    loci = _dimension(t, rare(), "symbol")
    if not fits_broadcast(loci):
        return s10_union(t)
    joined = locus_join(t.variants.filter(_hotspot_calls()), loci, fits=True)
    return _hotspots(joined.filter(region(*HOTSPOT) | (F.col("a_symbol") == "TP53")))


def s10_union(t: Tables) -> DataFrame:
    """The same rows from two disjoint branches, each of which filters before its join."""
    in_region = region(*HOTSPOT, columns=("chrom", "pos"), layout=t.annotations_layout)
    columns = ["chrom", "pos", "ref", "alt", "symbol"]
    calls = t.variants.filter(_hotspot_calls())
    inside = locus_join(
        calls.filter(region(*HOTSPOT)), t.annotations.filter(in_region & rare()).select(*columns)
    )
    outside = locus_join(
        calls.filter(~region(*HOTSPOT)),
        t.annotations.filter((F.col("symbol") == "TP53") & rare()).select(*columns),
    )
    return _hotspots(inside.unionByName(outside))


def s11(t: Tables) -> DataFrame:
    where = rare() & F.col("symbol").isin(*ACTIONABLE) & _severe("impact", "pathogenecity")
    loci = _dimension(t, where, "symbol", "impact", "pathogenecity")
    joined = locus_join(t.variants.filter(quality()), loci)
    return _matrix(joined, "a_symbol", "a_impact", "a_pathogenecity")


def e1(t: Tables) -> DataFrame:
    """Q1 for a whole chromosome, with the small side broadcast as long as it is small."""
    on_six = on_contig("chr6", column="chrom", layout=t.annotations_layout)
    where = on_six & rare() & mentions("pathogenecity", "pathogenic")
    loci = _dimension(
        t, where, "symbol", F.lower("pathogenecity").alias("pathogenecity")
    )
    calls = t.variants.filter(quality() & on_contig("chr6", layout=t.variants_layout))
    return _carriers_by_gene(calls, loci, t.variants_layout, "broadcast")


def r1(t: Tables) -> DataFrame:
    """Low-impact missense calls per gene, with the annotations broadcast if they are small."""
    where = (F.col("impact") == "LOW") & F.col("consequence").like("%missense%")
    loci = _dimension(t, where, "symbol")
    calls = t.variants.filter(F.col("filters") == "PASS")
    counts = rows_by_annotation(calls, loci, "symbol", "num_non_silent")
    return counts.withColumnRenamed("symbol", "gene_symbol")


QUESTIONS: dict[str, Question] = {
    "Q1": q1,
    "Q2": _rows(lambda layout: region("chr7", 100_000_000, 200_000_000, layout=layout)),
    "Q3": _rows(lambda layout: of_samples(["S1"], layout=layout)),
    "Q4": _rows(
        lambda layout: regions([("chr7", 100_000_000, 200_000_000), ("chr12", 1, 150_000_000)], layout=layout)
        & of_samples(["S1", "S2"], layout=layout)
    ),
    "Q5": _rows(lambda layout: of_samples(["S1", "S2"], layout=layout) & (F.col("filters") == "PASS")),
    "Q6": _rows(lambda layout: region("chr7", 1, 150_000_000, layout=layout) & (F.col("filters") == "AC0")),
    "Q7": _rows(lambda layout: (F.col("vep_symbol") == "WASH8P") & of_samples(["S2"], layout=layout)),
    "Q8": _rows(
        lambda layout: (F.col("somalone_somatic_score") >= f32(0.99)) & region("chr12", 1, 150_000_000, layout=layout)
    ),
    "Q9": q9,
    "Q10": _rows(
        lambda layout: region("chr15", 1, 200_000_000, layout=layout)
        & (F.col("vep_consequence") == "transcript_ablation")
        & (F.col("read_depth") >= 20)
        & (F.col("variant_allele_frequency") >= f32(0.05))
    ),
    "Q11": q11,
    "Q12": q12,
    "Q13": q13,
    "Q14": _rows(
        lambda layout: (F.col("gnomad_af") < f32(0.01))
        & F.col("pathogenecity").isin(*RARE_CLASSES)
        & _rare_class_calls()
    ),
    "Q15": q15,
    "Q16": q16,
    "Q17": q17,
    "Q18": q18,
    "S1": s1,
    "S2": s2,
    "S3": s3,
    "S4": s4,
    "S5": s5,
    "S6": s6,
    "S7": s7,
    "S8": s8,
    "S9": s9,
    "S10": s10,
    "S10_union": s10_union,
    "S11": s11,
    "E1": e1,
    "R1": r1,
}

#: Questions about one region, contig or sample: on stored variants they read a part of the folders.
LOOKUPS = ("Q1", "Q2", "Q3", "Q4", "Q5", "Q6", "Q7", "Q8", "Q10", "S1", "S3", "E1")
