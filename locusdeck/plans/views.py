"""Variant-cohort tables derived from the given star-schema tables.

A variant row is a line item, a locus is a part, a sample is a supplier, a copy-number
segment is an order, a usage data point is an event. The views are lazy, so filters and
column selections of a query reach the scans underneath.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from locusdeck.operators import dedup
from locusdeck.operators.layout import write_table
from locusdeck.operators.normalise import ANNOTATION_SOURCES
from locusdeck.schemas import ANNOTATIONS_DEDUP_TABLE, CNV, TPM, VARIANTS, TableSpec
from locusdeck.session import once
from locusdeck.sources.tables import read_table, stored_layout

# --- fixed values of the derivation ---
NAMED_GENES = {
    "Brand#1": "TP53",
    "Brand#2": "BRCA1",
    "Brand#3": "KMT2C",
    "Brand#4": "WASH8P",
    "Brand#5": "DNAH2",
}
# --- end of fixed values ---

# Rough Parquet bytes of an annotation row.
ANNOTATION_BYTES = 30
# The derived tables are small; their stored forms keep so many parts per key all the same.
LEAST_PARTS = 4


_schemas: dict[tuple[str, str], StructType] = {}


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table; its schema is read from the files once per application."""
    path = f"{sf_dir}/{table}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _schemas:
        _schemas[key] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[key]).parquet(path)


def _choice(value: Column, options: dict, otherwise) -> Column:
    result = None
    for key, text in options.items():
        pick = F.lit(text).cast("string") if text is None else F.lit(text)
        result = F.when(value == key, pick) if result is None else result.when(value == key, pick)
    return result.otherwise(otherwise)


def _gene_symbol(brand: Column) -> Column:
    return _choice(brand, NAMED_GENES, F.concat(F.lit("GENE_"), F.substring(brand, 7, 100)))


def _variant_columns(spark: SparkSession) -> dict[str, Column]:
    return _columns_of(spark.sparkContext.applicationId)


@lru_cache(maxsize=1)
def _columns_of(application: str) -> dict[str, Column]:
    """Built once per application: some hundred calls into the JVM."""
    part, order, number = F.col("p_partkey"), F.col("l_orderkey"), F.col("l_linenumber")
    text = lambda c: c.cast("string")
    base = lambda shift, scale: F.substring(
        F.lit("ACGT"), ((part * scale + shift) % 4 + 1).cast("int"), F.lit(1)
    )
    position = ((part * 7919) % 240 * 1_000_000 + part).cast("int")
    size = F.col("p_size").cast("double")
    unknown = part % 9 == 0
    return {
        "sample_name": F.concat(F.lit("S"), text(F.col("l_suppkey"))),
        "contig": F.concat(F.lit("chr"), text(part % 22 + 1)),
        "pos_start": position,
        "pos_end": position,
        "ref": base(0, 1),
        "alt": base(1, 3),
        "qual": F.col("l_extendedprice"),
        "filters": _choice(order % 7, {0: "LowQ", 1: "LowQ;AC0", 2: None, 3: "AC0"}, "PASS"),
        "genotype": _choice(
            (order + number) % 6, {0: "0/0", 1: "0/1", 2: "1/1", 3: "./.", 4: ".|."}, "0|1"
        ),
        "read_depth": F.when(number != 7, F.col("l_quantity").cast("int")),
        "allele_depth": F.array(F.col("l_quantity").cast("int"), number.cast("int")),
        "genotype_quality": (number * 14).cast("int"),
        "variant_allele_frequency": F.col("l_discount").cast("float"),
        "somalone_somatic_score": (1 - F.col("l_tax")).cast("float"),
        "vep_gene": F.when(
            number % 3 != 0,
            F.concat(F.lit("ENSG"), text(part % 50), F.lit("."), text(number % 3)),
        ),
        "vep_symbol": _gene_symbol(F.col("p_brand")),
        "vep_consequence": _choice(
            part % 5,
            {
                0: "transcript_ablation",
                1: "synonymous_variant",
                2: "missense_variant",
                3: "missense_variant&splice_region_variant",
            },
            "intron_variant",
        ),
        "vep_impact": _choice(F.col("p_size") % 4, {0: "HIGH", 1: "MODERATE", 2: "LOW"}, "MODIFIER"),
        "gnomad_af": F.when(~unknown, (size / 1000).cast("float")),
        "gnomad_af_popmax": F.when(~unknown, (size / 500).cast("float")),
        "pathogenecity": _choice(
            part % 8,
            {
                0: None,
                1: "pathogenic",
                2: "Likely_Pathogenic",
                3: "uncertain_significance",
                4: "uncertain_significance,pathogenic",
                5: "protective&likely_pathogenic",
                6: "other",
            },
            "benign",
        ),
        "data_source": _choice(
            F.col("l_returnflag"), {"A": "ICGC-ARGO", "N": "TCGA-GDC"}, "TCGA-legacy"
        ),
        "somalone_predicted_origin": F.when(number % 2 == 0, "somatic").otherwise("germline"),
        "data_type": F.when(F.col("l_linestatus") == "O", "real").otherwise("synthetic"),
    }


def variants(
    spark: SparkSession, sf_dir: str, *keep: str, where: Column | None = None
) -> DataFrame:
    """All variant rows; ``keep`` carries source columns along, ``where`` filters line items."""
    items = source(spark, sf_dir, "lineitem")
    if where is not None:
        items = items.filter(where)
    parts = source(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    columns = _variant_columns(spark)
    chosen = [columns[name].alias(name) for name in VARIANTS.names]
    return items.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(*chosen, *keep)


def annotations(spark: SparkSession, sf_dir: str, *keep: str, where: Column | None = None) -> DataFrame:
    """Locus annotations as they come with the variant rows, copies included."""
    rows = variants(spark, sf_dir, *keep, where=where)
    return rows.select(*[F.col(s).alias(n) for n, s in ANNOTATION_SOURCES.items()], *keep)


def distinct_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows without the copies that other samples bring.

    An annotation depends on the part and the line number only, so the copies are merged on
    those two columns before the join.
    """
    items = source(spark, sf_dir, "lineitem").select("l_partkey", "l_linenumber").distinct()
    parts = source(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    columns = _variant_columns(spark)
    return items.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        *[columns[s].alias(n) for n, s in ANNOTATION_SOURCES.items()]
    )


def stored_annotations(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, TableSpec]:
    """The deduplicated annotations as a stored table, and its layout.

    Queries join to a table that the dedup job has written from all annotation rows, so it is written once per
    application and input, in the shared folder, and read by every later query.
    """

    def make(path: str) -> str:
        write_table(dedup.by_rank(annotations(spark, sf_dir)), dedup_layout(spark, sf_dir), path)
        return path

    path = once(spark, sf_dir, "annotations_dedup", make)
    spec = stored_layout(spark, path, ANNOTATIONS_DEDUP_TABLE)
    return read_table(spark, path, spec), spec


def dedup_layout(spark: SparkSession, sf_dir: str) -> TableSpec:
    """The layout of a new table of deduplicated annotations."""
    loci = source(spark, sf_dir, "part").count()
    return ANNOTATIONS_DEDUP_TABLE.fitted(loci * ANNOTATION_BYTES, least=LEAST_PARTS)


def tpm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sample and gene that occur together in the variants."""
    items = source(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    parts = source(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("brand"))
    together = items.join(parts, F.col("l_partkey") == F.col("p_partkey")).select("l_suppkey", "brand").distinct()
    pairs = together.join(source(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    number = F.substring("brand", 7, 100)
    columns = {
        "sample_id": F.concat(F.lit("S"), F.col("s_suppkey").cast("string")),
        "gene_id": F.concat(F.lit("ENSG"), number),
        "gene_symbol": _gene_symbol(F.col("brand")),
        "expression": F.when(F.col("s_suppkey") % 11 != 0, F.abs("s_acctbal").cast("float")),
        "tissue": F.concat(F.lit("tissue_"), (F.col("s_nationkey") % 5).cast("string")),
        "dataset": F.lit("ds"),
        "dataset_version": F.lit("v1"),
        "genome_build": F.lit("GRCh38"),
        "annotation": F.lit("gencode"),
        "quant_method": F.lit("salmon"),
        "unit": F.lit("TPM"),
    }
    return pairs.select(*[columns[name].alias(name) for name in TPM.names])


def cnv(spark: SparkSession, sf_dir: str) -> DataFrame:
    order, customer, price = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    start = (order * 7919) % 240 * 1_000_000
    text = lambda c: c.cast("string")
    columns = {
        "importjobid": F.concat(F.lit("job"), text(customer % 10)),
        "sampleid": F.concat(F.lit("S"), text(customer % 100)),
        "technology": F.lit("WGS"),
        "pipeline": F.lit("cnvkit"),
        "pipeline_version": F.lit("1.0"),
        "out_path": F.concat(F.lit("/out/"), text(order)),
        "record_type": F.when(order % 2 == 0, "segment").otherwise("gene"),
        "contigname": F.concat(F.lit("chr"), text(order % 22 + 1)),
        "start": start.cast("int"),
        "end": (start + 50_000 + customer).cast("int"),
        "gene": F.concat(F.lit("GENE_"), text(order % 25)),
        "log2": (price / 500_000 - 1).cast("float"),
        "baf": F.when(order % 13 != 0, (price / 1_000_000).cast("float")),
        "cn": (order % 5).cast("float"),
        "copy": (order % 5).cast("int"),
        "call": _choice(F.col("o_orderstatus"), {"F": "gain", "O": "loss"}, "neutral"),
    }
    return source(spark, sf_dir, "orders").select(*[columns[n].alias(n) for n in CNV.names])


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, event = F.col("user_id"), F.col("event_id")
    return source(spark, sf_dir, "events").select(
        "ts",
        _choice(user % 3, {0: "vcpu", 1: "mem"}, "storage").alias("resource"),
        _choice(event % 3, {0: "Spark_Driver", 1: "Spark_Executor"}, "Spark_Kernel").alias("worker_type"),
        F.when(event % 2 == 0, "OnDemandCapacity").otherwise("PreInitCapacity").alias("capacity_type"),
        "value",
    )

