"""Operators one by one, over the same derived tables as the named questions."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusdeck.functions.layout_keys import bucketed, truncated, with_layout_keys
from locusdeck.functions.predicates import of_samples, quality, rare, region
from locusdeck.operators import dedup, usage
from locusdeck.operators.carriers import cohort_carriers
from locusdeck.operators.joins import locus_join
from locusdeck.operators.layout import (
    create_table, create_table_as, file_sizes, insert_into, ranged, sort_violations, write_table,
)
from locusdeck.operators.normalise import annotations_of, merged, to_schema
from locusdeck.plans import render, views
from locusdeck.plans.catalogue import LOOKUPS, QUESTIONS, Question, shown
from locusdeck.schemas import (
    CNV_TABLE,
    LOCUS,
    TABLES,
    TPM_TABLE,
    VARIANTS,
    VARIANTS_BY_SAMPLE_TABLE,
    VARIANTS_TABLE,
    TableSpec,
)
from locusdeck.session import new_folder, once
from locusdeck.sources.archives import read_archives
from locusdeck.sources.expression import read_tpm
from locusdeck.sources.manifest import read_manifest
from locusdeck.sources.tables import catalog_table, kept_layout, read_table, stored_layout
from locusdeck.sources.vcf import parse_cnv, parse_variants, read_variants
from locusdeck.streaming.ingest import batch_totals as totals
from locusdeck.streaming.ingest import ingest_folder, read_batches, read_region

Query = Callable[[SparkSession, str], DataFrame]

# Rough Parquet bytes per row, to choose how fine a layout a table can fill.
ROW_BYTES = {
    "variants": 60, "variants_by_sample": 60, "annotations": views.ANNOTATION_BYTES, "tpm": 20, "cnv": 40
}

WINDOW = (datetime(2024, 1, 5), datetime(2024, 1, 10))
# Floating-point sums depend on the order of addition; the queries report them to this precision.
DIGITS = 6


def _fitted(spark: SparkSession, sf_dir: str, spec: TableSpec, table: str, least: int = 1) -> TableSpec:
    rows = views.source(spark, sf_dir, table).count()
    return spec.fitted(rows * ROW_BYTES[spec.name], least=least)


def stored_variants(
    spark: SparkSession, sf_dir: str, declared: TableSpec = VARIANTS_TABLE
) -> tuple[DataFrame, TableSpec]:
    """Variants written in a layout, once per application and input, and the layout they are stored by."""

    def make(path: str) -> str:
        spec = _fitted(spark, sf_dir, declared, "lineitem", views.LEAST_PARTS)
        write_table(views.variants(spark, sf_dir), spec, path)
        return path

    path = once(spark, sf_dir, declared.name, make)
    spec = stored_layout(spark, path, declared)
    return read_table(spark, path, spec), spec


class _Derived:
    """``Tables`` of the derived views, each made when a question asks for it; ``stored``: variants as stored."""

    def __init__(self, spark: SparkSession, sf_dir: str, stored: bool):
        self._source, self._stored = (spark, sf_dir), stored

    @cached_property
    def _variants(self) -> tuple[DataFrame, TableSpec | None]:
        return stored_variants(*self._source) if self._stored else (views.variants(*self._source), None)

    @cached_property
    def _annotations(self) -> tuple[DataFrame, TableSpec]:
        return views.stored_annotations(*self._source)

    variants = property(lambda self: self._variants[0])
    variants_layout = property(lambda self: self._variants[1])
    annotations = property(lambda self: self._annotations[0])
    annotations_layout = property(lambda self: self._annotations[1])
    expression = property(lambda self: views.tpm(*self._source))


def _asked(question: Question, stored: bool) -> Query:
    return lambda spark, sf_dir: question(_Derived(spark, sf_dir, stored))


NAMED: dict[str, Query] = {name: _asked(question, name in LOOKUPS) for name, question in QUESTIONS.items()}


# --- scans, projections, predicates ----------------------------------------------------------


def scan_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(views.variants(spark, sf_dir))


def normalise_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns in another order, cast back to the declared schema."""
    variants = views.variants(spark, sf_dir)
    texts = [
        F.col(f.name) if f.name == "allele_depth" else F.col(f.name).cast("string")
        for f in reversed(VARIANTS.fields)
    ]
    return shown(to_schema(variants.select(*texts), VARIANTS))


def extract_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotations_of(views.variants(spark, sf_dir))


def merge_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("l_linestatus")
    # Two lots of rows and whatever is in neither.
    lots = [status == "O", status == "F", ~F.coalesce(status.isin("O", "F"), F.lit(False))]
    return shown(merged([views.variants(spark, sf_dir, where=lot) for lot in lots]))


def rare_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(views.variants(spark, sf_dir).filter(rare()))


def quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(views.variants(spark, sf_dir).filter(quality()))


# --- sources ---------------------------------------------------------------------------------


def _manifest(spark: SparkSession, sf_dir: str) -> str:
    """A manifest file with one line per sample, blank lines among them."""

    def make(path: str) -> str:
        render.as_manifest(views.source(spark, sf_dir, "supplier")).write.text(path)
        return path

    return once(spark, sf_dir, "manifest", make)


def manifest_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines 2 to 7, blank lines not counted."""
    return read_manifest(spark, f"{_manifest(spark, sf_dir)}:::2-7").orderBy("path")


def manifest_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines with their number."""
    return read_manifest(spark, _manifest(spark, sf_dir))


def archive_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data lines of all VCF members of zip and tar archives that hold the variant lines."""

    def make(path: str) -> str:
        records = render.variant_records(views.variants(spark, sf_dir))
        # Cut lines into several tasks, as many as the lines ask for, so that there are archives of several tasks.
        tasks = max(4, views.source(spark, sf_dir, "lineitem").count() // render.ROWS_PER_PACKER)
        render.write_archives(render.as_archives(records.repartition(tasks, "value")), path)
        return path

    lines = read_archives(spark, once(spark, sf_dir, "archives", make))
    data = lines.filter(~F.col("value").startswith("#"))
    return data.select(F.split("value", "\t").alias("c")).select(
        F.get("c", F.lit(0)).alias("contig"),
        F.get("c", F.lit(1)).cast("int").alias("pos_start"),
        F.get("c", F.lit(3)).alias("ref"),
        F.get("c", F.lit(4)).alias("alt"),
        F.split(F.get("c", F.lit(9)), ":")[0].alias("genotype"),
    )


def _lines(spark: SparkSession, sf_dir: str, name: str, lines: Callable[[], DataFrame]) -> DataFrame:
    """VCF text lines as a table in the shared folder, as a reader would find them."""

    def make(path: str) -> str:
        # Small row groups let several tasks share a file when there are few files.
        lines().write.option("parquet.block.size", 16 * 1024 * 1024).parquet(path)
        return path

    path = once(spark, sf_dir, name, make)
    return spark.read.schema("file_path string, value string").parquet(path)


def vcf_parse_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VCF lines of all samples; every other file names its sample by its file name only."""

    def lines() -> DataFrame:
        named = F.substring("sample", 2, 30).cast("long") % 2 == 0
        return render.as_lines(render.variant_records(views.variants(spark, sf_dir)), named)

    return shown(parse_variants(_lines(spark, sf_dir, "variant-lines", lines)))


def vcf_read_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compressed VCF files, one or more per sample, in one pass over their text."""
    return shown(read_variants(spark, _vcf_files(spark, sf_dir, "variant")))


def vcf_parse_cnv(spark: SparkSession, sf_dir: str) -> DataFrame:
    def lines() -> DataFrame:
        return render.as_lines(render.cnv_records(views.cnv(spark, sf_dir)))

    return parse_cnv(_lines(spark, sf_dir, "cnv-lines", lines))


def _tpm_files(spark: SparkSession, sf_dir: str) -> str:
    def make(path: str) -> str:
        texts = render.as_csv(views.tpm(spark, sf_dir)).write
        texts.option("header", "true").option("compression", "gzip").csv(path)
        return path

    return once(spark, sf_dir, "tpm-csv", make)


def tpm_csv_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_tpm(spark, _tpm_files(spark, sf_dir))


# --- joins -----------------------------------------------------------------------------------


def _joined(spark: SparkSession, sf_dir: str, strategy: str) -> DataFrame:
    stored, _ = views.stored_annotations(spark, sf_dir)
    loci = stored.select("chrom", "pos", "ref", "alt", "gene", "impact")
    return locus_join(views.variants(spark, sf_dir), loci, strategy).select(
        "sample_name", "contig", "pos_start", "ref", "alt", "genotype", "a_gene", "a_impact"
    )


def locus_join_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored variants of one gene, found through the annotations of its loci."""
    variants, layout = stored_variants(spark, sf_dir)
    stored, _ = views.stored_annotations(spark, sf_dir)
    loci = stored.filter(F.col("symbol") == "WASH8P").select("chrom", "pos", "ref", "alt", "impact")
    joined = locus_join(variants, loci, layout=layout)
    return joined.select("sample_name", *LOCUS, "genotype", "a_impact")


def cohort_carriers_two_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carriers per gene in three cohorts, over all variant rows."""
    cohorts = {
        "icgc_carriers": F.col("data_source") == "ICGC-ARGO",
        "tcga_carriers": F.col("data_source").like("%TCGA%"),
        "real_carriers": F.col("data_type") == "real",
    }
    gene = F.col("vep_symbol").alias("gene")
    return cohort_carriers(views.variants(spark, sf_dir), [gene], cohorts)


# --- dedup -----------------------------------------------------------------------------------


def dedup_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.by_rank(views.annotations(spark, sf_dir))


def dedup_rank_nulls_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.by_rank(views.annotations(spark, sf_dir), nulls="first")


def dedup_minby(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.by_minimum(views.annotations(spark, sf_dir))


def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first annotation of a locus by sample, then order and line number."""
    keep = ("sample_name", "l_orderkey", "l_linenumber")
    return dedup.first_seen(annotations_of(views.variants(spark, sf_dir, *keep[1:]), *keep), keep)


def dedup_rank_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create the deduplicated table in the catalog, insert into it, read it back."""
    spec = views.dedup_layout(spark, sf_dir)
    path = new_folder(spark, "annotations_dedup")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    create_table(spark, spec, name, location=path)
    insert_into(dedup.by_rank(views.annotations(spark, sf_dir)), spec, name)
    return catalog_table(spark, name, spec)


def annotations_new_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loci of a second lot of calls that the first, smaller lot has not brought."""
    first = F.col("l_quantity") >= 46
    existing = dedup.by_rank(views.annotations(spark, sf_dir, where=first))
    incoming = dedup.by_rank(views.annotations(spark, sf_dir, where=~first))
    return dedup.unseen(incoming, existing)


# --- layout ----------------------------------------------------------------------------------


def layout_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identity and truncation keys at the widths of the two variant layouts."""
    variants = views.variants(spark, sf_dir)
    return variants.select(
        "sample_name",
        "contig",
        "pos_start",
        F.col("contig").alias("contig_part"),
        truncated("pos_start", 5_000_000).alias("pos_trunc"),
        truncated("pos_start", 50_000_000).alias("pos_trunc_by_sample"),
        truncated(-F.col("pos_start"), 5_000_000).alias("pos_trunc_negative"),
    )


def layout_bucket_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples and rows of all hash buckets together, at the declared bucket counts."""
    per_sample = views.variants(spark, sf_dir).groupBy("sample_name").agg(F.count("*").alias("n"))
    counts = F.explode(F.array(*[F.lit(n) for n in (16, 64, 128, 4096)])).alias("buckets")
    by_bucket = per_sample.select("sample_name", "n", counts)
    bucket = F.pmod(F.hash("sample_name"), F.col("buckets")).alias("bucket")
    sizes = by_bucket.groupBy("buckets", bucket).agg(
        F.count("*").alias("samples"), F.sum("n").alias("variant_rows")
    )
    inside = F.min(F.col("bucket").between(0, F.col("buckets") - 1).cast("int"))
    return sizes.groupBy("buckets").agg(
        F.sum("samples").alias("samples"), F.sum("variant_rows").alias("variant_rows"), inside.alias("in_range")
    )


def layout_bucket_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sample lies in one bucket: what the buckets hold together."""
    keyed = with_layout_keys(views.variants(spark, sf_dir), VARIANTS_TABLE)
    per_sample = keyed.groupBy("sample_name").agg(
        F.countDistinct("sample_bucket").alias("buckets"), F.count("*").alias("variant_rows")
    )
    inside = F.max((bucketed("sample_name", 16).between(0, 15)).cast("int"))
    return per_sample.groupBy("buckets").agg(
        F.count("*").alias("samples"), F.sum("variant_rows").alias("variant_rows"), inside.alias("in_range")
    )


def write_read_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, _ = stored_variants(spark, sf_dir)
    return shown(stored.select(*VARIANTS.names))


def _write_read(view, spec: TableSpec, table: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        fitted = _fitted(spark, sf_dir, spec, table, views.LEAST_PARTS)
        path = new_folder(spark, spec.name)
        write_table(to_schema(view(spark, sf_dir), spec.schema), fitted, path)
        return read_table(spark, path, fitted).select(*spec.schema.names)

    return query


def layout_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a region or of two samples in a table that has grown by a far larger lot.

    The layout is fitted to the first lot and kept with the table; the second lot is written in it.
    """
    path = new_folder(spark, "grown")
    first = F.coalesce(F.col("l_quantity") >= 46, F.lit(False))
    for lot in (first, ~first):
        rows = views.variants(spark, sf_dir, where=lot)
        layout = kept_layout(spark, path, VARIANTS_TABLE) or VARIANTS_TABLE.fitted(
            rows.count() * ROW_BYTES["variants"], least=views.LEAST_PARTS
        )
        write_table(rows, layout, path)
    layout = stored_layout(spark, path, VARIANTS_TABLE)
    where = region("chr7", 100_000_000, 200_000_000, layout=layout) | of_samples(["S1", "S2"], layout=layout)
    return shown(read_table(spark, path, layout).filter(where).select(*VARIANTS.names))


def region_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, layout = stored_variants(spark, sf_dir)
    found = stored.filter(region("chr7", 100_000_000, 200_000_000, layout=layout))
    return shown(found.select(*VARIANTS.names))


def region_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows from an ingested table; only the folders of the region are looked up, in every batch."""
    _, targets = _fanned_out(spark, sf_dir)
    layout = stored_layout(spark, targets["variants"], VARIANTS_TABLE)
    found = read_region(spark, targets["variants"], layout, "chr7", 100_000_000, 200_000_000)
    return shown(found.select(*VARIANTS.names))


def layout_file_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per contig of the stored table, and its files that are larger than declared; none is expected."""
    stored, layout = stored_variants(spark, sf_dir)
    found = file_sizes(stored, layout).groupBy(F.col("contig_part").alias("contig"))
    return found.agg(F.sum("rows").alias("n"), F.sum("oversized").alias("oversized"))


def create_as_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants of a catalog table that was created from them in one step."""

    def make(path: str) -> str:
        name = path.rsplit("/", 1)[-1].replace("-", "_")
        spec = _fitted(spark, sf_dir, VARIANTS_TABLE, "lineitem", views.LEAST_PARTS)
        create_table_as(views.variants(spark, sf_dir), spec, name, location=path)
        return name

    return shown(catalog_table(spark, once(spark, sf_dir, "created", make), VARIANTS_TABLE))


def sample_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, layout = stored_variants(spark, sf_dir)
    return shown(stored.filter(of_samples(["S1", "S2"], layout=layout)).select(*VARIANTS.names))


def write_read_by_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, spec = stored_variants(spark, sf_dir, VARIANTS_BY_SAMPLE_TABLE)
    return shown(stored.select(*spec.schema.names))


def by_sample_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of one sample in a region, from the layout that is made for samples."""
    stored, layout = stored_variants(spark, sf_dir, VARIANTS_BY_SAMPLE_TABLE)
    where = of_samples(["S1"], layout=layout) & region("chr12", 1, 150_000_000, layout=layout)
    return shown(stored.filter(where).select(*layout.schema.names))


def batch_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variant rows in locus order across all tasks."""
    rows = views.variants(spark, sf_dir).select(*LOCUS, "sample_name", "genotype")
    return ranged(rows, list(LOCUS))


def sorted_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the stored table and neighbours that are out of order; none is expected."""
    stored, layout = stored_variants(spark, sf_dir)
    checked = sort_violations(stored, layout)
    return checked.agg(
        F.sum("n").cast("long").alias("checked_rows"), F.sum("violations").cast("long").alias("violations")
    )


# --- ingestion -------------------------------------------------------------------------------


def _vcf_files(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """A folder of VCF files per sample, as sequencing pipelines leave them."""

    def make(path: str) -> str:
        if kind == "cnv":
            records = render.cnv_records(views.cnv(spark, sf_dir))
        else:
            records = render.variant_records(views.variants(spark, sf_dir))
        render.write_files(records, path)
        return path

    return once(spark, sf_dir, f"{kind}-files", make)


def _ingest(
    spark: SparkSession, sf_dir: str, files: str, tables: list[str], source: str, files_per_batch: int, base: str
) -> dict[str, str]:
    """Ingest a folder of files; where its tables lie."""
    specs = {name: _fitted(spark, sf_dir, TABLES[name], source) for name in tables}
    targets = {name: f"{base}/{name}" for name in tables}
    ingest_folder(spark, files, targets, f"{base}/checkpoint", files_per_batch, specs=specs, new_annotations_only=True)
    return targets


def _ingested(
    spark: SparkSession, sf_dir: str, files: str, tables: list[str], source: str, files_per_batch: int
) -> dict[str, DataFrame]:
    """The tables after one ingestion of a folder of files."""
    targets = _ingest(spark, sf_dir, files, tables, source, files_per_batch, new_folder(spark, "ingest"))
    return {name: read_batches(spark, path, stored_layout(spark, path, TABLES[name])) for name, path in targets.items()}


def _files_per_batch(spark: SparkSession, sf_dir: str, batches: int) -> int:
    """A batch size that cuts the rendered files into a few batches."""
    samples = views.source(spark, sf_dir, "supplier").count()
    rows = views.source(spark, sf_dir, "lineitem").count()
    return max(1, (samples + rows // render.ROWS_PER_FILE) // batches)


def ingest_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and summed depth per sample after ingesting the files in several batches."""
    files, size = _vcf_files(spark, sf_dir, "variant"), _files_per_batch(spark, sf_dir, 3)
    stored = _ingested(spark, sf_dir, files, ["variants"], "lineitem", size)["variants"]
    return stored.groupBy("sample_name").agg(
        F.count("*").alias("variant_rows"), F.sum("read_depth").alias("depth")
    )


FANOUT = ["variants", "variants_by_sample", "annotations"]


def fanout_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the three tables that one ingestion has written; every run ingests anew."""
    files, size = _vcf_files(spark, sf_dir, "variant"), _files_per_batch(spark, sf_dir, 2)
    stored = _ingested(spark, sf_dir, files, FANOUT, "lineitem", size)
    return merged(
        [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in stored.items()]
    )


def _fanned_out(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """The three tables that one ingestion has written side by side, and where they lie; ingested once."""
    files, size = _vcf_files(spark, sf_dir, "variant"), _files_per_batch(spark, sf_dir, 2)

    def make(base: str) -> dict[str, str]:
        return _ingest(spark, sf_dir, files, FANOUT, "lineitem", size, base)

    targets = once(spark, sf_dir, "fanout", make)
    specs = {name: stored_layout(spark, path, TABLES[name]) for name, path in targets.items()}
    return {name: read_batches(spark, path, specs[name]) for name, path in targets.items()}, targets


def fanout_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows themselves: calls of both variant tables, loci of the annotations."""
    stored, _ = _fanned_out(spark, sf_dir)
    none = F.lit(None).cast("string")
    calls = [
        df.select(F.lit(name).alias("name"), "sample_name", "contig", "pos_start", "ref", "alt", "genotype", none.alias("symbol"))
        for name, df in stored.items()
        if name != "annotations"
    ]
    loci = stored["annotations"].select(
        F.lit("annotations").alias("name"), none.alias("sample_name"), F.col("chrom").alias("contig"),
        F.col("pos").alias("pos_start"), "ref", "alt", none.alias("genotype"), "symbol",
    )
    return merged([*calls, loci])


def batch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and samples that the writes of all batches have counted, by table."""
    _, targets = _fanned_out(spark, sf_dir)
    return merged(
        [
            totals(spark, path).agg(F.sum("rows").alias("n"), F.sum("samples").alias("samples")).select(F.lit(name).alias("name"), "n", "samples")
            for name, path in targets.items()
        ]
    )


def ingest_cnv(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _vcf_files(spark, sf_dir, "cnv")
    return _ingested(spark, sf_dir, files, ["cnv"], "orders", 100)["cnv"].select(*CNV_TABLE.schema.names)


def ingest_tpm(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _tpm_files(spark, sf_dir)
    return _ingested(spark, sf_dir, files, ["tpm"], "supplier", 100)["tpm"].select(*TPM_TABLE.schema.names)


# --- usage -----------------------------------------------------------------------------------


def _minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.minutes(views.usage(spark, sf_dir), *WINDOW)


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, DIGITS) for name in names})


def usage_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_minutes(spark, sf_dir), "value")


def usage_unit_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(usage.unit_hours(_minutes(spark, sf_dir)), "unit_hours")


def usage_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(usage.rollup(_minutes(spark, sf_dir)), "unit_hours")


def usage_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(usage.cost(_minutes(spark, sf_dir), "us-east-1"), "unit_hours", "cost")


QUERIES: dict[str, Query] = {
    "scan_variants": scan_variants,
    "normalise_variants": normalise_variants,
    "extract_annotations": extract_annotations,
    "merge_files": merge_files,
    "rare_filter": rare_filter,
    "quality_filter": quality_filter,
    "manifest_slice": manifest_slice,
    "manifest_paths": manifest_paths,
    "archive_members": archive_members,
    "vcf_parse_variants": vcf_parse_variants,
    "vcf_read_variants": vcf_read_variants,
    "vcf_parse_cnv": vcf_parse_cnv,
    "tpm_csv_normalise": tpm_csv_normalise,
    "locus_join": lambda spark, sf_dir: _joined(spark, sf_dir, "auto"),
    "join_broadcast": lambda spark, sf_dir: _joined(spark, sf_dir, "broadcast"),
    "join_shuffled": lambda spark, sf_dir: _joined(spark, sf_dir, "shuffle"),
    "join_salted": lambda spark, sf_dir: _joined(spark, sf_dir, "salt"),
    "locus_join_pruned": locus_join_pruned,
    "cohort_carriers_two_phase": cohort_carriers_two_phase,
    "dedup_rank": dedup_rank,
    "dedup_rank_nulls_first": dedup_rank_nulls_first,
    "dedup_minby": dedup_minby,
    "dedup_first": dedup_first,
    "dedup_rank_insert": dedup_rank_insert,
    "annotations_new_only": annotations_new_only,
    "layout_keys": layout_keys,
    "layout_bucket_sizes": layout_bucket_sizes,
    "layout_bucket_rows": layout_bucket_rows,
    "layout_append": layout_append,
    "write_read_variants": write_read_variants,
    "write_read_by_sample": write_read_by_sample,
    "by_sample_pruned": by_sample_pruned,
    "write_read_tpm": _write_read(views.tpm, TPM_TABLE, "supplier"),
    "write_read_cnv": _write_read(views.cnv, CNV_TABLE, "orders"),
    "region_pruned": region_pruned,
    "region_listed": region_listed,
    "layout_file_sizes": layout_file_sizes,
    "create_as_select": create_as_select,
    "sample_pruned": sample_pruned,
    "batch_sorted": batch_sorted,
    "sorted_check": sorted_check,
    "ingest_batches": ingest_batches,
    "fanout_counts": fanout_counts,
    "fanout_rows": fanout_rows,
    "batch_totals": batch_totals,
    "ingest_cnv": ingest_cnv,
    "ingest_tpm": ingest_tpm,
    "usage_minutes": usage_minutes,
    "usage_unit_hours": usage_unit_hours,
    "usage_rollup": usage_rollup,
    "usage_cost": usage_cost,
}
