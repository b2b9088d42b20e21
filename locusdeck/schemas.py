"""Table schemas and the physical layout each table is stored in."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, replace
from math import ceil

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "array<int>": T.ArrayType(T.IntegerType()),
}


def _columns(text: str) -> T.StructType:
    """Nullable columns from ``name type`` pairs; works before there is a session."""
    pairs = (part.split() for part in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# --- fixed values: column names, order and types of the five tables ---

VARIANTS = _columns(
    "sample_name string, contig string, pos_start int, pos_end int, ref string, alt string,"
    "qual double, filters string, genotype string, read_depth int, allele_depth array<int>,"
    "genotype_quality int, variant_allele_frequency float, somalone_somatic_score float,"
    "vep_gene string, vep_symbol string, vep_consequence string, vep_impact string,"
    "gnomad_af float, gnomad_af_popmax float, pathogenecity string, data_source string,"
    "somalone_predicted_origin string, data_type string"
)

ANNOTATIONS = _columns(
    "chrom string, pos int, ref string, alt string, gene string, symbol string,"
    "consequence string, impact string, gnomad_af float, gnomad_af_popmax float,"
    "pathogenecity string"
)

TPM = _columns(
    "sample_id string, gene_id string, gene_symbol string, expression float, tissue string,"
    "dataset string, dataset_version string, genome_build string, annotation string,"
    "quant_method string, unit string"
)

CNV = _columns(
    "importjobid string, sampleid string, technology string, pipeline string,"
    "pipeline_version string, out_path string, record_type string, contigname string,"
    "start int, end int, gene string, log2 float, baf float, cn float, copy int, call string"
)

# The by-sample copy carries no provenance columns.
VARIANTS_BY_SAMPLE = T.StructType(
    [f for f in VARIANTS.fields if f.name not in ("data_source", "data_type")]
)

USAGE = _columns(
    "ts timestamp, resource string, worker_type string, capacity_type string, value double"
)

# --- end of fixed values ---

MIB = 1024 * 1024


@dataclass(frozen=True)
class Truncate:
    """Floor an integer column to a multiple of ``width``."""

    column: str
    width: int
    name: str = "pos_trunc"


@dataclass(frozen=True)
class Bucket:
    """Spread a column over ``count`` hash buckets."""

    column: str
    count: int
    name: str


@dataclass(frozen=True)
class Identity:
    """A copy of the column, so that the column itself stays in the files."""

    column: str
    name: str


PartitionKey = Truncate | Bucket | Identity


@dataclass(frozen=True)
class TableSpec:
    """What a stored table looks like: columns, partition keys, sort order, file settings."""

    name: str
    schema: T.StructType
    partition_by: tuple[PartitionKey, ...]
    sort_by: tuple[str, ...]
    bloom: tuple[str, ...] = ()
    target_file_bytes: int = 128 * MIB
    codec: str = "snappy"

    @property
    def partition_names(self) -> list[str]:
        return [key.name for key in self.partition_by]

    @property
    def stored_schema(self) -> T.StructType:
        """Columns as read back: the table's own, then the partition keys."""
        kinds = {Identity: T.StringType(), Truncate: T.IntegerType(), Bucket: T.IntegerType()}
        extra = [T.StructField(key.name, kinds[type(key)]) for key in self.partition_by]
        return T.StructType(self.schema.fields + extra)

    def key(self, kind: type, column: str | None = None) -> PartitionKey | None:
        for key in self.partition_by:
            if isinstance(key, kind) and column in (None, key.column):
                return key
        return None

    def layout_text(self) -> str:
        """The partition keys as text, as they are kept with a stored table."""
        return json.dumps([{"kind": type(key).__name__} | asdict(key) for key in self.partition_by])

    def with_layout(self, text: str) -> "TableSpec":
        """The same table under the partition keys of a ``layout_text``."""
        kinds = {kind.__name__: kind for kind in (Truncate, Bucket, Identity)}
        keys = [kinds[entry.pop("kind")](**entry) for entry in json.loads(text)]
        return replace(self, partition_by=tuple(keys))

    def fitted(
        self, table_bytes: int, contigs: int = 24, genome_span: int = 250_000_000, least: int = 1
    ) -> "TableSpec":
        """Coarser keys for a small table, so that a partition still fills a file.

        At full size the declared keys are kept; below that, buckets go first and
        truncation widths grow until the number of partitions is what the bytes can fill. A
        truncated or bucketed key keeps ``least`` parts, or as many as are declared. A layout is chosen
        once, for a new table; later lots are written in the one that is kept with the table.
        """
        room = max(1, ceil(table_bytes / self.target_file_bytes))
        if self.key(Identity):
            room = max(1, room // contigs)
        keys: list[PartitionKey] = []
        for key in self.partition_by:
            if isinstance(key, Truncate):
                pieces = max(1, min(max(room, least), genome_span // key.width))
                multiple = ceil(genome_span / pieces / key.width)
                key = replace(key, width=key.width * max(1, multiple))
                room = max(1, room // pieces)
            elif isinstance(key, Bucket):
                count = max(1, min(max(room, least), key.count))
                key = replace(key, count=count)
                room = max(1, room // count)
            keys.append(key)
        return replace(self, partition_by=tuple(keys))


# --- fixed values: partition keys, sort orders, bloom columns and file sizes ---

VARIANTS_TABLE = TableSpec(
    name="variants",
    schema=VARIANTS,
    partition_by=(
        Identity("contig", "contig_part"),
        Truncate("pos_start", 5_000_000),
        Bucket("sample_name", 16, "sample_bucket"),
    ),
    sort_by=("pos_start", "ref", "alt"),
    bloom=("ref", "alt", "vep_gene", "vep_symbol"),
    target_file_bytes=256 * MIB,
)

ANNOTATIONS_TABLE = TableSpec(
    name="annotations",
    schema=ANNOTATIONS,
    partition_by=(Identity("chrom", "chrom_part"), Truncate("pos", 5_000_000)),
    sort_by=("pos", "ref", "alt"),
    bloom=("ref", "alt", "gene", "symbol"),
    target_file_bytes=128 * MIB,
)

ANNOTATIONS_DEDUP_TABLE = replace(ANNOTATIONS_TABLE, name="annotations_dedup")

VARIANTS_BY_SAMPLE_TABLE = TableSpec(
    name="variants_by_sample",
    schema=VARIANTS_BY_SAMPLE,
    partition_by=(
        Bucket("sample_name", 4096, "sample_bucket"),
        Identity("contig", "contig_part"),
        Truncate("pos_start", 50_000_000),
    ),
    sort_by=("pos_start", "ref", "alt"),
    bloom=("ref", "alt"),
    target_file_bytes=128 * MIB,
)

TPM_TABLE = TableSpec(
    name="tpm",
    schema=TPM,
    partition_by=(
        Bucket("sample_id", 128, "sample_bucket"),
        Bucket("gene_symbol", 64, "gene_bucket"),
    ),
    sort_by=("sample_id", "gene_symbol", "tissue"),
    bloom=("sample_id", "gene_symbol", "gene_id"),
    target_file_bytes=128 * MIB,
    codec="zstd",
)

CNV_TABLE = TableSpec(
    name="cnv",
    schema=CNV,
    partition_by=(
        Identity("contigname", "contig_part"),
        Truncate("start", 5_000_000),
        Bucket("sampleid", 16, "sample_bucket"),
    ),
    sort_by=("start", "end", "gene"),
    bloom=("gene", "sampleid"),
    target_file_bytes=256 * MIB,
    codec="zstd",
)

# --- end of fixed values ---

TABLES = {
    spec.name: spec
    for spec in (
        VARIANTS_TABLE,
        ANNOTATIONS_TABLE,
        ANNOTATIONS_DEDUP_TABLE,
        VARIANTS_BY_SAMPLE_TABLE,
        TPM_TABLE,
        CNV_TABLE,
    )
}

LOCUS = ("contig", "pos_start", "ref", "alt")
ANNOTATION_LOCUS = ("chrom", "pos", "ref", "alt")
