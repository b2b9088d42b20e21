"""SQL twins of the registered queries, for an independent engine over the same tables.

Each text stands alone: the derived tables come first as common table expressions, written
out from their specification and not from the Spark code.
"""

from __future__ import annotations

VARIANTS = """
SELECT concat('S', CAST(l.l_suppkey AS VARCHAR)) AS sample_name,
 concat('chr', CAST(p.p_partkey % 22 + 1 AS VARCHAR)) AS contig,
 CAST((p.p_partkey * 7919) % 240 * 1000000 + p.p_partkey AS INT) AS pos_start,
 CAST((p.p_partkey * 7919) % 240 * 1000000 + p.p_partkey AS INT) AS pos_end,
 substr('ACGT', CAST(p.p_partkey % 4 + 1 AS INT), 1) AS ref,
 substr('ACGT', CAST((p.p_partkey * 3 + 1) % 4 + 1 AS INT), 1) AS alt,
 l.l_extendedprice AS qual,
 CASE l.l_orderkey % 7 WHEN 0 THEN 'LowQ' WHEN 1 THEN 'LowQ;AC0' WHEN 2 THEN NULL WHEN 3 THEN 'AC0' ELSE 'PASS' END AS filters,
 CASE (l.l_orderkey + l.l_linenumber) % 6 WHEN 0 THEN '0/0' WHEN 1 THEN '0/1' WHEN 2 THEN '1/1' WHEN 3 THEN './.' WHEN 4 THEN '.|.' ELSE '0|1' END AS genotype,
 CASE WHEN l.l_linenumber = 7 THEN NULL ELSE CAST(l.l_quantity AS INT) END AS read_depth,
 concat(CAST(CAST(l.l_quantity AS INT) AS VARCHAR), ',', CAST(l.l_linenumber AS VARCHAR)) AS allele_depth,
 CAST(l.l_linenumber * 14 AS INT) AS genotype_quality,
 CAST(l.l_discount AS FLOAT) AS variant_allele_frequency,
 CAST(1 - l.l_tax AS FLOAT) AS somalone_somatic_score,
 CASE WHEN l.l_linenumber % 3 = 0 THEN NULL ELSE concat('ENSG', CAST(p.p_partkey % 50 AS VARCHAR), '.', CAST(l.l_linenumber % 3 AS VARCHAR)) END AS vep_gene,
 CASE p.p_brand WHEN 'Brand#1' THEN 'TP53' WHEN 'Brand#2' THEN 'BRCA1' WHEN 'Brand#3' THEN 'KMT2C' WHEN 'Brand#4' THEN 'WASH8P' WHEN 'Brand#5' THEN 'DNAH2' ELSE concat('GENE_', substr(p.p_brand, 7)) END AS vep_symbol,
 CASE p.p_partkey % 5 WHEN 0 THEN 'transcript_ablation' WHEN 1 THEN 'synonymous_variant' WHEN 2 THEN 'missense_variant' WHEN 3 THEN 'missense_variant&splice_region_variant' ELSE 'intron_variant' END AS vep_consequence,
 CASE p.p_size % 4 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MODERATE' WHEN 2 THEN 'LOW' ELSE 'MODIFIER' END AS vep_impact,
 CASE WHEN p.p_partkey % 9 = 0 THEN NULL ELSE CAST(CAST(p.p_size AS DOUBLE) / 1000 AS FLOAT) END AS gnomad_af,
 CASE WHEN p.p_partkey % 9 = 0 THEN NULL ELSE CAST(CAST(p.p_size AS DOUBLE) / 500 AS FLOAT) END AS gnomad_af_popmax,
 CASE p.p_partkey % 8 WHEN 0 THEN NULL WHEN 1 THEN 'pathogenic' WHEN 2 THEN 'Likely_Pathogenic' WHEN 3 THEN 'uncertain_significance' WHEN 4 THEN 'uncertain_significance,pathogenic' WHEN 5 THEN 'protective&likely_pathogenic' WHEN 6 THEN 'other' ELSE 'benign' END AS pathogenecity,
 CASE l.l_returnflag WHEN 'A' THEN 'ICGC-ARGO' WHEN 'N' THEN 'TCGA-GDC' ELSE 'TCGA-legacy' END AS data_source,
 CASE WHEN l.l_linenumber % 2 = 0 THEN 'somatic' ELSE 'germline' END AS somalone_predicted_origin,
 CASE l.l_linestatus WHEN 'O' THEN 'real' ELSE 'synthetic' END AS data_type,
 l.l_orderkey, l.l_linenumber
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""

ANNOTATIONS = """
SELECT contig AS chrom, pos_start AS pos, ref, alt, vep_gene AS gene, vep_symbol AS symbol,
 vep_consequence AS consequence, vep_impact AS impact, gnomad_af, gnomad_af_popmax, pathogenecity
FROM fx_variants"""

DEDUP = """
SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (
 PARTITION BY chrom, pos, ref, alt ORDER BY gene ASC NULLS LAST) AS rn FROM fx_annotations) WHERE rn = 1"""

TPM = """
SELECT concat('S', CAST(s.s_suppkey AS VARCHAR)) AS sample_id, concat('ENSG', substr(b.p_brand, 7)) AS gene_id,
 CASE b.p_brand WHEN 'Brand#1' THEN 'TP53' WHEN 'Brand#2' THEN 'BRCA1' WHEN 'Brand#3' THEN 'KMT2C' WHEN 'Brand#4' THEN 'WASH8P' WHEN 'Brand#5' THEN 'DNAH2' ELSE concat('GENE_', substr(b.p_brand, 7)) END AS gene_symbol,
 CASE WHEN s.s_suppkey % 11 = 0 THEN NULL ELSE CAST(abs(s.s_acctbal) AS FLOAT) END AS expression,
 concat('tissue_', CAST(s.s_nationkey % 5 AS VARCHAR)) AS tissue, 'ds' AS dataset, 'v1' AS dataset_version,
 'GRCh38' AS genome_build, 'gencode' AS annotation, 'salmon' AS quant_method, 'TPM' AS unit
FROM supplier s JOIN (SELECT DISTINCT l_suppkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey) b
 ON s.s_suppkey = b.l_suppkey"""

CNV = """
SELECT concat('job', CAST(o_custkey % 10 AS VARCHAR)) AS importjobid, concat('S', CAST(o_custkey % 100 AS VARCHAR)) AS sampleid,
 'WGS' AS technology, 'cnvkit' AS pipeline, '1.0' AS pipeline_version, concat('/out/', CAST(o_orderkey AS VARCHAR)) AS out_path,
 CASE WHEN o_orderkey % 2 = 0 THEN 'segment' ELSE 'gene' END AS record_type,
 concat('chr', CAST(o_orderkey % 22 + 1 AS VARCHAR)) AS contigname, CAST((o_orderkey * 7919) % 240 * 1000000 AS INT) AS "start",
 CAST((o_orderkey * 7919) % 240 * 1000000 + 50000 + o_custkey AS INT) AS "end", concat('GENE_', CAST(o_orderkey % 25 AS VARCHAR)) AS gene,
 CAST(o_totalprice / 500000 - 1 AS FLOAT) AS log2, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_totalprice / 1000000 AS FLOAT) END AS baf,
 CAST(o_orderkey % 5 AS FLOAT) AS cn, CAST(o_orderkey % 5 AS INT) AS copy,
 CASE o_orderstatus WHEN 'F' THEN 'gain' WHEN 'O' THEN 'loss' ELSE 'neutral' END AS call
FROM orders"""

USAGE = """
SELECT ts, CASE user_id % 3 WHEN 0 THEN 'vcpu' WHEN 1 THEN 'mem' ELSE 'storage' END AS resource,
 CASE event_id % 3 WHEN 0 THEN 'Spark_Driver' WHEN 1 THEN 'Spark_Executor' ELSE 'Spark_Kernel' END AS worker_type,
 CASE WHEN event_id % 2 = 0 THEN 'OnDemandCapacity' ELSE 'PreInitCapacity' END AS capacity_type, value
FROM events"""

_VIEWS = {
    "fx_variants": (VARIANTS, ()),
    "fx_annotations": (ANNOTATIONS, ("fx_variants",)),
    "fx_dedup": (DEDUP, ("fx_annotations",)),
    "fx_tpm": (TPM, ()),
    "fx_cnv": (CNV, ()),
    "fx_usage": (USAGE, ()),
}

# Reusable conditions, in the oracle's own words.
RARE = "(gnomad_af IS NULL OR gnomad_af < CAST(0.01 AS FLOAT))"
CALLED = "genotype <> '0/0' AND read_depth >= 10 AND filters NOT LIKE '%LowQ%'"
HARMFUL = "lower(pathogenecity) LIKE '%pathogenic%'"

ALL = "* EXCLUDE (l_orderkey, l_linenumber)"

# Variants with the annotation of their locus in columns prefixed a_.
JOINED = """
SELECT v.*, a.chrom AS a_chrom, a.pos AS a_pos, a.ref AS a_ref, a.alt AS a_alt, a.gene AS a_gene,
 a.symbol AS a_symbol, a.consequence AS a_consequence, a.impact AS a_impact, a.gnomad_af AS a_gnomad_af,
 a.gnomad_af_popmax AS a_gnomad_af_popmax, a.pathogenecity AS a_pathogenecity
FROM fx_variants v JOIN fx_dedup a
 ON (v.contig, v.pos_start, v.ref, v.alt) = (a.chrom, a.pos, a.ref, a.alt)"""

A_RARE = "(a_gnomad_af IS NULL OR a_gnomad_af < CAST(0.01 AS FLOAT))"
A_HARMFUL = "lower(a_pathogenecity) LIKE '%pathogenic%'"


def _needed(text: str) -> list[str]:
    """Views a text mentions, each after the views it is made from."""
    order: list[str] = []

    def visit(name: str) -> None:
        for below in _VIEWS[name][1]:
            visit(below)
        if name not in order:
            order.append(name)

    for name in _VIEWS:
        if name in text:
            visit(name)
    return order


def over_views(select: str, **more: str) -> str:
    """A statement over the derived tables and further named expressions."""
    mentioned = select + "".join(more.values())
    parts = [f"{name} AS ({_VIEWS[name][0]})" for name in _needed(mentioned)]
    parts += [f"{name} AS ({text})" for name, text in more.items()]
    return "WITH " + ",\n".join(parts) + "\n" + select


def over_joined(select: str) -> str:
    return over_views(select, joined=JOINED)


_IN_CLASSES = "pathogenecity IN ('pathogenic', 'uncertain_significance')"
_UNCERTAIN = "pathogenecity = 'uncertain_significance,pathogenic'"
_CLASS = """CASE WHEN lower({p}) LIKE '%likely%' THEN 'likely_pathogenic'
 WHEN lower({p}) LIKE '%pathogenic%' THEN 'pathogenic' ELSE 'other' END"""
_COHORT = """CASE WHEN data_source = 'ICGC-ARGO' AND {i} = 'HIGH' THEN 'cohort_A_high'
 WHEN data_source = 'ICGC-ARGO' THEN 'cohort_A' WHEN data_source LIKE '%TCGA%' THEN 'cohort_B' ELSE 'full_cohort' END"""


def _matrix(source: str, gene: str, impact: str, pathogenicity: str, rare: str) -> str:
    return f"""SELECT {gene} AS gene, {_CLASS.format(p=pathogenicity)} AS pathogenicity_class,
 {_COHORT.format(i=impact)} AS cohort_group, count(*) AS variant_count, count(DISTINCT sample_name) AS carrier_count
FROM {source} WHERE {rare} AND {gene} IN ('TP53', 'BRCA1', 'KMT2C') AND {CALLED}
 AND ({impact} = 'HIGH' OR lower({pathogenicity}) LIKE '%pathogenic%') GROUP BY 1, 2, 3"""


def _hotspots(source: str, gene: str, rare: str) -> str:
    return f"""SELECT {gene} AS gene, contig, pos_start, data_source, count(*) AS variant_rows,
 count(DISTINCT sample_name) AS carrier_count
FROM {source} WHERE ({gene} = 'TP53' OR (contig = 'chr1' AND pos_start BETWEEN 1 AND 100000000))
 AND genotype <> '0/0' AND read_depth >= 10 AND filters = 'PASS' AND {rare}
 AND data_source IN ('ICGC-ARGO', 'TCGA-GDC') GROUP BY 1, 2, 3, 4"""


def _carriers_on(where: str) -> str:
    return f"""SELECT a_symbol AS gene, lower(a_pathogenecity) AS pathogenecity,
 count(DISTINCT sample_name) AS carrier_count FROM joined
WHERE {A_RARE} AND {A_HARMFUL} AND {CALLED} AND {where} GROUP BY 1, 2"""


def _variant_rows(where: str) -> str:
    return over_views(f"SELECT {ALL} FROM fx_variants WHERE {where}")


_V_COLUMNS = "* EXCLUDE (l_orderkey, l_linenumber, a_chrom, a_pos, a_ref, a_alt, a_gene, a_symbol, a_consequence, a_impact, a_gnomad_af, a_gnomad_af_popmax, a_pathogenecity)"

CATALOGUE: dict[str, str] = {
    "Q1": over_joined(_carriers_on("contig = 'chr6' AND pos_start >= 1 AND pos_start < 200000000")),
    "Q2": _variant_rows("contig = 'chr7' AND pos_start BETWEEN 100000000 AND 200000000"),
    "Q3": _variant_rows("sample_name = 'S1'"),
    "Q4": _variant_rows(
        "sample_name IN ('S1', 'S2') AND ((contig = 'chr7' AND pos_start BETWEEN 100000000 AND 200000000)"
        " OR (contig = 'chr12' AND pos_start BETWEEN 1 AND 150000000))"
    ),
    "Q5": _variant_rows("sample_name IN ('S1', 'S2') AND filters = 'PASS'"),
    "Q6": _variant_rows("contig = 'chr7' AND pos_start BETWEEN 1 AND 150000000 AND filters = 'AC0'"),
    "Q7": _variant_rows("vep_symbol = 'WASH8P' AND sample_name = 'S2'"),
    "Q8": _variant_rows(
        "somalone_somatic_score >= CAST(0.99 AS FLOAT) AND contig = 'chr12' AND pos_start BETWEEN 1 AND 150000000"
    ),
    "Q9": over_views(
        "SELECT DISTINCT sample_name FROM fx_variants"
        " WHERE filters = 'PASS' AND pathogenecity IN ('protective&likely_pathogenic', 'other')"
    ),
    "Q10": _variant_rows(
        "contig = 'chr15' AND pos_start BETWEEN 1 AND 200000000 AND vep_consequence = 'transcript_ablation'"
        " AND read_depth >= 20 AND variant_allele_frequency >= CAST(0.05 AS FLOAT)"
    ),
    "Q11": over_views(
        "SELECT sample_name, count(*) AS variant_count, avg(read_depth) AS mean_depth FROM fx_variants GROUP BY 1"
    ),
    "Q12": over_views("SELECT pathogenecity, count(*) AS n FROM fx_variants GROUP BY 1"),
    "Q13": over_views(
        f"SELECT vep_symbol, count(*) AS vus_count FROM fx_variants WHERE {_UNCERTAIN}"
        " AND vep_impact IN ('HIGH', 'MODERATE') AND vep_consequence <> 'synonymous_variant'"
        " AND read_depth >= 10 AND genotype NOT IN ('./.', '.|.') GROUP BY 1"
    ),
    "Q14": _variant_rows(
        f"gnomad_af < CAST(0.01 AS FLOAT) AND {_IN_CLASSES} AND genotype <> '0/1' AND read_depth >= 10"
        " AND filters NOT LIKE '%LowQ%'"
    ),
    "Q15": over_views(
        "SELECT vep_symbol AS gene, lower(pathogenecity) AS pathogenicity, count(DISTINCT sample_name) AS carrier_count"
        f" FROM fx_variants WHERE {RARE} AND {HARMFUL} AND {CALLED} GROUP BY 1, 2"
    ),
    "Q16": over_views(
        "SELECT vep_symbol AS gene,"
        " count(DISTINCT sample_name) FILTER (WHERE data_source = 'ICGC-ARGO') AS icgc_carriers,"
        " count(DISTINCT sample_name) FILTER (WHERE data_source LIKE '%TCGA%') AS tcga_carriers"
        f" FROM fx_variants WHERE {RARE} AND (vep_impact = 'HIGH' OR {HARMFUL}) AND {CALLED}"
        " AND data_type = 'real' GROUP BY 1"
    ),
    "Q17": over_views(_hotspots("fx_variants", "vep_symbol", RARE)),
    "Q18": over_views(_matrix("fx_variants", "vep_symbol", "vep_impact", "pathogenecity", RARE)),
    "S1": over_joined(
        f"SELECT {_V_COLUMNS} FROM joined WHERE a_symbol = 'WASH8P' AND sample_name = 'S2'"
    ),
    "S2": over_joined(
        "SELECT DISTINCT sample_name FROM joined WHERE filters = 'PASS'"
        " AND a_pathogenecity IN ('protective&likely_pathogenic', 'other')"
    ),
    "S3": over_joined(
        f"SELECT {_V_COLUMNS} FROM joined WHERE contig = 'chr15' AND pos_start BETWEEN 1 AND 200000000"
        " AND a_consequence = 'transcript_ablation' AND read_depth >= 20"
        " AND variant_allele_frequency >= CAST(0.05 AS FLOAT)"
    ),
    "S4": over_views(
        "SELECT count(t.expression) AS n FROM fx_tpm t JOIN fx_variants v"
        " ON t.sample_id = v.sample_name AND t.gene_symbol = v.vep_symbol"
        " WHERE t.gene_symbol = 'DNAH2' AND v.data_source = 'ICGC-ARGO'"
    ),
    "S5": over_joined(
        "SELECT a_pathogenecity AS pathogenecity, count(*) AS vus_count FROM joined GROUP BY 1"
    ),
    "S6": over_joined(
        "SELECT a_symbol AS symbol, count(*) AS vus_count FROM joined WHERE read_depth >= 10"
        " AND genotype NOT IN ('./.', '.|.') AND a_pathogenecity = 'uncertain_significance,pathogenic'"
        " AND a_impact IN ('HIGH', 'MODERATE') AND a_consequence <> 'synonymous_variant' GROUP BY 1"
    ),
    "S7": over_joined(
        f"SELECT {ALL} FROM joined WHERE a_gnomad_af < CAST(0.01 AS FLOAT)"
        " AND a_pathogenecity IN ('pathogenic', 'uncertain_significance') AND genotype <> '0/1'"
        " AND read_depth >= 10 AND filters NOT LIKE '%LowQ%'"
    ),
    "S8": over_joined(
        "SELECT a_symbol AS gene, lower(a_pathogenecity) AS pathogenicity, count(DISTINCT sample_name) AS carrier_count"
        f" FROM joined WHERE {A_RARE} AND {A_HARMFUL} AND {CALLED} GROUP BY 1, 2"
    ),
    "S9": over_joined(
        "SELECT a_symbol AS gene,"
        " count(DISTINCT sample_name) FILTER (WHERE data_source = 'ICGC-ARGO') AS icgc_carriers,"
        " count(DISTINCT sample_name) FILTER (WHERE data_source = 'TCGA-GDC') AS tcga_carriers"
        f" FROM joined WHERE {A_RARE} AND (a_impact = 'HIGH' OR {A_HARMFUL}) AND {CALLED} GROUP BY 1"
    ),
    "S10": over_joined(_hotspots("joined", "a_symbol", A_RARE)),
    "S10_union": over_joined(_hotspots("joined", "a_symbol", A_RARE)),
    "S11": over_joined(_matrix("joined", "a_symbol", "a_impact", "a_pathogenecity", A_RARE)),
    "E1": over_joined(_carriers_on("contig = 'chr6'")),
    "R1": over_joined(
        "SELECT a_symbol AS gene_symbol, count(*) AS num_non_silent FROM joined"
        " WHERE filters = 'PASS' AND a_impact = 'LOW' AND a_consequence LIKE '%missense%' GROUP BY 1"
    ),
}

_JOIN_ROWS = over_joined(
    "SELECT sample_name, contig, pos_start, ref, alt, genotype, a_gene, a_impact FROM joined"
)

_LOCI_OF = """
SELECT * EXCLUDE (rn) FROM (SELECT v.contig AS chrom, v.pos_start AS pos, v.ref, v.alt, v.vep_gene AS gene,
 v.vep_symbol AS symbol, v.vep_consequence AS consequence, v.vep_impact AS impact, v.gnomad_af, v.gnomad_af_popmax,
 v.pathogenecity, ROW_NUMBER() OVER (PARTITION BY contig, pos_start, ref, alt ORDER BY {order}) AS rn
 FROM fx_variants v WHERE {where}) WHERE rn = 1"""

_SECOND = "CAST(split_part(allele_depth, ',', 1) AS INT) < 46"

_WINDOW = "ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-10 00:00:00'"
_MINUTES = f"""
SELECT resource, worker_type, capacity_type, date_trunc('minute', ts) AS minute, avg(value) AS value
FROM fx_usage WHERE {_WINDOW} GROUP BY ALL"""
_HOURS = """
SELECT resource, worker_type, capacity_type, sum(value) * (60.0::DOUBLE / 3600) AS unit_hours
FROM minutes GROUP BY ALL"""

_MANIFEST = """SELECT CAST(ordinal AS BIGINT) AS ordinal, path FROM (
 SELECT ROW_NUMBER() OVER (ORDER BY s_suppkey) - 1 AS ordinal,
 concat('s3://cohort/S', CAST(s_suppkey AS VARCHAR), '.zip') AS path FROM supplier)"""

OPERATORS: dict[str, str] = {
    "scan_variants": _variant_rows("TRUE"),
    "normalise_variants": _variant_rows("TRUE"),
    "extract_annotations": over_views("SELECT * FROM fx_annotations"),
    "merge_files": _variant_rows("data_type IN ('real', 'synthetic')"),
    "rare_filter": _variant_rows(RARE),
    "quality_filter": _variant_rows(CALLED),
    "manifest_slice": f"{_MANIFEST} WHERE ordinal BETWEEN 2 AND 7",
    "manifest_paths": _MANIFEST,
    "archive_members": over_views("SELECT contig, pos_start, ref, alt, genotype FROM fx_variants"),
    "vcf_parse_variants": _variant_rows("TRUE"),
    "vcf_read_variants": _variant_rows("TRUE"),
    "vcf_parse_cnv": over_views("SELECT * FROM fx_cnv"),
    "tpm_csv_normalise": over_views("SELECT * FROM fx_tpm"),
    "locus_join": _JOIN_ROWS,
    "join_broadcast": _JOIN_ROWS,
    "join_shuffled": _JOIN_ROWS,
    "join_salted": _JOIN_ROWS,
    "locus_join_pruned": over_joined(
        "SELECT sample_name, contig, pos_start, ref, alt, genotype, a_impact FROM joined WHERE a_symbol = 'WASH8P'"
    ),
    "cohort_carriers_two_phase": over_views(
        "SELECT vep_symbol AS gene,"
        " count(DISTINCT CASE WHEN data_source = 'ICGC-ARGO' THEN sample_name END) AS icgc_carriers,"
        " count(DISTINCT CASE WHEN data_source LIKE '%TCGA%' THEN sample_name END) AS tcga_carriers,"
        " count(DISTINCT CASE WHEN data_type = 'real' THEN sample_name END) AS real_carriers"
        " FROM fx_variants GROUP BY 1"
    ),
    "dedup_rank": over_views("SELECT * FROM fx_dedup"),
    "dedup_rank_nulls_first": over_views(_LOCI_OF.format(order="vep_gene ASC NULLS FIRST", where="TRUE")),
    "dedup_minby": over_views("SELECT * FROM fx_dedup"),
    "dedup_first": over_views(
        _LOCI_OF.format(order="sample_name, l_orderkey, l_linenumber", where="TRUE")
    ),
    "dedup_rank_insert": over_views("SELECT * FROM fx_dedup"),
    "annotations_new_only": over_views(
        "SELECT e.* FROM second e WHERE NOT EXISTS (SELECT 1 FROM fx_variants v WHERE NOT ("
        + _SECOND
        + ") AND (v.contig, v.pos_start, v.ref, v.alt) = (e.chrom, e.pos, e.ref, e.alt))",
        second=_LOCI_OF.format(order="vep_gene ASC NULLS LAST", where=_SECOND),
    ),
    "layout_keys": over_views(
        "SELECT sample_name, contig, pos_start, contig AS contig_part,"
        " CAST(floor(pos_start / 5000000.0) * 5000000 AS INT) AS pos_trunc,"
        " CAST(floor(pos_start / 50000000.0) * 50000000 AS INT) AS pos_trunc_by_sample,"
        " CAST(floor(-pos_start / 5000000.0) * 5000000 AS INT) AS pos_trunc_negative FROM fx_variants"
    ),
    "layout_bucket_sizes": over_views(
        "SELECT b.buckets, count(DISTINCT sample_name) AS samples, count(*) AS variant_rows, CAST(1 AS INT) AS in_range"
        " FROM fx_variants, (VALUES (16), (64), (128), (4096)) b(buckets) GROUP BY 1"
    ),
    "layout_append": _variant_rows(
        "(contig = 'chr7' AND pos_start BETWEEN 100000000 AND 200000000) OR sample_name IN ('S1', 'S2')"
    ),
    "layout_bucket_rows": over_views(
        "SELECT CAST(1 AS BIGINT) AS buckets, count(DISTINCT sample_name) AS samples,"
        " count(*) AS variant_rows, CAST(1 AS INT) AS in_range FROM fx_variants"
    ),
    "write_read_variants": _variant_rows("TRUE"),
    "write_read_by_sample": over_views(
        "SELECT * EXCLUDE (l_orderkey, l_linenumber, data_source, data_type) FROM fx_variants"
    ),
    "write_read_tpm": over_views("SELECT * FROM fx_tpm"),
    "write_read_cnv": over_views("SELECT * FROM fx_cnv"),
    "by_sample_pruned": over_views(
        "SELECT * EXCLUDE (l_orderkey, l_linenumber, data_source, data_type) FROM fx_variants"
        " WHERE sample_name = 'S1' AND contig = 'chr12' AND pos_start BETWEEN 1 AND 150000000"
    ),
    "region_pruned": _variant_rows("contig = 'chr7' AND pos_start BETWEEN 100000000 AND 200000000"),
    "region_listed": _variant_rows("contig = 'chr7' AND pos_start BETWEEN 100000000 AND 200000000"),
    "layout_file_sizes": over_views("SELECT contig, count(*) AS n, 0 AS oversized FROM fx_variants GROUP BY 1"),
    "create_as_select": _variant_rows("TRUE"),
    "sample_pruned": _variant_rows("sample_name IN ('S1', 'S2')"),
    "batch_sorted": over_views(
        "SELECT contig, pos_start, ref, alt, sample_name, genotype FROM fx_variants"
    ),
    "sorted_check": over_views(
        "SELECT count(*) AS checked_rows, CAST(0 AS BIGINT) AS violations FROM fx_variants"
    ),
    "ingest_batches": over_views(
        "SELECT sample_name, count(*) AS variant_rows, CAST(sum(read_depth) AS BIGINT) AS depth FROM fx_variants GROUP BY 1"
    ),
    "fanout_counts": over_views(
        "SELECT 'variants' AS name, count(*) AS n FROM fx_variants"
        " UNION ALL SELECT 'variants_by_sample', count(*) FROM fx_variants"
        " UNION ALL SELECT 'annotations', count(*) FROM fx_dedup"
    ),
    "fanout_rows": over_views(
        "SELECT t.name, sample_name, contig, pos_start, ref, alt, genotype, CAST(NULL AS VARCHAR) AS symbol"
        " FROM fx_variants, (VALUES ('variants'), ('variants_by_sample')) t(name)"
        " UNION ALL SELECT 'annotations', NULL, chrom, pos, ref, alt, NULL, symbol FROM fx_dedup"
    ),
    "batch_totals": over_views(
        "SELECT t.name, count(*) AS n, count(DISTINCT sample_name) AS samples"
        " FROM fx_variants, (VALUES ('variants'), ('variants_by_sample')) t(name) GROUP BY 1"
        " UNION ALL SELECT 'annotations', count(*), NULL FROM fx_dedup"
    ),
    "ingest_cnv": over_views("SELECT * FROM fx_cnv"),
    "ingest_tpm": over_views("SELECT * FROM fx_tpm"),
    "usage_minutes": over_views(
        "SELECT resource, worker_type, capacity_type, minute, round(value, 6) AS value FROM minutes",
        minutes=_MINUTES,
    ),
    "usage_unit_hours": over_views(
        "SELECT resource, worker_type, capacity_type, round(unit_hours, 6) AS unit_hours FROM hours",
        minutes=_MINUTES,
        hours=_HOURS,
    ),
    "usage_rollup": over_views(
        "SELECT 'series' AS level, resource, worker_type, capacity_type, round(unit_hours, 6) AS unit_hours"
        " FROM hours WHERE unit_hours > 0"
        " UNION ALL SELECT 'resource', resource, NULL, NULL, round(sum(unit_hours), 6) FROM hours GROUP BY resource"
        " UNION ALL SELECT 'total', NULL, NULL, NULL, round(sum(unit_hours), 6) FROM hours",
        minutes=_MINUTES,
        hours=_HOURS,
    ),
    "usage_cost": over_views(
        "SELECT resource, round(used, 6) AS unit_hours, rate, round(used * rate, 6) AS cost FROM priced"
        " UNION ALL SELECT 'TOTAL', NULL, NULL, round(sum(used * rate), 6) FROM priced",
        minutes=_MINUTES,
        hours=_HOURS,
        priced="""SELECT c.resource, coalesce(h.used, 0) AS used, c.rate
FROM (VALUES ('vcpu', 0.0520::DOUBLE), ('mem', 0.00571::DOUBLE), ('storage', 0.000111::DOUBLE)) c(resource, rate)
LEFT JOIN (SELECT resource, sum(unit_hours) AS used FROM hours GROUP BY 1) h USING (resource)""",
    ),
}
