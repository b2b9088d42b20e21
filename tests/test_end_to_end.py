"""Manifest of archives to stored tables to answers."""

import gzip
import io
import json
import tarfile
import zipfile

from pyspark.sql import functions as F

from conftest import SF_DIR, rows
from locusdeck.functions.predicates import mentions, quality, rare
from locusdeck.operators import dedup
from locusdeck.operators.carriers import carriers
from locusdeck.operators.joins import locus_join
from locusdeck.plans import registry, render, views
from locusdeck.plans.catalogue import QUESTIONS
from locusdeck.plans.tables import Tables
from locusdeck.schemas import ANNOTATIONS, TABLES, VARIANTS
from locusdeck.streaming import ingest

SPECS = {name: spec.fitted(1) for name, spec in TABLES.items()}


def archives(spark, folder):
    """The samples' VCF files, alternately in zip and tar.gz archives of three samples each."""
    lines = {}
    for row in render.variant_records(views.variants(spark, SF_DIR)).collect():
        lines.setdefault(row["sample"], []).append(row["value"])
    files = {
        f"{sample}.vcf.gz": gzip.compress("\n".join([f"{render.HEADER}\t{sample}", *body, ""]).encode())
        for sample, body in sorted(lines.items())
    }
    names, paths = list(files), []
    for start in range(0, len(names), 3):
        members = {n: files[n] for n in names[start : start + 3]} | {"x.vcf.gz.tbi": b"index"}
        path = folder / f"a{start:02d}{'.zip' if start % 2 else '.tar.gz'}"
        if path.suffix == ".zip":
            with zipfile.ZipFile(path, "w") as archive:
                for name, content in members.items():
                    archive.writestr(name, content)
        else:
            with tarfile.open(path, "w:gz") as archive:
                for name, content in members.items():
                    entry = tarfile.TarInfo(name)
                    entry.size = len(content)
                    archive.addfile(entry, io.BytesIO(content))
        paths.append(str(path))
    return paths


def test_answers_from_ingested_archives(spark, plan, tmp_path):
    paths = archives(spark, tmp_path)
    manifest = tmp_path / "manifest.jsonl"
    manifest.write_text("\n\n".join(json.dumps({"path": p}) for p in reversed(paths)))
    targets = {n: str(tmp_path / n) for n in ("variants", "variants_by_sample", "annotations")}
    batches = ingest.ingest_manifest(spark, str(manifest), targets, files_per_batch=2, specs=SPECS)
    assert batches == -(-len(paths) // 2)

    variants = ingest.read_batches(spark, targets["variants"], SPECS["variants"])
    assert rows(variants.select(*VARIANTS.names)) == rows(views.variants(spark, SF_DIR))
    by_sample = ingest.read_batches(spark, targets["variants_by_sample"], SPECS["variants_by_sample"])
    assert by_sample.count() == variants.count() and "data_source" not in by_sample.columns

    # Every batch brings one annotation per locus; the dedup job makes them one in all.
    notes = ingest.read_batches(spark, targets["annotations"], SPECS["annotations"])
    loci = dedup.by_rank(notes.select(*ANNOTATIONS.names))
    assert notes.count() > loci.count() == loci.select("chrom", "pos", "ref", "alt").distinct().count()

    wanted = rare() & mentions("pathogenecity", "pathogenic")
    known = loci.filter(wanted).select(
        "chrom", "pos", "ref", "alt", "symbol", F.lower("pathogenecity").alias("pathogenicity")
    )
    joined = locus_join(variants.filter(quality()), known, layout=SPECS["variants"])
    groups = [F.col("a_symbol").alias("gene"), F.col("a_pathogenicity").alias("pathogenicity")]
    assert rows(carriers(joined, groups)) == rows(registry.QUERIES["S8"](spark, SF_DIR))

    # The named questions are functions of a cohort's own tables.
    mine = Tables(variants=variants, annotations=loci, variants_layout=SPECS["variants"])
    for name in ("Q1", "Q3", "Q4", "Q12", "Q18", "S1", "S10", "E1"):
        assert rows(QUESTIONS[name](mine)) == rows(registry.QUERIES[name](spark, SF_DIR)), name
    assert "contig_part" in plan(QUESTIONS["Q1"](mine)).split("PartitionFilters: [", 1)[1].split("]")[0]
