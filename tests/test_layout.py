import glob
from dataclasses import replace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import SF_DIR, rows
from locusdeck.functions.layout_keys import bucket_of, bucketed, truncated
from locusdeck.functions.predicates import of_samples, region, region_keys
from locusdeck.operators import dedup, layout
from locusdeck.operators.joins import locus_join
from locusdeck.plans import views
from locusdeck.schemas import (
    ANNOTATIONS_TABLE, TABLES, VARIANTS, VARIANTS_BY_SAMPLE, VARIANTS_TABLE, Bucket, Identity, TableSpec, Truncate,
)
from locusdeck.session import once, shared_folder
from locusdeck.sources.tables import catalog_table, folders_of, kept_layout, read_table, stored_layout

SMALL = TableSpec(
    name="variants",
    schema=VARIANTS,
    partition_by=(Identity("contig", "contig_part"), Truncate("pos_start", 100_000_000), Bucket("sample_name", 2, "sample_bucket")),
    sort_by=("pos_start", "ref", "alt"),
    bloom=("ref", "vep_symbol"),
)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layout") / "variants")
    layout.write_table(views.variants(spark, SF_DIR), SMALL, path)
    return path


def test_declared_tables():
    assert len(VARIANTS) == 24 and len(VARIANTS_BY_SAMPLE) == 22
    assert {n: len(s.schema) for n, s in TABLES.items()} == {
        "variants": 24, "annotations": 11, "annotations_dedup": 11, "variants_by_sample": 22, "tpm": 11, "cnv": 16,
    }
    for spec in TABLES.values():
        names = set(spec.schema.names)
        assert {k.column for k in spec.partition_by} <= names
        assert set(spec.sort_by) <= names and set(spec.bloom) <= names


def test_fitted_layout_follows_the_size():
    assert VARIANTS_TABLE.fitted(10**14) == VARIANTS_TABLE
    small = VARIANTS_TABLE.fitted(10**6)
    assert small.key(Bucket).count == 1 and small.key(Truncate).width >= 250_000_000
    middle = VARIANTS_TABLE.fitted(24 * 10 * VARIANTS_TABLE.target_file_bytes)
    assert middle.key(Truncate).width % 5_000_000 == 0
    assert 5_000_000 < middle.key(Truncate).width < 250_000_000


def test_fitted_layout_keeps_the_least_parts():
    small = VARIANTS_TABLE.fitted(1, least=4)
    assert small.key(Bucket).count == 4 and 250_000_000 / small.key(Truncate).width > 3
    assert VARIANTS_TABLE.fitted(10**14, least=4) == VARIANTS_TABLE


def test_layout_is_kept_with_the_table(spark, tmp_path):
    path = str(tmp_path / "grown")
    fine = SMALL.with_layout(VARIANTS_TABLE.fitted(1, least=4).layout_text())
    assert kept_layout(spark, path, SMALL) is None and stored_layout(spark, path, SMALL) == SMALL
    assert SMALL.with_layout(SMALL.layout_text()) == SMALL
    variants = views.variants(spark, SF_DIR)
    layout.write_table(variants.filter("genotype = '0/0'"), SMALL, path)
    with pytest.raises(ValueError, match="is stored by"):
        layout.write_table(variants.filter("genotype <> '0/0'"), fine, path)
    layout.write_table(variants.filter("genotype <> '0/0'"), stored_layout(spark, path, fine), path)
    # A reader that only knows the declared layout finds every row.
    found = stored_layout(spark, path, VARIANTS_TABLE)
    assert found.partition_by == SMALL.partition_by
    back = read_table(spark, path, found).select(*VARIANTS.names, *found.partition_names)
    for where, plain in (
        (region("chr7", 100_000_000, 200_000_000, layout=found), region("chr7", 100_000_000, 200_000_000)),
        (of_samples(["S1", "S2"], layout=found), of_samples(["S1", "S2"])),
    ):
        assert rows(back.filter(where).select(*VARIANTS.names)) == rows(variants.filter(plain))
    # Overwriting the whole table may change its layout.
    layout.write_table(variants, fine, path, mode="overwrite")
    assert stored_layout(spark, path, VARIANTS_TABLE).partition_by == fine.partition_by


def test_shared_tables_follow_their_input(spark, tmp_path):
    made = []
    make = lambda path: made.append(path) or path
    (tmp_path / "a").write_text("1")
    first = once(spark, str(tmp_path), "t", make)
    assert once(spark, str(tmp_path), "t", make) == first
    (tmp_path / "a").write_text("12")
    assert once(spark, str(tmp_path), "t", make) != first and len(made) == 2


def test_expression_pairs_take_any_gene(spark, tmp_path):
    for table in ("lineitem", "supplier"):
        spark.read.parquet(f"{SF_DIR}/{table}.parquet").write.parquet(str(tmp_path / f"{table}.parquet"))
    parts = spark.read.parquet(f"{SF_DIR}/part.parquet")
    changed = parts.withColumn("p_brand", F.when(F.col("p_partkey") % 10 == 0, "Brand#26").otherwise(F.col("p_brand")))
    changed.write.parquet(str(tmp_path / "part.parquet"))
    assert views.tpm(spark, str(tmp_path)).filter("gene_symbol = 'GENE_26'").count() > 0


def test_truncation_floors_and_buckets_agree(spark):
    df = spark.createDataFrame([(-1,), (0,), (4_999_999,), (5_000_000,)], "p int")
    assert [r[0] for r in df.select(truncated("p", 5_000_000)).collect()] == [-5_000_000, 0, 0, 5_000_000]
    names = spark.createDataFrame([("S1",), (None,)], "s string")
    found = names.select(bucketed("s", 16), bucket_of("S1", 16)).collect()
    assert found[0][0] == found[0][1] and 0 <= found[1][0] < 16


def test_round_trip_and_order(spark, stored):
    back = read_table(spark, stored, SMALL)
    assert rows(back.select(*VARIANTS.names)) == rows(views.variants(spark, SF_DIR))
    checked = layout.sort_violations(back, SMALL).collect()
    assert sum(r["n"] for r in checked) == back.count()
    assert all(r["violations"] == 0 for r in checked)


def test_partition_keys_prune(spark, stored, plan):
    back = read_table(spark, stored, SMALL)
    pruned = back.filter(region("chr7", 1, 150_000_000, layout=SMALL))
    text = plan(pruned)
    part = text[text.index("PartitionFilters"):].split("]")[0]
    assert "contig_part" in part and "pos_trunc" in part
    assert rows(pruned) == rows(back.filter(region("chr7", 1, 150_000_000)))
    half = back.filter(region("chr7", 1, 100_000_001, half_open=True, layout=SMALL))
    assert rows(half) == rows(back.filter("contig = 'chr7' AND pos_start >= 1 AND pos_start < 100000001"))
    samples = back.filter(of_samples(["S1", "S2"], layout=SMALL))
    text = plan(samples)
    assert "sample_bucket" in text[text.index("PartitionFilters"):].split("]")[0]
    assert rows(samples) == rows(back.filter("sample_name in ('S1', 'S2')")) and samples.count()


def test_join_prunes_by_the_loci_that_are_left(spark, stored, plan):
    back = read_table(spark, stored, SMALL)
    loci = dedup.by_rank(views.distinct_annotations(spark, SF_DIR)).filter("chrom = 'chr7' or symbol = 'TP53'")
    small = loci.select("chrom", "pos", "ref", "alt", "symbol")
    joined = locus_join(back, small, layout=SMALL)
    text = plan(joined)
    assert "dynamicpruning" in text[text.index("PartitionFilters"):].split("ReadSchema")[0]
    names = [*VARIANTS.names, "a_symbol"]
    for strategy in ("auto", "shuffle", "salt"):
        found = locus_join(back, small, strategy, layout=SMALL)
        assert rows(found.select(*names)) == rows(locus_join(back, small).select(*names))
    assert joined.count()


def test_half_open_bound_on_a_border(spark, stored):
    back = read_table(spark, stored, SMALL)
    found = back.filter(region("chr7", 100_000_000, 200_000_000, half_open=True, layout=SMALL))
    assert found.select("pos_trunc").distinct().count() <= 1
    assert found.count() == back.filter("contig='chr7' and pos_start >= 100000000 and pos_start < 200000000").count()


def test_disorder_is_found(spark, tmp_path):
    spec = TableSpec("t", VARIANTS, (), ("pos_start", "ref", "alt"))
    base = views.variants(spark, SF_DIR).filter("pos_start is not null")
    wrong = base.coalesce(1).sortWithinPartitions(F.col("pos_start").desc())
    path = str(tmp_path / "wrong")
    wrong.write.parquet(path)
    (found,) = layout.sort_violations(spark.read.parquet(path), spec).collect()
    positions = [r[0] for r in wrong.select("pos_start").collect()]
    assert found["violations"] >= len(set(positions)) - 1 > 0


def test_disorder_between_splits_and_nulls(spark, tmp_path):
    spec = TableSpec("t", VARIANTS, (), ("pos_start", "ref", "alt"))
    data = [(1, "A", None), (1, "A", "C"), (2, None, "A"), (None, "A", "A"), (3, "A", "A")]
    frame = spark.createDataFrame(data, "pos_start int, ref string, alt string").coalesce(1)
    path = str(tmp_path / "nulls")
    frame.write.parquet(path)
    (found,) = layout.sort_violations(spark.read.parquet(path), spec).collect()
    # (1,A,NULL) before (1,A,C), and (NULL,..) before (3,..): NULLs belong last.
    assert (found["n"], found["violations"]) == (5, 2)
    big = str(tmp_path / "big")
    two = spark.range(40_000).select(
        F.when(F.col("id") < 20_000, F.col("id")).otherwise(F.col("id") - 20_000).cast("int").alias("pos_start"),
        F.lit("A").alias("ref"), F.sha2(F.col("id").cast("string"), 256).alias("alt"),
    )
    two.coalesce(1).write.option("parquet.block.size", str(200_000)).parquet(big)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        frame = spark.read.parquet(big)
        assert frame.select(F.col("_metadata.file_block_start")).distinct().count() > 3
        (found,) = layout.sort_violations(frame, spec).collect()
        assert (found["n"], found["violations"]) == (40_000, 1)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_bloom_filters_are_written(spark, tmp_path):
    sizes = []
    for name, bloom in (("with", ("alt",)), ("without", ())):
        spec = TableSpec("t", VARIANTS, (), ("pos_start",), bloom=bloom)
        # Dictionary-encoded columns need no filter, so the column has to be diverse.
        diverse = views.variants(spark, SF_DIR).withColumn("alt", F.sha2(F.concat_ws("-", "sample_name", "qual"), 256))
        layout.write_table(diverse.unionByName(diverse.withColumn("alt", F.sha2("alt", 256))), spec, str(tmp_path / name))
        sizes.append(sum(len(open(f, "rb").read()) for f in glob.glob(str(tmp_path / name / "*.parquet"))))
    assert sizes[0] > sizes[1]


def test_hot_partition_is_cut_into_pieces(spark, tmp_path):
    spec = TableSpec("t", VARIANTS, (Identity("contig", "contig_part"),), ("pos_start",), target_file_bytes=20_000)
    one = views.variants(spark, SF_DIR).withColumn("contig", F.lit("chr1"))
    path = str(tmp_path / "hot")
    layout.write_table(one.unionByName(one).unionByName(one).repartition(8), spec, path)
    assert len(glob.glob(f"{path}/contig_part=chr1/*.parquet")) > 1
    assert read_table(spark, path, spec).count() == 3 * one.count()


def test_catalog_tables(spark, tmp_path):
    annotations = views.distinct_annotations(spark, SF_DIR)
    layout.create_table(spark, ANNOTATIONS_TABLE.fitted(1), "notes", location=str(tmp_path / "notes"))
    layout.insert_into(annotations, ANNOTATIONS_TABLE.fitted(1), "notes")
    assert rows(catalog_table(spark, "notes", ANNOTATIONS_TABLE)) == rows(annotations)
    layout.insert_into(annotations.limit(3), ANNOTATIONS_TABLE.fitted(1), "notes")
    assert catalog_table(spark, "notes", ANNOTATIONS_TABLE).count() == annotations.count() + 3
    layout.drop_table(spark, "notes")
    assert not spark.catalog.tableExists("notes")
    layout.drop_table(spark, "notes")
    spark.range(1).write.saveAsTable("foreign_table")
    with pytest.raises(ValueError):
        layout.drop_table(spark, "foreign_table")
    spark.sql("DROP TABLE foreign_table")


def test_iceberg_text():
    text = layout.create_table_sql(VARIANTS_TABLE, "lake.variants", using="iceberg")
    assert "PARTITIONED BY (`contig`, truncate(5000000, `pos_start`), bucket(16, `sample_name`))" in text
    assert "'write.target-file-size-bytes' = '268435456'" in text and "contig_part" not in text
    order = layout.sort_order_sql(VARIANTS_TABLE, "lake.variants")
    assert order.endswith("ORDERED BY `pos_start` ASC NULLS LAST, `ref` ASC NULLS LAST, `alt` ASC NULLS LAST")


def test_range_order_is_total(spark):
    spread = layout.ranged(views.variants(spark, SF_DIR).select("contig", "pos_start"), ["contig", "pos_start"], 4)
    found = [tuple(r) for r in spread.collect()]
    assert found == sorted(found)


class _Session:
    """A session as ``shared_folder`` sees it."""

    def __init__(self, master, setting=None):
        folder = []
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: setting or default)})
        self.sparkContext = type(
            "Context",
            (),
            {
                "master": master,
                "getCheckpointDir": staticmethod(lambda: folder[0] if folder else None),
                "setCheckpointDir": staticmethod(folder.append),
            },
        )


def test_written_tables_go_where_the_cluster_says(tmp_path):
    assert shared_folder(_Session("spark://host:1", "hdfs://lake/tmp/")) == "hdfs://lake/tmp"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(_Session("spark://host:1"))
    local = _Session("local[2]")
    assert shared_folder(local) == shared_folder(local) != ""


def test_create_as_select(spark, tmp_path):
    spec = replace(VARIANTS_TABLE, partition_by=(Identity("contig", "contig_part"), Bucket("sample_name", 4, "sample_bucket")))
    rows = views.variants(spark, SF_DIR)
    for name in ("made_as", "made_bad"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    place = str(tmp_path / "made")
    layout.create_table_as(rows, spec, "made_as", location=place)
    assert sorted(map(repr, catalog_table(spark, "made_as", spec).collect())) == sorted(map(repr, rows.select(*spec.schema.names).collect()))
    assert layout.sort_violations(spark.read.parquet(place), spec).agg(F.sum("violations")).first()[0] == 0
    assert spark.sql("SHOW TBLPROPERTIES made_as").filter("key = 'locusdeck.table'").count() == 1
    with pytest.raises(AnalysisException):
        layout.create_table_as(rows, spec, "made_as", location=place)
    # A select that fails leaves no table behind, and the name is free.
    bad = rows.withColumn("read_depth", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        layout.create_table_as(bad, spec, "made_bad", location=str(tmp_path / "bad"))
    assert not spark.catalog.tableExists("made_bad")
    layout.create_table_as(rows.limit(5), spec, "made_bad", location=str(tmp_path / "bad"))
    assert spark.table("made_bad").count() == 5
    layout.drop_table(spark, "made_as")
    layout.drop_table(spark, "made_bad")


def test_file_sizes_of_a_skewed_table(spark, tmp_path):
    spec = replace(VARIANTS_TABLE, partition_by=(Identity("contig", "contig_part"),), target_file_bytes=150_000)
    rows = views.variants(spark, SF_DIR)
    hot = rows.withColumn("contig", F.when(F.rand(3) < 0.7, "chr1").otherwise(F.col("contig")))
    more = hot.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(12)))).withColumn("pos_start", F.col("pos_start") + F.col("copy") * 31)
    path = str(tmp_path / "t")
    layout.write_table(more.repartition(16), spec, path)
    found = {r["contig_part"]: r for r in layout.file_sizes(read_table(spark, path, spec), spec).collect()}
    assert sum(r["rows"] for r in found.values()) == rows.count() * 12
    assert found["chr1"]["files"] > 3 and all(r["oversized"] == 0 for r in found.values()), found["chr1"]
    assert layout.file_sizes(read_table(spark, path, spec), replace(spec, target_file_bytes=100)).agg(F.min("oversized")).first()[0] > 0


def test_a_region_lists_its_folders_only(spark, tmp_path):
    spec = replace(VARIANTS_TABLE, partition_by=(Identity("contig", "contig_part"), Truncate("pos_start", 20_000_000), Bucket("sample_name", 2, "b")))
    assert region_keys("chr7", 25_000_000, 60_000_000, spec) == [("chr7", 20_000_000), ("chr7", 40_000_000), ("chr7", 60_000_000)]
    assert region_keys("chr7", 0, 1, TABLES["variants_by_sample"]) is None
    rows = views.variants(spark, SF_DIR).withColumn("contig", F.concat(F.col("contig"), F.lit(":x %")))
    path = str(tmp_path / "t")
    layout.write_table(rows, spec, path)
    keys = region_keys("chr7:x %", 25_000_000, 60_000_000, spec)
    part = read_table(spark, path, spec, folders=folders_of(spark, path, spec, keys))
    assert {tuple(r) for r in part.select("contig_part", "pos_trunc").distinct().collect()} <= set(keys)
    where = region("chr7:x %", 25_000_000, 60_000_000, layout=spec)
    assert part.filter(where).count() == rows.filter(region("chr7:x %", 25_000_000, 60_000_000)).count() > 0
    assert len(part.inputFiles()) < len(read_table(spark, path, spec).inputFiles()) / 10
    assert folders_of(spark, path, spec, [("nowhere", 0), (None, 0)]) == []


def test_bloom_filters_skip_row_groups(spark, tmp_path):
    """A look-up of an absent symbol reads few row groups, as small filters err at times; without them it reads all."""
    scanned, conf = {}, spark._jsc.hadoopConfiguration()
    for bloom in (SMALL.bloom, ()):
        spec, path = replace(SMALL, bloom=bloom), str(tmp_path / f"t{len(bloom)}")
        # Filters are written for columns with too many values for a dictionary; here, for all.
        conf.set("parquet.enable.dictionary", "false")
        try:
            layout.write_table(views.variants(spark, SF_DIR), spec, path)
        finally:
            conf.unset("parquet.enable.dictionary")
        found = read_table(spark, path, spec).filter(F.col("vep_symbol") == "GENE_1x")  # between the least and the largest symbol
        assert found.collect() == []
        leaf = found._jdf.queryExecution().executedPlan().collectLeaves().head()
        scanned[bool(bloom)] = leaf.metrics().get("numOutputRows").get().value()
    assert scanned[False] > 3000 and scanned[True] < scanned[False] / 8, scanned


def test_a_writing_task_gets_no_more_than_it_can_sort(spark, tmp_path, monkeypatch):
    for spec in TABLES.values():
        size = layout.file_sized(spec)["spark.sql.adaptive.advisoryPartitionSizeInBytes"]
        assert int(size) <= 128 * 1024 * 1024
    monkeypatch.setattr(layout, "SORTED_BYTES", 60_000)
    spec = replace(VARIANTS_TABLE, partition_by=(Identity("contig", "contig_part"),))
    one = views.variants(spark, SF_DIR).withColumn("contig", F.lit("chr1")).repartition(8)
    path = str(tmp_path / "pieces")
    layout.write_table(one, spec, path)
    assert len(glob.glob(f"{path}/contig_part=chr1/*.parquet")) > 1
    assert rows(read_table(spark, path, spec).select("sample_name", "pos_start", "qual")) == rows(one.select("sample_name", "pos_start", "qual"))
    assert layout.sort_violations(read_table(spark, path, spec), spec).agg(F.sum("violations")).first()[0] == 0
