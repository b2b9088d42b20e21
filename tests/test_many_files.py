import gzip
import json

import pytest
from pyspark.sql import functions as F

from locusdeck.schemas import TABLES
from locusdeck.sources import files, vcf
from locusdeck.sources.archives import read_vcf_records
from locusdeck.streaming import ingest
from test_vcf import put, record, text

SPECS = {name: spec.fitted(1) for name, spec in TABLES.items()}
HEAD = b"##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS\n"


def test_lines_of_many_gzip_files_are_not_joined_to_headers(spark, tmp_path, monkeypatch, plan):
    paths = [put(tmp_path, f"{i}.vcf.gz", text(f"S{i}", record(pos="1"), record(pos="2"))) for i in range(12)]
    monkeypatch.setattr(vcf, "BROADCAST_FILES", 5)
    found = read_vcf_records(spark, paths)
    text_of_plan = plan(found)
    assert "Join" not in text_of_plan and "xxhash64" not in text_of_plan
    assert found.inputFiles() == []  # nor does the driver hold the files' index
    assert {r["header_sample"]: r["n"] for r in found.groupBy("header_sample").agg(F.count("*").alias("n")).collect()} == {
        f"S{i}": 2 for i in range(12)
    }


def test_gzip_lines_are_those_of_sparks_reader(spark, tmp_path, monkeypatch):
    bodies = {
        "a b.vcf.gz": HEAD + b"1\t2\n\n3\t4",
        "é+%20#x.vcf.gz": HEAD.replace(b"\n", b"\r\n") + b"x\r\ny\rz\r\n\r\n",
        "bom.vcf.gz": b"\xef\xbb\xbf" + HEAD + b"q\n",
        "bad.vcf.gz": HEAD + b"a\xff\xfeb\n",
        "empty.vcf.gz": b"",
        "none.vcf.gz": b"r1\nr2\n",
        "cr.vcf.gz": HEAD + b"a\rb\r",
        "_hidden.vcf.gz": HEAD + b"no\n",
        "_k=1.vcf.gz": HEAD + b"yes\n",
        "late.vcf.gz": HEAD + b"a\x00b\n#late\nlast\n",
        "~t,;@&=$!'().vcf.gz": HEAD + b"t\n",
        "long.vcf.gz": HEAD + b"".join(b"%d\t%s\r\n" % (i, b"x" * 20) for i in range(2000)),
    }
    for name, body in bodies.items():
        half = len(body) // 2
        (tmp_path / name).write_bytes(gzip.compress(body[:half]) + gzip.compress(body[half:]))
    monkeypatch.setattr(vcf, "PIECE", 1000)
    paths = [str(tmp_path / name) for name in bodies]
    shown = ["file_path", "file_name", F.hex("value"), "block", "header_sample"]
    order = lambda df: sorted(map(tuple, df.select(*shown).collect()), key=repr)
    mine = read_vcf_records(spark, paths)
    assert order(mine) == order(vcf.records(vcf.read_lines(spark, paths), len(paths), vcf.heads(spark, paths)))
    long = mine.filter(F.col("file_name") == "long.vcf.gz").orderBy("line_no").collect()
    assert [int(r["value"].split("\t")[0]) for r in long] == list(range(2000))
    with pytest.raises(Exception, match="gone.vcf.gz"):
        read_vcf_records(spark, [str(tmp_path / "gone.vcf.gz")]).collect()


def test_files_are_dealt_by_their_length():
    paths, sizes = list("abcdef"), [5, 100, 40, 40, 1, 30]
    assert vcf.dealt(paths, sizes, 80, 10) == [["b"], ["c", "d"], ["f", "a", "e"]]
    assert vcf.dealt([], [], 80) == []


def test_a_stream_carries_lists_of_names(spark, tmp_path):
    source = tmp_path / "in"
    for i in range(7):
        (source / f"file={i}" / "x").mkdir(parents=True)
        put(source / f"file={i}" / "x", f"{i} é.vcf.gz", text(f"S{i}", record(pos="1")))
    (source / "_draft").mkdir()
    put(source / "_draft", "no.vcf.gz", text("no", record(pos="1")))
    put(source, "top.vcf.gz", text("top", record(pos="1")))
    targets, checkpoint = {"variants": str(tmp_path / "variants")}, tmp_path / "c"
    run = lambda: ingest.ingest_folder(spark, str(source), targets, str(checkpoint), 3, specs=SPECS)
    assert run() == 3
    entries = [json.loads(line)["path"] for log in (checkpoint / "sources/0").glob("[0-9]*") for line in log.read_text().splitlines()[1:]]
    assert len(entries) == 3  # one for each batch, not one for each file
    lists = sorted((checkpoint / ingest.LISTS).glob("*.json"))
    assert [len(p.read_text().splitlines()) for p in lists] == [3, 3, 2]
    put(source / "file=3", "late.vcf.gz", text("late", record(pos="1")))
    assert run() == 1 and run() == 0
    stored = ingest.read_batches(spark, targets["variants"], SPECS["variants"])
    assert sorted(r["sample_name"] for r in stored.collect()) == sorted([*[f"S{i}" for i in range(7)], "top", "late"])


def test_listed_files_are_those_that_spark_lists(spark, tmp_path):
    for name in ("a/b c/x.gz", "a/_no/x.gz", "a/_k=1/.x", "a/_k=1/y", "z", ".h", "a/e", "_metadata"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("" if name == "a/e" else "1")
    for folder in (str(tmp_path), f"{tmp_path}/a", f"{tmp_path}/*"):
        names = {r["path"] for r in files.file_list(spark, folder).collect()}
        assert {r["path"] for r in files.listed(spark, folder).collect()} == names
    with pytest.raises(FileNotFoundError):
        files.listed(spark, f"{tmp_path}/none")


def test_samples_are_counted_before_rows_are_dealt_to_regions(spark, tmp_path, monkeypatch):
    rows = [record(chrom=f"chr{c}", pos="1") for c in range(1, 6)]
    paths = [put(tmp_path, f"{s}.vcf.gz", text(s, *rows)) for s in "ABC"]
    targets = {n: str(tmp_path / n) for n in ("variants", "annotations")}
    write, seen = ingest.write_table, []

    def watched(df, spec, path, **how):
        seen.extend(str(column) for column in how["observe"][1])
        write(df, spec, path, **how)

    monkeypatch.setattr(ingest, "write_table", watched)
    ingest.write_batch(spark, 1, paths, targets, SPECS)
    # A writing task has rows of most samples: their names would come to the driver from every task.
    assert seen and not any("collect_set" in column for column in seen)
    assert [(r["rows"], r["samples"]) for r in ingest.batch_totals(spark, targets["variants"]).collect()] == [(15, 3)]
    assert [(r["rows"], r["samples"]) for r in ingest.batch_totals(spark, targets["annotations"]).collect()] == [(5, None)]


def test_a_batch_without_rows_is_stored_with_no_samples(spark, tmp_path):
    path = put(tmp_path, "A.vcf.gz", text("A"))
    targets = {n: str(tmp_path / n) for n in ("variants", "annotations")}
    ingest.write_batch(spark, 1, [path], targets, SPECS)
    assert [(r["rows"], r["samples"]) for r in ingest.batch_totals(spark, targets["variants"]).collect()] == [(0, 0)]
    ingest.write_batch(spark, 1, [path], {"variants": targets["variants"]}, SPECS)
    assert [(r["rows"], r["samples"]) for r in ingest.batch_totals(spark, targets["variants"]).collect()] == [(0, 0)]


def test_paths_of_a_batch_are_packed_for_the_tasks(spark):
    paths = [f"file:/data/cohort/variants/file=S{i}-0/part-0.txt.gz" for i in range(5000)]
    found = files.dealt_paths(spark, [paths[:3000], paths[3000:]])
    rows = found.collect()
    assert found.rdd.getNumPartitions() == 2 and sum(len(r["paths"]) for r in rows) * 5 < sum(map(len, paths))
