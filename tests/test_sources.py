from datetime import datetime

import pytest

from locusdeck.sources import expression, manifest, usage_metrics
from locusdeck.schemas import TPM


def test_slice_notation():
    assert manifest.split_range("a/b.txt:::0-9999") == ("a/b.txt", (0, 9999))
    assert manifest.split_range("a/b.txt") == ("a/b.txt", None)
    assert manifest.split_range("s3://x/y.txt:::3-4") == ("s3://x/y.txt", (3, 4))


def test_manifest_counts_only_filled_lines(spark, tmp_path):
    path = tmp_path / "paths.txt"
    path.write_text('{"path": "s3://b/0.zip"}\n\n  \n{"path": "rel/1.zip"}\n{"path": "/abs/2.zip"}\n')
    found = {r["ordinal"]: r["path"] for r in manifest.read_manifest(spark, str(path)).collect()}
    assert found[0] == "s3://b/0.zip" and found[2] == "/abs/2.zip"
    assert found[1].startswith("/") and found[1].endswith("/rel/1.zip")
    part = manifest.read_manifest(spark, f"{path}:::1-5").collect()
    assert sorted(r["ordinal"] for r in part) == [1, 2]


def test_manifest_of_many_splits_is_numbered_through(spark, tmp_path):
    path = tmp_path / "long.txt"
    path.write_text("".join('{"path": "s3://b/%05d"}\n%s' % (i, "\n" * (i % 3)) for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        found = manifest.read_manifest(spark, str(path))
        assert found.rdd.getNumPartitions() >= 1
        assert all(int(r["path"][-5:]) == r["ordinal"] for r in found.collect())
        assert found.count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def write_csv(path, header, *lines):
    path.write_text("\n".join([",".join(header), *lines]) + "\n")
    return str(path)


def test_expression_columns_are_bound_by_name(spark, tmp_path):
    names = ["extra", *reversed(TPM.names)]
    a = write_csv(tmp_path / "a.csv", names, ",".join(["zz", *[f"{n}1" if n != "expression" else "1.5" for n in reversed(TPM.names)]]))
    b = write_csv(tmp_path / "b.csv", TPM.names, ",".join(["NA" if n == "tissue" else "nan" if n == "expression" else f"{n}2" for n in TPM.names]))
    found = {r["sample_id"]: r for r in expression.read_tpm(spark, [a, b]).collect()}
    assert expression.read_tpm(spark, a).schema == TPM
    assert found["sample_id1"]["expression"] == 1.5 and found["sample_id1"]["unit"] == "unit1"
    assert found["sample_id2"]["expression"] is None and found["sample_id2"]["tissue"] is None


def test_bad_numbers_and_missing_columns_fail(spark, tmp_path):
    bad = write_csv(tmp_path / "bad.csv", TPM.names, ",".join("oops" for _ in TPM.names))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        expression.read_tpm(spark, bad).collect()
    short = write_csv(tmp_path / "short.csv", ["sample_id"], "S1")
    with pytest.raises(ValueError, match="lacks columns"):
        expression.read_tpm(spark, short)


def test_differing_headers_in_one_path_fail(spark, tmp_path):
    write_csv(tmp_path / "1.csv", TPM.names, ",".join("1" for _ in TPM.names))
    write_csv(tmp_path / "2.csv", list(reversed(TPM.names)), ",".join("1" for _ in TPM.names))
    with pytest.raises(Exception):
        expression.read_tpm(spark, str(tmp_path)).collect()


def test_usage_window_is_widened_to_minutes(spark):
    frame = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, m, s), "vcpu", "Spark_Driver", "PreInitCapacity", 1.0) for m, s in
         [(0, 59), (1, 0), (1, 30), (2, 59), (3, 0)]],
        "ts timestamp, resource string, worker_type string, capacity_type string, value double",
    )
    found = usage_metrics.between(frame, datetime(2024, 1, 1, 0, 1, 30), datetime(2024, 1, 1, 0, 2, 10))
    assert sorted((r["ts"].minute, r["ts"].second) for r in found.collect()) == [(1, 0), (1, 30), (2, 59)]
    other = spark.createDataFrame([(datetime(2024, 1, 1), "disk", "x", "y", 1.0)], frame.schema)
    assert usage_metrics.billed(other).count() == 0
