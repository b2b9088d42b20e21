from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_DIR, rows
from locusdeck.functions import minutes
from locusdeck.functions.classes import cohort_group, pathogenicity_class
from locusdeck.functions.predicates import f32, quality, rare
from locusdeck.operators import dedup, joins, usage
from locusdeck.operators.carriers import carriers, cohort_carriers, rows_by_annotation
from locusdeck.plans import operator_queries, render, views

QUICK = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


# --- predicates ---


def test_float_thresholds_compare_as_float(spark):
    df = spark.createDataFrame([(0.01,), (0.009,), (None,)], "gnomad_af float")
    assert df.filter(F.col("gnomad_af") < f32(0.01)).count() == 1
    assert df.filter(rare()).count() == 2


def test_quality_drops_unknown_filters(spark):
    data = [("0/1", 10, "PASS"), ("0/1", 10, None), ("0/0", 10, "PASS"), ("0/1", 9, "PASS"), ("0/1", 10, "LowQ;AC0"), (None, 10, "PASS")]
    df = spark.createDataFrame(data, "genotype string, read_depth int, filters string")
    assert df.filter(quality()).count() == 1


def test_classes(spark):
    df = spark.createDataFrame(
        [("Likely_benign", "ICGC-ARGO", "HIGH"), ("Pathogenic", "ICGC-ARGO", "LOW"), (None, "x-TCGA-y", None), ("benign", None, None)],
        "pathogenecity string, data_source string, vep_impact string",
    )
    found = df.select(pathogenicity_class(), cohort_group()).collect()
    assert [tuple(r) for r in found] == [
        ("likely_pathogenic", "cohort_A_high"), ("pathogenic", "cohort_A"), ("other", "cohort_B"), ("other", "full_cohort"),
    ]


# --- dedup ---

LOCI = st.lists(
    st.tuples(
        st.sampled_from(["chr1", "chr2", None]), st.integers(1, 2), st.sampled_from("AC"),
        st.sampled_from(["g1", "g2", None]), st.sampled_from(["HIGH", None]),
    ),
    min_size=1, max_size=25,
)
SHAPE = "chrom string, pos int, ref string, gene string, impact string"
KEYS = ("chrom", "pos", "ref")


def first_by_sorting(data, nulls):
    def place(value):
        return (value is None) == (nulls == "last"), value or ""

    best = {}
    for row in sorted(data, key=lambda r: (place(r[3]), place(r[4]))):
        best.setdefault(row[:3], row)
    return sorted(best.values(), key=repr)


@QUICK
@given(data=LOCI, nulls=st.sampled_from(["first", "last"]))
def test_dedup_forms_equal_a_sort(spark, data, nulls):
    df = spark.createDataFrame(data, SHAPE)
    expected = first_by_sorting(data, nulls)
    for form in (dedup.by_rank, dedup.by_minimum):
        found = form(df, keys=KEYS, nulls=nulls).select(*df.columns).collect()
        assert sorted((tuple(r) for r in found), key=repr) == expected


def test_first_seen_follows_the_given_order(spark):
    data = [("chr1", 1, "A", "late", 2, "f"), ("chr1", 1, "A", "early", 1, "f"), ("chr2", 1, "A", None, 9, "e")]
    df = spark.createDataFrame(data, "chrom string, pos int, ref string, gene string, line long, file string")
    found = dedup.first_seen(df, ("file", "line"), KEYS)
    assert found.columns == ["chrom", "pos", "ref", "gene"]
    assert sorted(tuple(r) for r in found.collect()) == [("chr1", 1, "A", "early"), ("chr2", 1, "A", None)]


def test_unseen_keeps_new_keys_only(spark):
    old = spark.createDataFrame([("chr1", 1, "A", "g")], "chrom string, pos int, ref string, gene string")
    new = spark.createDataFrame([("chr1", 1, "A", "h"), ("chr1", 2, "A", "h")], old.schema)
    assert [r["pos"] for r in dedup.unseen(new, old, KEYS).collect()] == [2]


def test_rank_is_limited_before_the_exchange(spark, plan):
    text = plan(dedup.by_rank(views.annotations(spark, SF_DIR)))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_null_order_must_be_known(spark):
    with pytest.raises(ValueError):
        dedup.by_rank(views.annotations(spark, SF_DIR), nulls="x")


# --- joins ---


def hot_fact(spark, rows_=4000):
    """A third of the rows on one key, one NULL key, the others spread."""
    return spark.range(rows_).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("k"),
        (F.col("id") % 7).alias("j"),
        "id",
    )


def dimension(spark):
    keys = [("hot",)] + [(f"k{i}",) for i in range(0, 500, 2)] + [(None,)]
    return spark.createDataFrame(keys, "k string").crossJoin(spark.range(7).select(F.col("id").alias("j"))).withColumn(
        "value", F.concat_ws("-", "k", F.col("j").cast("string"))
    )


@pytest.mark.parametrize("strategy", joins.STRATEGIES)
def test_strategies_give_the_same_rows(spark, strategy):
    fact, dim = hot_fact(spark), dimension(spark)
    expected = rows(fact.join(dim, ["k", "j"]))
    assert rows(joins.join_dimension(fact, dim, ["k", "j"], strategy)) == expected
    assert rows(joins.join_dimension(fact, dim, ["k", "j"], strategy, limit=0)) == expected


def test_hot_key_is_found_and_spread(spark):
    fact = hot_fact(spark).dropna()
    expected = spark.createDataFrame([("hot",)], "k string").select(F.xxhash64("k")).first()[0]
    assert joins.hot_keys(fact, ["k"], 8) == [expected]
    assert joins.hot_keys(fact.limit(0), ["k"], 8) == []
    joined = joins.salted_join(fact, dimension(spark).filter("j = 0").drop("j"), ["k"], 8)
    assert joined.filter("k = 'hot'").count() == fact.filter("k = 'hot'").count()


def test_hot_keys_are_split_at_run_time(spark, plan):
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    before = {name: spark.conf.get(name, None) for name in small}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        third = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))
        fact = spark.range(0, 200_000, 1, 8).select(third.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        dim = spark.range(-1, 200_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
        joined = joins.join_dimension(fact, dim, ["k"], limit=10)
        assert len(joined.collect()) == 200_000
        assert "SortMergeJoin(skew=true)" in plan(joined)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_broadcast_keeps_to_its_bound(spark, plan):
    # Spark's own threshold must not decide here.
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact, dim = hot_fact(spark), dimension(spark)
        assert "BroadcastHashJoin" in plan(joins.join_dimension(fact, dim, ["k", "j"], "broadcast"))
        assert "BroadcastHashJoin" in plan(joins.join_dimension(fact, dim, ["k", "j"]))
        beyond = plan(joins.join_dimension(fact, dim, ["k", "j"], "broadcast", limit=10))
        assert "SortMergeJoin" in beyond and "BroadcastHashJoin" not in beyond
        one = dim.filter("j = 0").drop("j")
        assert "_salt" in plan(joins.join_dimension(fact, one, ["k"], "salt"))
        assert "_salt" not in plan(joins.join_dimension(fact, one, ["k"], limit=10))
        shuffled = plan(joins.join_dimension(fact, dim, ["k", "j"], "shuffle"))
        assert "SortMergeJoin" in shuffled and "BroadcastHashJoin" not in shuffled
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_measured_bytes_cover_the_payload(spark):
    dim = dimension(spark).dropna()
    payload = sum(len(r["k"]) + len(r["value"]) + 8 for r in dim.collect())
    assert joins.measured_bytes(dim) > payload
    assert joins.measured_bytes(dim.limit(0)) == 0
    with pytest.raises(ValueError):
        joins.measured_bytes(views.variants(spark, SF_DIR))
    with pytest.raises(ValueError):
        joins.join_dimension(dim, dim, ["k"], "cross")


def test_joined_counts_multiply_pairs(spark):
    left = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 2.0), ("b", 1.0)], "k string, x double")
    right = spark.createDataFrame([("a",), ("a",), ("c",)], "k string")
    assert joins.joined_counts(left, right, ["k"], "x", "n").collect()[0]["n"] == 4
    assert joins.joined_counts(left, right.limit(0), ["k"], "x", "n").collect()[0]["n"] == 0


# --- carriers ---


def test_cohort_counts_equal_conditional_distinct_counts(spark, plan):
    df = spark.range(3000).select(
        F.concat(F.lit("g"), (F.col("id") % 5).cast("string")).alias("gene"),
        F.when(F.col("id") % 11 != 0, F.concat(F.lit("s"), (F.col("id") % 97).cast("string"))).alias("sample_name"),
        F.when(F.col("id") % 4 != 0, (F.col("id") % 3).cast("string")).alias("src"),
    )
    cohorts = {"a": F.col("src") == "1", "b": F.col("src").isin("0", "1")}
    found = cohort_carriers(df, ["gene"], cohorts)
    direct = df.groupBy("gene").agg(*[F.countDistinct(F.when(c, F.col("sample_name"))).alias(n) for n, c in cohorts.items()])
    assert rows(found) == rows(direct)
    assert "Expand" not in plan(found) and "Expand" in plan(direct)


@pytest.mark.parametrize("limit", [0, 10**9])
def test_counting_first_or_joining_first(spark, monkeypatch, limit):
    monkeypatch.setattr(joins.fits_broadcast, "__defaults__", (limit,))
    variants = views.variants(spark, SF_DIR)
    loci = dedup.by_rank(views.distinct_annotations(spark, SF_DIR)).select("chrom", "pos", "ref", "alt", "impact")
    found = [
        rows(rows_by_annotation(variants, loci, "impact", "n", first)) for first in (None, True, False)
    ]
    assert found[0] == found[1] == found[2]
    assert sum(n for _, n in found[0]) == variants.count()


def test_group_of_nameless_samples_stays(spark):
    df = spark.createDataFrame([("g", None, True)], "gene string, sample_name string, flag boolean")
    assert cohort_carriers(df, ["gene"], {"n": F.col("flag")}).collect()[0]["n"] == 0
    assert carriers(df, ["gene"], rows="n").collect()[0].asDict() == {"gene": "g", "n": 1, "carrier_count": 0}


# --- usage ---


def metrics(spark, *points):
    return spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, m, s), r, "Spark_Driver", "OnDemandCapacity", v) for m, s, r, v in points],
        "ts timestamp, resource string, worker_type string, capacity_type string, value double",
    )


def test_unit_hours_and_cost(spark):
    frame = metrics(spark, (0, 0, "vcpu", 4.0), (0, 30, "vcpu", 8.0), (1, 0, "vcpu", 6.0), (0, 0, "mem", 0.0), (9, 0, "vcpu", 100.0))
    per_minute = usage.minutes(frame, datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 5))
    assert {(r["resource"], r["minute"].minute): r["value"] for r in per_minute.collect()} == {("vcpu", 0): 6.0, ("vcpu", 1): 6.0, ("mem", 0): 0.0}
    hours = {r["resource"]: r["unit_hours"] for r in usage.unit_hours(per_minute).collect()}
    assert hours == {"vcpu": 0.2, "mem": 0.0}
    report = [(r["level"], r["resource"], r["unit_hours"]) for r in usage.rollup(per_minute).collect()]
    assert ("series", "mem", 0.0) not in report and ("resource", "mem", 0.0) in report and ("total", None, 0.2) in report
    cost = {r["resource"]: r["cost"] for r in usage.cost(per_minute, "us-east-1").collect()}
    assert cost == {"vcpu": 0.0104, "mem": 0.0, "storage": 0.0, "TOTAL": 0.0104}


def test_unknown_region_is_an_error(spark):
    with pytest.raises(ValueError, match="nowhere"):
        usage.cost(usage.minutes(metrics(spark, (0, 0, "vcpu", 1.0)), datetime(2024, 1, 1), datetime(2024, 1, 2)), "nowhere")


def test_minute_arithmetic(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 5, 6, 7),), (datetime(2024, 1, 1, 5, 6),)], "ts timestamp")
    found = df.select(minutes.floor_minute(F.col("ts")).alias("a"), minutes.ceil_minute(F.col("ts")).alias("b")).collect()
    assert found[0]["a"] == datetime(2024, 1, 1, 5, 6) and found[0]["b"] == datetime(2024, 1, 1, 5, 7)
    assert found[1]["a"] == found[1]["b"] == datetime(2024, 1, 1, 5, 6)
    assert minutes.parse_utc("2024-01-01 05:06") == datetime(2024, 1, 1, 5, 6)
    assert minutes.parse_utc("2024-01-01 05:06:07") == datetime(2024, 1, 1, 5, 6, 7)
    with pytest.raises(ValueError):
        minutes.parse_utc("yesterday")


def test_usage_range_reaches_the_scan(spark, plan):
    text = plan(usage.minutes(views.usage(spark, SF_DIR), datetime(2024, 1, 5), datetime(2024, 1, 10)))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text



def test_all_hot_keys_are_found(spark):
    rows = spark.range(3000).selectExpr("id % 1500 AS k")
    assert len(joins.hot_keys(rows, ["k"], 2000)) == 1500


def test_archives_are_packed_by_as_many_tasks_as_their_lines_ask_for(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(render, "ROWS_PER_PACKER", 500, raising=False)
    made, write = [], render.write_archives
    monkeypatch.setattr(render, "write_archives", lambda df, path: made.append(df.rdd.getNumPartitions()) or write(df, path))
    (tmp_path / "in").mkdir()
    for name in ("lineitem", "part"):
        (tmp_path / "in" / f"{name}.parquet").symlink_to(f"{SF_DIR}/{name}.parquet")
    source = str(tmp_path / "in")
    lines = operator_queries.archive_members(spark, source).count()
    assert lines == views.variants(spark, source).count()
    assert made == [views.source(spark, source, "lineitem").count() // 500]
