"""Properties over generated inputs, and one run without the package on the workers."""

import os
import subprocess
import sys
from pathlib import Path

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from locusdeck.functions.layout_keys import with_layout_keys
from locusdeck.functions.predicates import region
from locusdeck.plans import render
from locusdeck.schemas import VARIANTS, Identity, TableSpec, Truncate
from locusdeck.sources.vcf import parse_variants

QUICK = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

WORD = st.text(alphabet="abcXYZ019_.&", min_size=1, max_size=8).filter(lambda w: w != ".")
MAYBE = st.one_of(st.none(), WORD)
POSITION = st.integers(1, 2**31 - 100)
NUMBER = st.one_of(st.none(), st.integers(0, 10**6))
FRACTION = st.one_of(st.none(), st.floats(0, 1, width=32))

RECORD = st.tuples(
    st.sampled_from(["S1", "S2"]), st.sampled_from(["chr1", "X"]), POSITION, st.sampled_from(["A", "ACG"]),
    st.sampled_from(["C", "<DEL>"]), st.one_of(st.none(), st.floats(0, 1e6)), st.sampled_from(["PASS", "LowQ;AC0", None]),
    st.sampled_from(["0/1", "1|1", "./.", "1"]), NUMBER, st.lists(st.integers(0, 99), min_size=1, max_size=3), NUMBER,
    FRACTION, FRACTION, MAYBE, MAYBE, MAYBE, MAYBE, FRACTION, FRACTION, MAYBE, MAYBE, MAYBE, MAYBE,
)


@QUICK
@given(data=st.lists(RECORD, min_size=1, max_size=15))
def test_rendered_records_are_parsed_back(spark, data):
    full = [(*r[:3], r[2] + len(r[3]) - 1, *r[3:]) for r in data]
    frame = spark.createDataFrame(full, VARIANTS)
    back = parse_variants(render.as_lines(render.variant_records(frame)))
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in VARIANTS]
    assert rows(back) == rows(frame)


@QUICK
@given(
    positions=st.lists(st.integers(-50, 5000), min_size=1, max_size=30),
    low=st.integers(-60, 5000), span=st.integers(0, 3000), width=st.integers(1, 1500), half_open=st.booleans(),
)
def test_pruned_regions_keep_every_row(spark, positions, low, span, width, half_open):
    spec = TableSpec("t", VARIANTS, (Identity("contig", "contig_part"), Truncate("pos_start", width)), ())
    frame = spark.createDataFrame([("chr1", p) for p in positions] + [("chr2", 1)], "contig string, pos_start int")
    keyed = with_layout_keys(frame, spec)
    how = {"half_open": half_open}
    plain = keyed.filter(region("chr1", low, low + span, **how))
    pruned = keyed.filter(region("chr1", low, low + span, layout=spec, **how))
    assert rows(plain) == rows(pruned)
    inside = [p for p in positions if low <= p and (p < low + span if half_open else p <= low + span)]
    assert sorted(r["pos_start"] for r in plain.collect()) == sorted(inside)


def test_python_workers_need_no_copy_of_the_package(tmp_path):
    """Functions for Python workers travel with the job, as executors have no such folder."""
    code = f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parent.parent)!r})
from locusdeck.session import local_session
import __spark_entry__ as entry
spark = local_session(2, **{{"spark.driver.memory": "2g", "spark.checkpoint.dir": {str(tmp_path)!r}}})
for name in ("archive_members", "sorted_check"):
    print(name, entry.queries()[name](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert "archive_members 6000" in done.stdout and "sorted_check 1" in done.stdout


def test_salt_keeps_null_keys_out(spark):
    from locusdeck.operators.joins import salted_join

    fact = spark.range(300).select(F.when(F.col("id") % 2 == 0, F.lit("hot")).alias("k"), "id")
    dim = spark.createDataFrame([("hot", 1), (None, 2)], "k string, v int")
    found = salted_join(fact, dim, ["k"], 8)
    assert found.count() == 150 and found.filter("k is null").count() == 0
