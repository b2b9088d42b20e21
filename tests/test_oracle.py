"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry
from conftest import SF_DIR, rows
from locusdeck.plans import registry

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


def test_every_twin_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(registry.QUERIES) <= set(QUERIES)
    # The corpus queries, which may be left out, are held against brute force in their own tests.
    assert set(registry.QUERIES) <= set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equal(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLE[name])
    names = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(range(len(names)), key=names.__getitem__)
    expected = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=repr)
    assert [repr(r) for r in rows(df)] == [repr(r) for r in expected]
    assert expected


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["gene", "pathogenecity", "carrier_count"]
    assert df.count() == 2


@pytest.mark.parametrize(
    "single, joined",
    [("Q7", "S1"), ("Q9", "S2"), ("Q10", "S3"), ("Q15", "S8"), ("Q17", "S10"), ("Q18", "S11")],
)
def test_single_table_and_joined_forms_agree(spark, single, joined):
    assert rows(QUERIES[single](spark, SF_DIR)) == rows(QUERIES[joined](spark, SF_DIR))


def test_region_or_gene_without_broadcast(spark, monkeypatch):
    expected = rows(QUERIES["S10"](spark, SF_DIR))
    monkeypatch.setattr("locusdeck.plans.catalogue.fits_broadcast", lambda df: False)
    monkeypatch.setattr("locusdeck.operators.joins.fits_broadcast", lambda df, limit=0: False)
    assert rows(QUERIES["S10"](spark, SF_DIR)) == expected
    assert rows(QUERIES["S8"](spark, SF_DIR)) == rows(QUERIES["Q15"](spark, SF_DIR))


def test_counted_forms_agree(spark):
    per_class = {tuple(r) for r in QUERIES["Q12"](spark, SF_DIR).collect()}
    assert per_class == {tuple(r) for r in QUERIES["S5"](spark, SF_DIR).collect()}
    per_gene = {tuple(r) for r in QUERIES["Q13"](spark, SF_DIR).collect()}
    assert per_gene == {tuple(r) for r in QUERIES["S6"](spark, SF_DIR).collect()}


def test_order_of_reports(spark):
    counts = [r["variant_count"] for r in QUERIES["Q11"](spark, SF_DIR).collect()]
    assert counts == sorted(counts, reverse=True)
    classes = [r["pathogenecity"] for r in QUERIES["Q12"](spark, SF_DIR).collect()]
    assert classes[-1] is None and classes[:-1] == sorted(classes[:-1])
