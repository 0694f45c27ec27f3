import pytest

import __spark_entry__ as entry
from bidtrail.plans.queries import _scored_leads
from check import compare, connect, type_differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    frame, want = entry.queries()[name](spark, SF), db.sql(entry.oracle_sql()[name])
    assert type_differences(frame, want) == []
    assert compare(frame.toPandas(), want.df()) == "ok"


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_titles_all_classified(spark):
    assert entry.queries()["classify_titles"](spark, SF).where("adds_up AND larger_wins").count() == 87


def test_lead_scores_differ_between_rows(spark):
    scored = _scored_leads(spark, SF)
    assert scored.count() > 900 and scored.select("true_prob").distinct().count() > 100
