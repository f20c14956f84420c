"""Every registered query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as entry
from labelforge.plans.registry import QUERIES, SQL
from labelforge.plans.check import compare, connect

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, name):
    problem = compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF)
    if problem == "no rows on either side":  # some results need larger tables
        problem = compare(spark, connect(LARGER), entry.queries()[name], entry.oracle_sql()[name], LARGER)
    assert problem is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_words_around_links_exclude_only_some(spark, con):
    kept = QUERIES["page_links_outside_words"](spark, SF).groupBy("page_id").count().collect()
    every = QUERIES["page_links"](spark, SF).groupBy("page_id").count().collect()
    kept, every = ({r[0]: r[1] for r in x} for x in (kept, every))
    assert 0 < len(kept) < len(every) and not any(i % 4 == 0 for i in kept)
    assert any(kept[i] < every[i] for i in kept)
    assert 0 < con.execute(f"SELECT count(*) FROM ({SQL['page_links_outside_words']})").fetchone()[0] == sum(kept.values())
