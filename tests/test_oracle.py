from __future__ import annotations

import pytest
from check_oracle import difference, open_tables

import __spark_entry__ as entry
from repopulse.sample.oracle import SQL
from repopulse.sample.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return open_tables(sf_dir)


def test_every_query_has_sql_but_the_models():
    assert set(QUERIES) - set(SQL) == {"breakout_scores", "ai_insights"}
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_its_sql(spark, con, sf_dir, name):
    assert difference(spark, con, name, sf_dir) in ("", "no rows")


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name, rows", [("breakout_scores", 15), ("ai_insights", 5)])
def test_models_score_the_sample(spark, sf_dir, name, rows):
    assert entry.queries()[name](spark, sf_dir).count() == rows
