"""Every registered query against its SQL counterpart."""

import re

import pytest

import __spark_entry__ as entry
import oracle

# the corpus queries, where they are installed, have tests of their own
OTHERS = re.compile(r"op\d+_|pipeline$")
QUERIES = {name: query for name, query in entry.queries().items() if not OTHERS.match(name)}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if not OTHERS.match(name)}
NO_SQL = {
    "course_popularity_approx",      # sketch; bounded by approx_error_check
    "stream_popularity_approx",      # sketch; bounded by stream_approx_check
    "recommendations_top5",          # factorisation; facts in recommendation_check
    "recommendations_unseen_top5",   # factorisation; facts in recommendation_unseen_check
}


@pytest.fixture(scope="module")
def db(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_sql_but_the_listed_ones():
    assert set(QUERIES) - set(SQL) == NO_SQL
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, db, name):
    assert oracle.differences(QUERIES[name](spark, sf_dir), db, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(NO_SQL))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == [
        "course_code", "window_start", "timestamp", "active_users", "engagement_score",
        "total_popularity"]
    assert frame.count() > 0
