"""Every registered query against its oracle on the smallest given tables."""

import os

import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries
from oracle.catalog import ORACLE
from tidemark.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are not here")
# Iterative models have no SQL form.
ROWS_ONLY = {"topic_terms", "topic_terms_tfidf", "phrase_topics", "document_topics", "recommender_folds", "recommender_topn"}


@pytest.fixture(scope="module")
def duck():
    return check.connect(FOLDER)


def test_names():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY and set(oracle_sql()) <= set(queries()) and set(QUERIES) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ROWS_ONLY))
def test_matches_oracle(spark, duck, name):
    result = check.compare(spark, duck, FOLDER, name)
    assert result.startswith("ok"), result
