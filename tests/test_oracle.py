"""Every SQL-expressible registered query equals its DuckDB oracle on sf0.001."""

import os

import pytest

from lexis.plans.registry import ORACLE, QUERIES, load_all
from lexis.plans.verify import check, duck

load_all()
# Whole searches take minutes; their contracts are in test_search.py, and
# LEXIS_SLOW=1 (or lexis.plans.verify) runs them here too.
SLOW = {"stage1_job", "stage2_job", "search_vectorizer", "search_model", "search_svm"}
FAST = sorted(k for k in ORACLE if k not in SLOW or os.environ.get("LEXIS_SLOW"))


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("key", FAST)
def test_query_matches_oracle(spark, sf, con, key):
    r = check(spark, sf, key, con)
    assert r["rows"] == r["oracle_rows"], r
    assert r["schema_ok"], r
    assert r["values_ok"], r


def test_every_query_has_a_docstring_or_oracle():
    for k, fn in QUERIES.items():
        assert fn.__doc__ or k in ORACLE, k
