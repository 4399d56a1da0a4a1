"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import pytest

from hirelake.plans import catalog, oracle
from tests import compare

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


def test_every_query_has_sql():
    assert set(oracle.oracle_sql()) == set(catalog.queries())


@pytest.mark.parametrize("name", catalog.queries())
def test_matches_sql(spark, con, name):
    assert compare.types(spark, FOLDER, con, name) == {}
    assert compare.spark_rows(spark, FOLDER, name) == compare.oracle_rows(con, name)
