"""Every registered query against its SQL counterpart in a second engine."""

import os

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from helpers import SMALL

ROOT = os.environ.get("TEST_SF_DIR", SMALL)
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(ROOT)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    without = {n for n in set(QUERIES) - set(ORACLE) if n != "pipeline" and not n.startswith("op")}
    assert without == {"ml_train_rf", "ml_train_gbt"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    assert differences(spark, con, ROOT, name, QUERIES[name], ORACLE[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 10
