"""Every registered query against its SQL; those without SQL must give rows."""

import os

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from churnkit.plans.catalogue import ORACLES, QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in ORACLES:
        assert compare(spark, con, name, QUERIES[name], ORACLES[name], FOLDER) == []
    else:
        assert QUERIES[name](spark, FOLDER).count() > 0


def test_only_trained_models_have_no_sql():
    assert set(QUERIES) - set(ORACLES) == {"ml_train_score", "ml_cross_validate", "ml_importance", "ml_explain"}


def test_entry(spark):
    assert entry.entry(spark).count() > 0
