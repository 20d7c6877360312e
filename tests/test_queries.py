"""Every query against its SQL on DuckDB."""

from pathlib import Path

import pytest

import __spark_entry__ as driver
from keeprule.plans.oracle import ORACLE
from keeprule.plans.queries import QUERIES
from compare import connect, differences

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= driver.queries().items() and ORACLE.items() <= driver.oracle_sql().items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, tables, name):
    assert differences(QUERIES[name](spark, FOLDER), tables, ORACLE[name]) is None


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == ["gcId", "ret_policies_expired", "sup_policies_expired", "case_hold"]
    assert result.count() == result.select("gcId").distinct().count() > 0


def test_dense_and_sparse_counts_agree(spark):
    queries = QUERIES
    total = {
        name: queries[name](spark, FOLDER).agg({"expired_count": "sum"}).first()[0]
        for name in ("expired_dense", "expired_by_cluster_policy")
    }
    assert total["expired_dense"] == total["expired_by_cluster_policy"] > 0


def test_purge_splits_the_input(spark):
    queries = QUERIES
    plan = queries["purge_dry_run"](spark, FOLDER).first()
    assert plan["n_kept"] == queries["purge_kept"](spark, FOLDER).count()
    assert plan["n_kept"] + plan["n_removed"] == spark.read.parquet(f"{FOLDER}/lineitem.parquet").count()
