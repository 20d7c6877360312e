"""The plans: filters reach the scan, only needed columns are read, no all-pairs join, few shuffles."""

import re

import pytest

from keeprule.operators import counts, diff, exports, filters, flags, growth, purge
from keeprule.plans.queries import QUERIES
from keeprule.plans.views import INSTANT, Archive

FOLDER = "/root/testdata/sf0.001"


def plan_of(frame) -> str:
    return frame._sc._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")


def scans(plan: str) -> list[str]:
    return re.findall(r"\) Scan [^\n]*\n(?:[^\n]+\n)+", plan)


def scan_of(plan: str, name: str) -> str:
    return next(s for s in scans(plan) if f"/{name}" in s)


def shuffles(plan: str) -> int:
    return len(re.findall(r"^[ :+\-*]*Exchange \(", plan, re.M))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The collections as real tables, so that filters can be pushed to their columns."""
    folder, archive = str(tmp_path_factory.mktemp("tables")), Archive(spark, FOLDER)
    tables = {}
    for name in ("retention_policy_map", "retention_policies", "cluster", "archive_metrics", "held_items", "docs_by_oid",
                 "keyed_map", "chunks", "map_before", "map_after", "listed_ids"):
        getattr(archive, name).write.parquet(f"{folder}/{name}")
        tables[name] = spark.read.parquet(f"{folder}/{name}")
    return tables


@pytest.mark.parametrize("name", [n for n in QUERIES if "ingest" not in n and "incremental" not in n])
def test_no_query_compares_all_pairs(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    all_pairs = "CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan
    assert all_pairs == (name == "expired_dense")  # whose result is the cross product of two dimension tables
    assert "Python" not in plan


def test_flag_table_shuffles_once(stored):
    plan = plan_of(
        flags.flag_table(
            stored["retention_policy_map"], stored["retention_policies"], stored["held_items"], INSTANT, stored["archive_metrics"]
        )
    )
    assert shuffles(plan) == 1
    assert "ReadSchema: struct<gcId:string,policyId:string,startDate:timestamp_ntz>" in scan_of(plan, "retention_policy_map")
    assert "ReadSchema: struct<gcId:string>" in scan_of(plan, "archive_metrics")


def test_expired_counts_filter_at_the_scan(stored):
    rows, rules, clusters = (stored[n] for n in ("retention_policy_map", "retention_policies", "cluster"))
    plan = plan_of(counts.expired_counts(rows, rules, clusters, INSTANT))
    scan = scan_of(plan, "retention_policy_map")
    assert "LessThan(startDate" in scan and "struct<policyId:string,clusterId:string,startDate:timestamp_ntz>" in scan
    assert shuffles(plan) == 1
    one = scan_of(plan_of(counts.expired_count_of(rows, rules, "cl-1", "pol-7", INSTANT)), "retention_policy_map")
    for condition in ("EqualTo(clusterId,cl-1)", "EqualTo(policyId,pol-7)", "LessThan(startDate"):
        assert condition in one


def test_exports_filter_at_the_scan(stored):
    metrics = scan_of(plan_of(filters.open_records(stored["archive_metrics"]).select("_id")), "archive_metrics")
    assert "Or(IsNull(processing_state),Not(In(processing_state" in metrics and "struct<_id:string,processing_state:string>" in metrics
    page = plan_of(filters.page_after(stored["archive_metrics"], "_id", "am-2", 10).select("_id"))
    assert "GreaterThan(_id,am-2)" in page and "TakeOrderedAndProject" in page
    export = plan_of(exports.export_by_ids(stored["retention_policy_map"], stored["listed_ids"], "gcId", ["gcId", "channel"]))
    assert "struct<gcId:string,channel:string>" in scan_of(export, "retention_policy_map")


def test_growth_and_purge_filter_at_the_scan(stored):
    months = scan_of(plan_of(growth.growth_by_month(stored["docs_by_oid"], "1994-01-01", "1995-01-01")), "docs_by_oid")
    assert "GreaterThanOrEqual(_id" in months and "LessThanOrEqual(_id" in months
    kept = purge.purge_kept(stored["keyed_map"], filters.in_range("shard_key", 1, 5)).select("seq")
    assert "struct<shard_key:bigint,seq:int>" in scan_of(plan_of(kept), "keyed_map")


def test_chunk_rows_are_not_shuffled(stored):
    plan = plan_of(purge.chunk_inventory(stored["keyed_map"].select("shard_key", "seq"), stored["chunks"], "shard_key"))
    assert "BroadcastHashJoin" in plan
    assert "struct<shard_key:bigint,seq:int>" in scan_of(plan, "keyed_map")


def test_diff_gathers_nothing(stored):
    plan = plan_of(diff.assignment_diff(stored["map_before"], stored["map_after"]))
    assert "collect_list" not in plan and "Window" not in plan
    assert shuffles(plan) <= 4  # before adaptive execution reuses the counts


def test_fragments_are_checked_once_and_not_for_each_id(spark, tmp_path):
    orders = spark.range(2_000).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey", "'1-URGENT' AS o_orderpriority")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    found = QUERIES["file_documents"](spark, str(tmp_path))
    above, below = found._jdf.queryExecution().optimizedPlan().toString().split("Generate explode", 1)
    assert "array_sort" in below and "array_sort" not in above and "regexp" not in above
    assert found.groupBy("whole", "in_order").agg({"_id": "count"}).collect() == [(True, True, 2_000)]
