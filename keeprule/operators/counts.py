"""Expired assignments counted per cluster and policy."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keeprule.operators.lookups import policy_names
from keeprule.operators.policies import checked_thresholds


def active_tenants(tenancy: DataFrame) -> DataFrame:
    """Tenants whose reports may run: active, and with a tenant uuid."""
    return tenancy.where((F.col("status") == "active") & F.col("tenantuuid").isNotNull())


def if_tenant_active(rows: DataFrame, tenancy: DataFrame, tenant: str) -> DataFrame:
    """All rows when the tenant is active, none otherwise."""
    return rows.where(active_tenants(tenancy).where(F.col("_id") == tenant).exists())


def expired_counts(
    assignments: DataFrame,
    policies: DataFrame,
    clusters: DataFrame,
    instant: str | datetime,
    midnight: bool = True,
) -> DataFrame:
    """``clusterId, policyId, expired_count`` for each pair that has expired assignments.

    Counting comes before the restriction to known clusters: the counts are few, so
    the large table is only joined to the thresholds.
    """
    thresholds = checked_thresholds(policies, instant, midnight)
    expired = thresholds.expired(assignments.select("clusterId", "policyId", "startDate"))
    counts = expired.groupBy("clusterId", "policyId").agg(F.count("*").alias("expired_count"))
    return counts.join(clusters.select(F.col("_id").alias("clusterId")), "clusterId", "left_semi")


def with_policy_names(counts: DataFrame, policies: DataFrame) -> DataFrame:
    """Add ``name`` to counts per policy, empty where the policy has none."""
    return counts.join(policy_names(policies), "policyId", "left").withColumn("name", F.coalesce("name", F.lit("")))


def expiry_report(assignments, policies, clusters, instant, midnight: bool = True) -> DataFrame:
    """The expired counts with the policy's name."""
    return with_policy_names(expired_counts(assignments, policies, clusters, instant, midnight), policies)


def all_pairs(clusters: DataFrame, policies: DataFrame) -> DataFrame:
    """Every known cluster with every known policy: the cross product of two dimension tables is the result."""
    cluster_ids = clusters.select(F.col("_id").alias("clusterId")).where(F.col("clusterId").isNotNull()).distinct()
    policy_ids = policies.select("policyId").where(F.col("policyId").isNotNull()).distinct()
    return cluster_ids.crossJoin(policy_ids)


def expired_counts_dense(assignments, policies, clusters, instant, midnight: bool = True) -> DataFrame:
    """As ``expired_counts``, with a row also for pairs that have nothing expired."""
    counts = expired_counts(assignments, policies, clusters, instant, midnight)
    return (
        all_pairs(clusters, policies)
        .join(counts, ["clusterId", "policyId"], "left")
        .withColumn("expired_count", F.coalesce("expired_count", F.lit(0)).cast("long"))
    )


def expired_count_of(
    assignments: DataFrame,
    policies: DataFrame,
    cluster_id: str,
    policy_id: str,
    instant: str | datetime,
    midnight: bool = True,
) -> DataFrame:
    """One row ``expired_count`` for one cluster and policy; all conditions reach the scan."""
    rows = assignments.where((F.col("clusterId") == cluster_id) & (F.col("policyId") == policy_id))
    one = checked_thresholds(policies.where(F.col("policyId") == policy_id), instant, midnight)
    return one.expired(rows.select("policyId", "startDate")).agg(F.count("*").alias("expired_count"))
