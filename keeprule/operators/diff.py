"""Which policy assignments are new in the state after, compared with the state before.

Both states are stacked and counted per (message, policy), so a message with very many
rows is reduced before the shuffle to at most one row per policy and task. The report
keeps that form, one row per message and policy; nothing is gathered per message.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keeprule.functions.text import or_empty
from keeprule.operators.lookups import lookup_join, policy_names


def assignment_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """``gcId, policyId, n_before, n_after``: how often each pair occurs on either side."""

    def side(rows: DataFrame, n_before: int, n_after: int) -> DataFrame:
        return rows.where(F.col("gcId").isNotNull()).select(
            "gcId",
            or_empty(F.col("policyId")).alias("policyId"),
            F.lit(n_before).cast("long").alias("n_before"),
            F.lit(n_after).cast("long").alias("n_after"),
        )

    return (
        side(before, 1, 0)
        .unionByName(side(after, 0, 1))
        .groupBy("gcId", "policyId")
        .agg(F.sum("n_before").alias("n_before"), F.sum("n_after").alias("n_after"))
    )


def assignment_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """``gcId, n_before, n_after, n_net_new``: totals of the messages that gained something.

    Messages that only occur after, or that gained nothing, are not reported.
    """
    return _gained(_with_new(assignment_counts(before, after)))


def _with_new(counts: DataFrame) -> DataFrame:
    new = F.when(F.col("n_before") == 0, F.col("n_after")).otherwise(F.lit(0).cast("long"))
    return counts.withColumn("n_new", new)


def _gained(counts: DataFrame) -> DataFrame:
    totals = counts.groupBy("gcId").agg(
        F.sum("n_before").alias("n_before"), F.sum("n_after").alias("n_after"), F.sum("n_new").alias("n_net_new")
    )
    return totals.where((F.col("n_before") > 0) & (F.col("n_net_new") > 0))


def assignment_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """``gcId, policyId, n_before, n_after, n_new, n_net_new`` of the messages that gained something.

    ``n_new`` are the copies of a policy that the message did not have before, ``n_net_new``
    is their sum over the message.
    """
    counts = _with_new(assignment_counts(before, after))
    return counts.join(_gained(counts).select("gcId", "n_net_new"), "gcId")


def assignment_diff_named(before: DataFrame, after: DataFrame, policies: DataFrame) -> DataFrame:
    """As ``assignment_diff`` with ``name``, which is the id where no name is known."""
    report = lookup_join(assignment_diff(before, after), policy_names(policies), "policyId", "left")
    return report.withColumn("name", F.coalesce("name", "policyId"))
