"""Per-message verdicts: all policies expired, and held by a case.

All inputs of the flag table are keyed by message id, so they are stacked and
grouped once. Partial aggregation runs before that single shuffle, hence an id with
very many rows sends one row per task. No join is needed after the threshold lookup.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keeprule.operators.policies import Thresholds, checked_thresholds, not_supervision, is_supervision

KEY = "gcId"


def unique_ids(*tables: DataFrame, key: str = KEY) -> DataFrame:
    """The distinct ids of one or more tables, without NULL."""
    stacked = tables[0].select(key)
    for table in tables[1:]:
        stacked = stacked.unionByName(table.select(key))
    return stacked.where(F.col(key).isNotNull()).distinct()


def _assignment_marks(assignments: DataFrame, thresholds: Thresholds) -> DataFrame:
    """Per assignment whether it keeps its message alive, by kind of policy.

    An unknown policy or a missing start never does.
    """
    joined = thresholds.join_to(assignments.select(KEY, "policyId", "startDate"), "left")
    alive = F.coalesce(F.col("startDate") >= F.col("threshold"), F.lit(False))
    return joined.select(
        KEY,
        F.lit(True).alias("evaluated"),
        (alive & ~F.col("supervision")).alias("ret_active"),
        (alive & F.col("supervision")).alias("sup_active"),
        F.col("startDate").isNull().cast("long").alias("null_starts"),
    )


def _verdict(applies: Column, bad: Column, if_bad: str, otherwise: str) -> Column:
    return F.when(applies, F.when(bad, if_bad).otherwise(otherwise))


def _holds(case_items: DataFrame) -> DataFrame:
    """Message and hold flag of case items, nested as they are stored or from flat files, where the flag may be text."""
    key = "documentKey.gcid" if "documentKey" in case_items.columns else "gcid"
    held = F.coalesce(F.col("holdFlag").try_cast("boolean"), F.lit(False))
    return case_items.select(F.col(key).alias(KEY), held.alias("held"))


def _marks_per_id(assignments, thresholds, case_items=None, more_ids=()) -> DataFrame:
    rows = _assignment_marks(assignments, thresholds)
    for ids in more_ids:
        rows = rows.unionByName(ids.select(KEY, F.lit(True).alias("evaluated")), allowMissingColumns=True)
    if case_items is not None:
        holds = _holds(case_items)
        rows = rows.unionByName(holds, allowMissingColumns=True)
    else:
        rows = rows.withColumn("held", F.lit(None).cast("boolean"))
    return (
        rows.where(F.col(KEY).isNotNull())
        .groupBy(KEY)
        .agg(
            F.bool_or("evaluated").alias("evaluated"),
            F.bool_or("ret_active").alias("ret_active"),
            F.bool_or("sup_active").alias("sup_active"),
            F.bool_or("held").alias("held"),
            F.sum("null_starts").alias("null_starts"),
        )
    )


def _with_verdicts(marks: DataFrame) -> DataFrame:
    return marks.select(
        KEY,
        _verdict(F.col("evaluated"), F.col("ret_active"), "N", "Y").alias("ret_policies_expired"),
        _verdict(F.col("evaluated"), F.col("sup_active"), "N", "Y").alias("sup_policies_expired"),
        _verdict(F.col("held").isNotNull(), F.col("held"), "Y", "N").alias("case_hold"),
        F.coalesce("null_starts", F.lit(0)).cast("long").alias("null_starts"),
    )


def flag_table(
    assignments: DataFrame,
    policies: DataFrame,
    case_items: DataFrame,
    instant: str | datetime,
    *more_ids: DataFrame,
) -> DataFrame:
    """One row per message: ``gcId, ret_policies_expired, sup_policies_expired, case_hold``.

    A message without assignments has all policies expired. One that only occurs in
    case items has no policy verdict; one without case items has no hold verdict.
    """
    marks = _marks_per_id(assignments, checked_thresholds(policies, instant), case_items, more_ids)
    return _with_verdicts(marks).drop("null_starts")


def flag_totals(
    assignments: DataFrame,
    policies: DataFrame,
    case_items: DataFrame,
    instant: str | datetime,
    *more_ids: DataFrame,
) -> DataFrame:
    """Totals of the flag table, and how many assignments lack a start."""
    marks = _marks_per_id(assignments, checked_thresholds(policies, instant), case_items, more_ids)
    ret, sup = F.col("ret_policies_expired"), F.col("sup_policies_expired")
    return _with_verdicts(marks).agg(
        F.count(ret).alias("evaluated"),
        F.count_if(ret == "Y").alias("ret_expired"),
        F.count_if(ret == "N").alias("ret_active"),
        F.count_if(sup == "Y").alias("sup_expired"),
        F.count_if(sup == "N").alias("sup_active"),
        F.count_if(F.col("case_hold") == "Y").alias("held"),
        F.coalesce(F.sum("null_starts"), F.lit(0)).alias("null_starts"),
    )


def policy_flags(
    assignments: DataFrame,
    policies: DataFrame,
    instant: str | datetime,
    column: str,
    *more_ids: DataFrame,
) -> DataFrame:
    """The verdict ``column`` of every message against just the given policies."""
    thresholds = checked_thresholds(policies, instant)
    marks = _marks_per_id(assignments, thresholds, None, more_ids)
    alive = F.col("ret_active") | F.col("sup_active")
    return marks.select(KEY, F.when(alive, "N").otherwise("Y").alias(column))


def both_flags(assignments, policies, instant, *more_ids) -> DataFrame:
    """Both policy verdicts in one pass over the assignments."""
    marks = _marks_per_id(assignments, checked_thresholds(policies, instant), None, more_ids)
    return _with_verdicts(marks).drop("case_hold", "null_starts")


def retention_flags(assignments, policies, instant, *more_ids) -> DataFrame:
    return policy_flags(assignments, policies.where(not_supervision()), instant, "ret_policies_expired", *more_ids)


def supervision_flags(assignments, policies, instant, *more_ids) -> DataFrame:
    return policy_flags(assignments, policies.where(is_supervision()), instant, "sup_policies_expired", *more_ids)


def case_holds(case_items: DataFrame) -> DataFrame:
    """``gcId, case_hold``: Y if any case item of the message has its hold flag set."""
    return (
        _holds(case_items)
        .where(F.col(KEY).isNotNull())
        .groupBy(KEY)
        .agg(F.when(F.max("held"), "Y").otherwise("N").alias("case_hold"))
    )


def verdict_totals(column: str) -> list[Column]:
    """Aggregates that count the evaluated, expired and active rows of a verdict column."""
    return [
        F.count(column).alias("evaluated"),
        F.count_if(F.col(column) == "Y").alias("expired"),
        F.count_if(F.col(column) == "N").alias("active"),
    ]
