"""Retention policies and the instant before which each one lets a message expire."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keeprule.functions.instants import (
    PERIOD_UNITS,
    instant_as,
    instant_literal,
    period_unit,
    shift_back,
    shift_back_to_midnight,
    with_instant,
)
from keeprule.operators.lookups import fits_broadcast, lookup_join

SUPERVISION = "supervision"


def is_supervision() -> Column:
    return F.col("sourceType").eqNullSafe(SUPERVISION)


def not_supervision() -> Column:
    """Also true for a policy without a source type."""
    return ~is_supervision()


def policy_thresholds(policies: DataFrame, instant: str | datetime, midnight: bool = False) -> DataFrame:
    """The policies with their ``threshold``: a start before it is expired, on it active."""
    shift = shift_back_to_midnight if midnight else shift_back
    threshold = shift(instant_literal(instant), F.col("retentionPeriod"), F.col("unitOfPeriod"))
    return policies.withColumn("threshold", threshold)


@dataclass(frozen=True)
class Thresholds:
    """One row per policy: ``policyId, threshold, supervision``; ``small`` if it may be broadcast.

    ``latest`` is the last of the thresholds, None without policies.
    """

    frame: DataFrame
    small: bool
    latest: datetime | None

    def join_to(self, rows: DataFrame, how: str) -> DataFrame:
        """Give each row the threshold of its policy, in the time type of ``startDate``; text becomes UTC instants."""
        rows = with_instant(rows, "startDate")
        time_type = rows.schema["startDate"].dataType
        frame = self.frame.withColumn("threshold", instant_as(F.col("threshold"), time_type))
        return lookup_join(rows, frame, "policyId", how, self.small)

    def expired(self, rows: DataFrame) -> DataFrame:
        """The rows that start before the threshold of their policy.

        No row from the latest threshold on can be expired; that condition reaches the scan.
        """
        if self.latest is None:
            return self.join_to(rows, "inner")
        rows = with_instant(rows, "startDate")
        latest = instant_as(instant_literal(self.latest), rows.schema["startDate"].dataType)
        early = rows.where(F.col("startDate") < latest)
        return self.join_to(early, "inner").where(F.col("startDate") < F.col("threshold"))


def checked_thresholds(policies: DataFrame, instant: str | datetime, midnight: bool = False) -> Thresholds:
    """Thresholds ready for joining, after one small job that checks the policies.

    The job refuses policies without a known unit or period before any message is
    read, and measures the table. Should a policy id occur several times, its
    longest retention counts.
    """
    usable = period_unit(F.col("unitOfPeriod")).isin(*PERIOD_UNITS) & F.col("retentionPeriod").isNotNull()
    table = policy_thresholds(policies.where(F.col("policyId").isNotNull()), instant, midnight).select(
        "policyId",
        "threshold",
        is_supervision().alias("supervision"),
        F.coalesce(usable, F.lit(False)).alias("usable"),
    )
    check = table.agg(
        F.count("*").alias("rows"),
        F.count_distinct("policyId").alias("ids"),
        F.coalesce(F.sum(F.octet_length("policyId") + 32), F.lit(0)).alias("size"),
        F.count_if(~F.col("usable")).alias("unusable"),
        F.max("threshold").alias("latest"),
    ).first()
    if check["unusable"]:
        raise ValueError(f"{check['unusable']} policies have no period or a unit other than {', '.join(PERIOD_UNITS)}")
    frame = table.drop("usable")
    if check["ids"] < check["rows"]:
        frame = frame.groupBy("policyId").agg(
            F.min("threshold").alias("threshold"), F.bool_or("supervision").alias("supervision")
        )
    return Thresholds(frame, fits_broadcast(check["rows"], check["size"]), check["latest"])
