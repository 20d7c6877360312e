"""Event logs: documents that hold a JSON array of events in a text column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keeprule.functions.instants import epoch_millis_text
from keeprule.functions.text import json_objects, or_empty

# Event fields that are not reported.
UNREPORTED_FIELDS = ("tenantid", "ver")


def explode_events(log: DataFrame, fields=None) -> DataFrame:
    """``_id, event``: one row per event, as a map, or as a struct of the given fields.

    Documents with unreadable events give none.
    """
    return log.select("_id", F.explode(json_objects(F.col("events"), fields)).alias("event")).where(
        F.col("event").isNotNull()
    )


def unreadable_events(log: DataFrame) -> DataFrame:
    """Documents whose events text is not a JSON array of objects."""
    return log.where(F.col("events").isNotNull() & json_objects(F.col("events")).isNull())


def event_fields(log: DataFrame) -> DataFrame:
    """``name``: all field names over all events, once each, without the unreported ones."""
    return (
        explode_events(log)
        .select(F.explode(F.map_keys("event")).alias("name"))
        .where(~F.col("name").isin(*UNREPORTED_FIELDS))
        .distinct()
    )


def found_fields(log: DataFrame) -> list[str]:
    """The names of all reported fields, sorted, from one aggregation that merges the schemas of all events."""
    merged = explode_events(log).agg(F.schema_of_variant_agg(F.to_variant_object("event"))).first()[0]
    if not merged or not merged.startswith("OBJECT<"):
        return []
    names = T.DataType.fromDDL(merged.replace("OBJECT<", "STRUCT<", 1)).names
    return sorted(set(names) - {"_id", "_tm", *UNREPORTED_FIELDS})


def event_table(log: DataFrame, origin: str, tenant: str) -> DataFrame:
    """As ``event_rows`` with a column for every reported field that any event of the log has."""
    return event_rows(log, origin, tenant, found_fields(log))


def event_rows(log: DataFrame, origin: str, tenant: str, fields: list[str] | None = None) -> DataFrame:
    """The events of one origin and tenant as rows: ``_id``, ``_tm`` as text, then the fields.

    Named fields become columns, empty where an event lacks them. Without ``fields`` the
    column ``event`` holds all reported fields of the event as a map. A missing time is the
    epoch, an unreadable one is empty.
    """
    shown = [name for name in fields or () if name not in ("_id", "_tm")]
    parsed = sorted({"origin", "tenantid", "_tm", *shown})
    if fields is None or len({name.lower() for name in parsed}) < len(parsed):
        parsed = None  # names that differ only in case are told apart in a map, not in a struct
    event = F.col("event")
    time = or_empty(epoch_millis_text(F.coalesce(event["_tm"], F.lit("0"))))
    if fields is None:
        columns = [F.map_filter(event, lambda name, _: ~name.isin("_id", "_tm", *UNREPORTED_FIELDS)).alias("event")]
    else:
        columns = [or_empty(event[name]).alias(name) for name in shown]
    return (
        explode_events(log, parsed)
        .where((event["origin"] == origin) & (event["tenantid"] == tenant))
        .select(F.col("_id").cast("string").alias("_id"), time.alias("_tm"), *columns)
    )
