"""Filtered exports with their totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from keeprule.operators.filters import project
from keeprule.operators.lookups import rows_in_list


def export_by_ids(
    rows: DataFrame, ids: DataFrame, key: str, fields: list[str], id_column: str | None = None
) -> DataFrame:
    """The given fields of the rows whose key is listed."""
    return project(rows_in_list(rows, ids, key, id_column), fields)


def observed_export(
    rows: DataFrame, ids: DataFrame, key: str, fields: list[str], id_column: str | None = None
) -> tuple[DataFrame, Observation]:
    """The export, with its rows counted while it is written; see ``rows_written``."""
    written = Observation("rows_written")
    export = export_by_ids(rows, ids, key, fields, id_column)
    return export.observe(written, F.count("*").alias("rows_written")), written


def rows_written(written: Observation) -> int:
    """The count of an export that was written. An export found empty while planning has no metric: 0."""
    try:
        return written.get["rows_written"]
    except AssertionError:
        return 0


def export_totals(rows: DataFrame, ids: DataFrame, key: str, id_column: str | None = None) -> DataFrame:
    """One row ``ids_given, ids_found, rows_written`` for an export by ids.

    ``ids_given`` counts the list as it is; ``ids_found`` counts distinct ids with rows.
    """
    per_id = rows_in_list(rows.select(key), ids, key, id_column).groupBy(key).agg(F.count("*").alias("n"))
    none = F.lit(0).cast("long")
    found = per_id.agg(
        none.alias("ids_given"), F.count("*").alias("ids_found"), F.coalesce(F.sum("n"), none).alias("rows_written")
    )
    given = ids.agg(F.count(id_column or key).alias("ids_given"), none.alias("ids_found"), none.alias("rows_written"))
    return found.unionByName(given).agg(*[F.sum(c).alias(c) for c in found.columns])


def remaining_units(units: DataFrame, finished: DataFrame, unit: str) -> DataFrame:
    """The units of work that a restarted job still has to do."""
    return units.select(unit).distinct().join(finished.select(unit), unit, "left_anti")
