"""Rows out of text that is almost JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keeprule.functions.instants import epoch_millis_text
from keeprule.functions.text import flat_objects, json_objects, or_empty, shell_to_json, strip, text_struct, unwrap_array

# The fields of a policy dump, in report order.
POLICY_FIELDS = (
    "retentionPeriod",
    "unitOfPeriod",
    "expiryAction",
    "storeType",
    "sourceType",
    "name",
    "category",
    "createdDate",
    "scope",
    "lastUpdated",
    "enabled",
)


def shell_objects(texts: DataFrame, column: str = "value") -> DataFrame:
    """One row ``object`` per flat ``{...}`` found in the text; other columns are kept."""
    others = [c for c in texts.columns if c != column]
    return texts.select(*others, F.explode(flat_objects(F.col(column))).alias("object"))


def _parsed_objects(objects: DataFrame, fields) -> DataFrame:
    """Add ``fields``, a struct of the fields, with the object itself in ``unreadable`` if it is no JSON.

    The struct comes out of an explode, below which a filter on it is not repeated: each
    object is parsed once.
    """
    schema = text_struct([*fields, "unreadable"])
    parsed = F.from_json(shell_to_json(F.col("object")), schema, {"columnNameOfCorruptRecord": "unreadable"})
    return objects.withColumn("fields", F.explode(F.array(parsed)))


def object_rows(objects: DataFrame, fields=POLICY_FIELDS) -> DataFrame:
    """The fields of each shell object as text columns; a missing one is empty.

    Objects that are no JSON give no row; ``unreadable_objects`` lists them.
    """
    others = [c for c in objects.columns if c != "object"]
    readable = _parsed_objects(objects, fields).where(F.col("fields.unreadable").isNull())
    return readable.select(*others, *[or_empty(F.col("fields")[name]).alias(name) for name in fields])


def unreadable_objects(objects: DataFrame, fields=POLICY_FIELDS) -> DataFrame:
    return _parsed_objects(objects, fields).where(F.col("fields.unreadable").isNotNull()).drop("fields")


def shell_dump_rows(texts: DataFrame, column: str = "value", fields=POLICY_FIELDS) -> DataFrame:
    """The flat objects of shell dumps as rows of text columns."""
    return object_rows(shell_objects(texts, column), fields)


def array_rows(texts: DataFrame, fields: list[str], column: str = "value", time_field: str = "StartDate") -> DataFrame:
    """Rows of arrays written as ``{[...]}``; the time field turns from epoch milliseconds to text."""
    others = [c for c in texts.columns if c != column]
    item = F.col("item")

    def value(name: str) -> Column:
        return epoch_millis_text(item[name]) if name == time_field else item[name]

    return texts.select(*others, F.explode(json_objects(unwrap_array(F.col(column)), fields)).alias("item")).select(
        *others, *[or_empty(value(name)).alias(name) for name in fields]
    )


def item_rows(parsed: DataFrame, fields: list[str], time_field: str = "StartDate") -> DataFrame:
    """The fields of parsed objects (``sources.objects``) as text; what is no JSON gives no row."""
    others = [c for c in parsed.columns if c not in ("item", "unreadable")]
    item = F.col("item")
    shown = [(epoch_millis_text(item[f]) if f == time_field else item[f], f) for f in fields]
    return parsed.where(F.col("unreadable").isNull()).select(*others, *[or_empty(c).alias(f) for c, f in shown])


def item_ids(parsed: DataFrame, field: str = "gcid") -> DataFrame:
    """One row per parsed object that has an id."""
    others = [c for c in parsed.columns if c not in ("item", "unreadable")]
    ids = parsed.where(F.col("unreadable").isNull()).select(*others, F.col("item")[field].alias(field))
    return ids.where(F.col(field).isNotNull())


def unreadable_arrays(texts: DataFrame, column: str = "value") -> DataFrame:
    """The texts that give no rows because they are no array of objects even when unwrapped."""
    return texts.where(F.col(column).isNotNull() & json_objects(unwrap_array(F.col(column))).isNull())


def _id_objects(text: Column) -> Column:
    objects = F.regexp_replace(strip(text), r"^,+|,+$", "")
    wrapped = F.concat(F.lit("["), objects, F.lit("]"))
    ids = F.from_json(wrapped, "array<struct<gcid:string>>")["gcid"]
    return F.filter(ids, lambda i: i.isNotNull())


def id_list(texts: DataFrame, column: str = "value") -> DataFrame:
    """Replace text of comma-separated ``{'gcid': ...}`` objects by the array ``gcids``."""
    return texts.withColumn("gcids", _id_objects(F.col(column))).drop(column)


def id_rows(texts: DataFrame, column: str = "value") -> DataFrame:
    """One row ``gcid`` per object that has one, for lists spread over many lines."""
    others = [c for c in texts.columns if c != column]
    return texts.select(*others, F.explode(_id_objects(F.col(column))).alias("gcid"))
