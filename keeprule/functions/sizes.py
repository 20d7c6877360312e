"""Approximate sizes of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes of a value of fixed width; text and binary count by their own length.
FIXED_WIDTHS = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.FloatType: 4,
    T.DateType: 4,
}
OTHER_WIDTH = 8


def row_bytes(rows: DataFrame) -> Column:
    """An approximate size of a row: the widths of its values that are not NULL."""

    def width(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = F.octet_length(column)
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            size = F.octet_length(F.to_json(column))
        else:
            size = F.when(column.isNotNull(), F.lit(FIXED_WIDTHS.get(type(field.dataType), OTHER_WIDTH)))
        return F.coalesce(size, F.lit(0)).cast("long")

    total = F.lit(0).cast("long")
    for field in rows.schema.fields:
        total = total + width(field)
    return total
