"""Expressions that clean text, read semi-JSON and render report values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Constructors of the shell notation that hold a number, and those that hold text.
NUMBER_CONSTRUCTORS = ("NumberInt", "NumberLong", "NumberDecimal")
TEXT_CONSTRUCTORS = ("ISODate", "ObjectId", "UUID")

# The characters that count as white space at the ends of an id.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Drop white space of any kind at both ends."""
    return F.trim(text, F.lit(WHITE_SPACE))


def or_empty(column: Column) -> Column:
    """A missing value becomes empty text; other types are written as text."""
    return F.coalesce(column.cast("string"), F.lit(""))


def shell_to_json(text: Column) -> Column:
    """Constructors of the shell notation as the JSON value they hold.

    A number may be signed, fractional, in exponent form, and in quotes of either kind; so may a date or an id. A
    constructor with anything else in it stays as it is, so that the object is seen to be no JSON.
    """
    blank, quote = r"\s*", """(["']?)"""
    number = r"\+?(-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?)"
    numbers = rf"\b(?:{'|'.join(NUMBER_CONSTRUCTORS)}){blank}\({blank}{quote}{number}\1{blank}\)"
    texts = rf"""\b(?:{'|'.join(TEXT_CONSTRUCTORS)}){blank}\({blank}(["'])([^"'\\]*)\1{blank}\)"""
    return F.regexp_replace(F.regexp_replace(text, numbers, "$2"), texts, '"$2"')


def flat_objects(text: Column) -> Column:
    """The objects of a text that hold no object, as an array: each from an opening brace to the next closing one.

    What stands before the first opening brace behind an object, and objects without content, are left out.
    """
    closed = F.split(text, r"\}", -1)
    opened = F.transform(
        F.slice(closed, F.lit(1), F.size(closed) - 1),
        lambda p: F.when(F.locate("{", p) > 0, F.substr(p, F.locate("{", p))),
    )
    return F.transform(F.filter(opened, lambda p: F.length(p) > 1), lambda p: F.concat(p, F.lit("}")))


def text_struct(fields) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in fields])


def json_objects(text: Column, fields=None) -> Column:
    """A JSON array of objects as an array of maps, or of structs of the given fields.

    Values are text, nested ones JSON text. NULL when the text is not a JSON array of
    objects, or goes on after it.
    """
    item = T.MapType(T.StringType(), T.StringType()) if fields is None else text_struct(fields)
    # Read as the first of two arrays: text that goes on after its array gives a list of another length.
    both = F.from_json(F.concat(F.lit("["), text, F.lit(",[]]")), T.ArrayType(T.ArrayType(item)))
    return F.when(F.rtrim(text).endswith("]") & (F.size(both) == 2) & (F.size(both[1]) == 0), both[0])


def unwrap_array(text: Column) -> Column:
    """``{[ ... ]}`` to ``[ ... ]``."""
    return F.replace(F.replace(strip(text), F.lit("{["), F.lit("[")), F.lit("]}"), F.lit("]"))


def megabytes(size: Column) -> Column:
    """Bytes as mebibytes with two decimals; exact, ties go to the even digit."""
    exact = size.cast("decimal(18,0)") * F.expr("0.00000095367431640625BD")
    return F.concat(F.bround(exact, 2).cast("string"), F.lit(" MB"))
