"""Column types as the source declares them, and the text forms of their values.

A declared column keeps its declaration in the metadata of its Spark field, so typed
images, checks and wire forms treat it alike:

* JSON is text in canonical form: keys in order, no blanks, numbers without trailing
  zeros, so that equal documents are equal text;
* binary columns arrive and leave as base64;
* TIME is an interval, as it may be negative and reach beyond a day;
* unsigned integers get a type that holds all their values;
* DATETIME has no time zone, TIMESTAMP is a moment.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DECLARED = "declared"

_INTEGERS = {
    "tinyint": (T.ByteType(), T.ShortType()),
    "smallint": (T.ShortType(), T.IntegerType()),
    "mediumint": (T.IntegerType(), T.IntegerType()),
    "int": (T.IntegerType(), T.LongType()),
    "integer": (T.IntegerType(), T.LongType()),
    "bigint": (T.LongType(), T.DecimalType(20, 0)),
}
_OTHERS = {
    "bool": T.ByteType(),
    "boolean": T.ByteType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "datetime": T.TimestampNTZType(),
    "timestamp": T.TimestampType(),
    "time": T.DayTimeIntervalType(),
    "year": T.IntegerType(),
    "json": T.StringType(),
}
_BINARY = {"binary", "varbinary", "blob", "tinyblob", "mediumblob", "longblob"}
_TEXT = {"char", "varchar", "text", "tinytext", "mediumtext", "longtext", "enum", "set"}

_TIME = r"\A(-?)(\d{1,3}):([0-5]\d):([0-5]\d(?:\.\d{1,6})?)\z"


def _name(declared: str) -> str:
    return re.match(r"\s*([a-z]+)", declared.lower())[1]


def source_type(declared: str) -> T.DataType:
    """The Spark type of a declaration such as ``bigint unsigned`` or ``decimal(10,2)``."""
    name, text = _name(declared), declared.lower()
    if name in _INTEGERS:
        return _INTEGERS[name]["unsigned" in text]
    if name in ("decimal", "numeric"):
        size = re.search(r"\((\d+)(?:\s*,\s*(\d+))?\)", text)
        return T.DecimalType(int(size[1]), int(size[2] or 0)) if size else T.DecimalType(10, 0)
    if name in _BINARY:
        return T.BinaryType()
    if name in _TEXT:
        return T.StringType()
    if name in _OTHERS:
        return _OTHERS[name]
    raise ValueError(f"unknown column type {declared!r}")


def declared_fields(columns: Mapping[str, str]) -> T.StructType:
    """A schema from names and declarations."""
    return T.StructType([T.StructField(n, source_type(d), metadata={DECLARED: d}) for n, d in columns.items()])


def canonical_json(text: Column) -> Column:
    """A document in canonical form; null if it is none."""
    return F.to_json(F.try_parse_json(text))


def parse_interval(text: Column) -> Column:
    """``[-]H:MM:SS[.ffffff]`` with up to three digits of hours; null for other texts."""
    part = lambda i: F.regexp_extract(text, _TIME, i)
    sign = F.when(part(1) == "-", -1).otherwise(1)
    hours, minutes = part(2).try_cast("int"), part(3).try_cast("int")
    seconds = part(4).try_cast("decimal(18,6)")
    length = F.make_dt_interval(F.lit(0), sign * hours, sign * minutes, sign * seconds)
    return F.when(text.rlike(_TIME), length)


def format_interval(value: Column) -> Column:
    """The text of an interval; fractions of a second only where there are some."""
    part = lambda unit: F.abs(F.extract(F.lit(unit), value))
    two = lambda x: F.when(x < 10, F.concat(F.lit("0"), x.cast("string"))).otherwise(x.cast("string"))
    hours = part("DAY").cast("long") * 24 + part("HOUR").cast("long")
    exact = part("SECOND").cast("decimal(8,6)")
    whole = F.floor(exact).cast("long")
    fraction = F.regexp_replace(F.substring_index((exact - F.floor(exact)).cast("decimal(8,6)").cast("string"), ".", -1), "0+$", "")
    text = F.concat(
        F.when(value < F.expr("interval '0' second"), "-").otherwise(""),
        two(hours),
        F.lit(":"),
        two(part("MINUTE").cast("long")),
        F.lit(":"),
        two(whole),
        F.when(fraction != "", F.concat(F.lit("."), fraction)).otherwise(""),
    )
    return F.when(value.isNotNull(), text)


def parse_value(text: Column, field: T.StructField) -> Column:
    """A text value as its column's type; null if it does not fit."""
    declared = field.metadata.get(DECLARED) if field.metadata else None
    name = _name(declared) if declared else None
    if name == "json":
        return canonical_json(text)
    if name in _BINARY:
        return F.try_to_binary(text, F.lit("base64"))
    if name == "time":
        return parse_interval(text)
    return text.try_cast(field.dataType)


def wire_value(value: Column, field: T.StructField) -> Column:
    """The text form a declared column is written in; other values as they are."""
    declared = field.metadata.get(DECLARED) if field.metadata else None
    name = _name(declared) if declared else None
    if name in _BINARY:
        return F.base64(value)
    if name == "time":
        return format_interval(value)
    return value
