"""From row events to one typed change per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changetables.functions.rows import normalise, present, skipped_of
from changetables.functions.types import DECLARED, parse_value, wire_value
from changetables.sources.catalogue import bound_columns, schema_asof

_HEADER_DROPPED = ("rows", "skipped", "json_diffs", "column_count", "catalogue_columns")


def bind_columns(events: DataFrame, history: DataFrame) -> DataFrame:
    """Replace ``columns`` by the bound names; null where neither list fits."""
    known = schema_asof(events, history)
    names = bound_columns(F.col("columns"), F.col("column_count"), F.col("catalogue_columns"))
    return known.withColumn("columns", names).drop("catalogue_columns")


def _single_images() -> Column:
    skipped = F.col("skipped")
    is_insert = F.col("op") == "insert"

    def image(row: Column, i: Column) -> Column:
        side = F.struct(row.alias("row"), skipped_of(skipped, i).alias("skipped"))
        return F.struct(
            F.when(~is_insert, side).alias("before"), F.when(is_insert, side).alias("after")
        )

    return F.transform("rows", image)


def _paired_images() -> Column:
    rows, skipped = F.col("rows"), F.col("skipped")

    def image(i: Column) -> Column:
        return F.struct(
            *[
                F.struct(
                    F.get(rows, at).alias("row"), skipped_of(skipped, at).alias("skipped")
                ).alias(side)
                for side, at in (("before", i * 2), ("after", i * 2 + 1))
            ]
        )

    pairs = F.floor(F.size(rows) / F.lit(2)).cast("int")
    return F.transform(F.when(pairs > 0, F.sequence(F.lit(0), pairs - 1)), image)


def _with_images(events: DataFrame, images: Column) -> DataFrame:
    header = [c for c in events.columns if c not in _HEADER_DROPPED and c != "columns"]
    exploded = events.select(*header, "columns", F.posexplode(images).alias("ordinal", "__image"))
    sides = []
    for side in ("before", "after"):
        at = F.col("__image")[side]
        names = present(F.col("columns"), at["skipped"])
        values = present(at["row"], at["skipped"])
        sides.append(F.when(at.isNotNull(), F.map_from_arrays(names, values)).alias(side))
        sides.append(F.when(at.isNotNull(), names).alias(f"{side}_present"))
    return exploded.select(*header, "columns", "ordinal", *sides)


def explode_rows(events: DataFrame) -> DataFrame:
    """One change per row of insert and delete events, numbered by ``ordinal``."""
    return _with_images(events.filter(F.col("op").isin("insert", "delete")), _single_images())


def pair_updates(events: DataFrame) -> DataFrame:
    """One change per (before, after) pair of update events."""
    return _with_images(events.filter(F.col("op") == "update"), _paired_images())


def decode_rows(events: DataFrame) -> DataFrame:
    """One change per changed row of every row event, in one pass over the log."""
    images = F.when(F.col("op") == "update", _paired_images()).when(
        F.col("op").isin("insert", "delete"), _single_images()
    )
    return _with_images(events, images)


def _typed(value: Column, field: T.StructField) -> Column:
    if DECLARED not in (field.metadata or {}):
        return value.cast(field.dataType)
    parsed = parse_value(value, field)
    message = F.concat(F.lit(f"column {field.name}: "), value)
    return F.coalesce(parsed, F.when(value.isNotNull(), F.raise_error(message)))


def typed_changes(log: DataFrame, fields: T.StructType) -> DataFrame:
    """Turn name/value images into typed structs; values that do not fit raise.

    ``validate.check_types`` sets changes with such values aside before.

    Structs can be grouped and joined, and only the columns a query needs are read.
    Fields from ``declared_fields`` are read as their source writes them.
    """

    def typed(image: str) -> Column:
        cast = [_typed(F.col(image)[f.name], f).alias(f.name, metadata=f.metadata) for f in fields]
        return F.when(F.col(image).isNotNull(), F.struct(*cast)).alias(image)

    rest = [c for c in log.columns if c not in ("before", "after")]
    return log.select(*rest, typed("before"), typed("after"))


def normalise_rows(rows: DataFrame) -> DataFrame:
    """Rows as they are written and matched: date-times as text of whole seconds, declared
    binary columns and times of day as text, too."""
    return rows.select(
        *[normalise(wire_value(F.col(f.name), f), f.dataType).alias(f.name) for f in rows.schema]
    )
