"""Row images: which columns are present, matching and assignment."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def skipped_of(skipped: Column, row: Column) -> Column:
    """Skipped column indexes of row number ``row``; none if there is no such entry."""
    return F.when(
        (row >= 0) & (row < F.size(skipped)), F.get(skipped, row.cast("int"))
    )


def present(values: Column, skipped: Column) -> Column:
    """Entries of a positional array whose index is not skipped."""
    none_skipped = F.coalesce(F.size(skipped), F.lit(0)) <= 0
    kept = F.filter(values, lambda _, i: ~F.array_contains(skipped, i))
    return F.when(none_skipped, values).otherwise(kept)


def row_match(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """All columns equal, NULL equal to NULL; the join can still be hashed."""
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in zip(left, right, strict=True)])


def assign(current: Column, after: Column, present_names: Column, name: str) -> Column:
    """The new value of ``name``: taken from the after image where it is present."""
    return F.when(F.array_contains(present_names, F.lit(name)), after).otherwise(current)


def normalise(value: Column, data_type: T.DataType) -> Column:
    """Wire form of a value: date-times as text of whole seconds, others unchanged."""
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss")
    return value


def explode_present(
    df: DataFrame, keep: Sequence[str | Column], structs: Sequence[Column], name: str
) -> DataFrame:
    """One row per struct that is not null; stays inside generated code."""
    exploded = df.select(*keep, F.explode(F.array(*structs)).alias(name))
    return exploded.filter(F.col(name).isNotNull())
