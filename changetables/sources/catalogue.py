"""Column names of tables over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changetables.plans.asof import SMALL_LOOKUP, asof_lookup
from changetables.schema import before_all, position_key, segment_before_all, segment_key

TABLE = ("schema_name", "table_name")


def table_columns(catalogue: DataFrame) -> DataFrame:
    """One row per table from one row per column, names in ordinal order."""
    names = F.sort_array(F.collect_list(F.struct("ordinal_position", "column_name")))
    return catalogue.groupBy(*TABLE).agg(names["column_name"].alias("columns"))


def schema_history(initial: DataFrame, changes: DataFrame | None = None) -> DataFrame:
    """Column lists with the position they are valid from.

    ``initial`` (schema_name, table_name, columns) holds before the log starts;
    ``changes`` adds the list after each schema change at its log position.
    """
    start = initial.select(
        *TABLE,
        before_all().alias("at"),
        segment_before_all().alias("segment"),
        F.struct("columns").alias("catalogue"),
    )
    if changes is None:
        return start
    later = changes.select(
        *TABLE,
        position_key(changes).alias("at"),
        segment_key().alias("segment"),
        F.struct("columns").alias("catalogue"),
    )
    return start.unionByName(later)


def schema_asof(log: DataFrame, history: DataFrame, small: int = SMALL_LOOKUP) -> DataFrame:
    """Add ``catalogue_columns``, the names valid at each event's position."""
    keyed = log.withColumns({"at": position_key(log), "segment": segment_key()})
    found = asof_lookup(keyed, history, TABLE, "at", "segment", "catalogue", "last", small)
    return found.select(*log.columns, F.col("catalogue.columns").alias("catalogue_columns"))


def bound_columns(names: Column, count: Column, catalogue: Column) -> Column:
    """The event's own names if all are given, else the catalogue's, else null.

    Either list must have exactly as many names as the event has columns.
    """
    own = (F.size(names) == count) & F.forall(
        names, lambda n: F.coalesce(n != "", F.lit(False))
    )
    return F.when(own, names).when(F.size(catalogue) == count, catalogue)
