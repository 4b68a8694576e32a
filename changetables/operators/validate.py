"""Checks of captured events, and what to do with those that fail."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changetables.functions.types import parse_value
from changetables.functions.rows import skipped_of
from changetables.functions.text import let
from changetables.schema import position_key

# Error codes, in the order the checks are made.
MISSING_TABLE_MAP = "missing_table_map"
MISSING_NAME = "missing_schema_or_table"
COUNT_MISMATCH = "column_count_mismatch"
ODD_UPDATE_ROWS = "odd_update_rows"
VALUE_MISMATCH = "column_value_mismatch"
ZERO_COLUMNS = {"insert": "insert_zero_columns", "delete": "delete_zero_columns"}
ZERO_SET = "update_zero_set_columns"
ZERO_WHERE = "update_zero_where_columns"
WHERE_MISMATCH = "where_column_value_mismatch"
JSON_DIFF = "json_diff_unsupported"
BAD_VALUE = "value_type_mismatch"


def early_error(log: DataFrame) -> Column:
    """Checks made before the table filter: is the table known at all?"""
    schema, table = F.col("schema_name"), F.col("table_name")
    return F.when(schema.isNull() & table.isNull(), MISSING_TABLE_MAP).when(
        (F.coalesce(schema, F.lit("")) == "") | (F.coalesce(table, F.lit("")) == ""), MISSING_NAME
    )


def _kept(row: Column, index: Column) -> Column:
    """How many values of a row are left after dropping skipped columns."""
    skip = F.coalesce(skipped_of(F.col("skipped"), index), F.array().cast("array<int>"))
    inside = F.array_distinct(F.filter(skip, lambda i: (i >= 0) & (i < F.size(row))))
    return F.size(row) - F.size(inside)


def _has_diff(index: Column) -> Column:
    """A value that is not skipped is a partial JSON document."""
    diffs = F.coalesce(skipped_of(F.col("json_diffs"), index), F.array().cast("array<int>"))
    skip = F.coalesce(skipped_of(F.col("skipped"), index), F.array().cast("array<int>"))
    return F.size(F.array_except(diffs, skip)) > 0


def _row_errors(names: Column) -> Column:
    """The error of each row, or pair of rows, of an event; null where it passes."""
    rows = F.col("rows")
    fits = lambda row: F.size(row) == F.size(names)

    def single(row: Column, i: Column) -> Column:
        zero = F.when(F.col("op") == "insert", ZERO_COLUMNS["insert"]).otherwise(ZERO_COLUMNS["delete"])
        return (
            F.when(~fits(row), VALUE_MISMATCH)
            .when(_kept(row, i) == 0, zero)
            .when(_has_diff(i), JSON_DIFF)
        )

    def pair(i: Column) -> Column:
        before, after = F.get(rows, i), F.get(rows, i + 1)
        return (
            F.when(~fits(before) | ~fits(after), VALUE_MISMATCH)
            .when(_kept(after, i + 1) == 0, ZERO_SET)
            .when(_kept(before, i) == 0, ZERO_WHERE)
            .when(_has_diff(i) | _has_diff(i + 1), JSON_DIFF)
        )

    pairs = F.when(F.size(rows) >= 2, F.sequence(F.lit(0), F.size(rows) - 2, F.lit(2)))
    return F.when(F.col("op") == "update", F.transform(pairs, pair)).when(
        F.col("op").isin("insert", "delete"), F.transform(rows, single)
    )


def validate(events: DataFrame, names: Column | None = None, allowed: Column | None = None) -> DataFrame:
    """Add ``error``, the code of the first check a row event fails, else null.

    ``names`` are the bound column names, null where binding failed. The filter sits
    after the table checks: an event it drops raises none of the later errors.
    Events that are not row events, and unsupported row operations, pass the later
    checks untouched.
    """
    names = F.col("columns") if names is None else names
    allowed = F.lit(True) if allowed is None else allowed
    is_odd = (F.col("op") == "update") & (F.size("rows") % 2 != 0)
    late = let(
        names,
        lambda n: F.when(n.isNull(), COUNT_MISMATCH)
        .when(is_odd, ODD_UPDATE_ROWS)
        .otherwise(F.get(F.filter(_row_errors(n), lambda e: e.isNotNull()), F.lit(0))),
    )
    checked = F.coalesce(early_error(events), F.when(allowed, late))
    return events.withColumn("error", F.when(F.col("kind") == "rows", checked))


def image_error(before: Column, before_present: Column) -> Column:
    """A before image whose names and values do not pair up."""
    return F.when(F.size(before_present) != F.size(F.map_keys(before)), WHERE_MISMATCH)


def check_types(changes: DataFrame, fields: T.StructType) -> DataFrame:
    """Name/value changes with ``error``, set where a value does not fit its column's type.

    ``split_valid`` then sets such changes aside, so one bad value does not fail the job
    that types the others. A code that is there already stays.
    """

    def misfit(image: str) -> Column:
        def found(held: Column) -> Column:
            values = [held[f.name] for f in fields]
            return reduce(lambda a, b: a | b, [v.isNotNull() & parse_value(v, f).isNull() for v, f in zip(values, fields)])

        # a filter on the error repeats the image's own expression wherever it is named
        return F.coalesce(let(F.col(image), found), F.lit(False))

    found = F.when(misfit("before") | misfit("after"), BAD_VALUE)
    known = F.col("error") if "error" in changes.columns else F.lit(None).cast("string")
    return changes.withColumn("error", F.coalesce(known, found))


def split_valid(
    events: DataFrame, mode: str = "reject", names: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) events by their ``error`` column.

    ``reject`` sets bad events aside and keeps all others. ``halt`` stops at the first bad
    row of the log: nothing at or after it is accepted. If it has good rows before it in
    its event, the event is accepted with these and rejected with the others; changes
    with an ``ordinal`` are cut there. ``names`` are as for ``validate``.
    """
    if mode not in ("reject", "halt"):
        raise ValueError(f"mode must be 'reject' or 'halt', not {mode!r}")
    bad = events.filter("error is not null")
    if mode == "reject":
        return events.filter("error is null"), bad
    keyed = events.withColumn("__at", position_key(events))
    first = (
        bad.select(position_key(events).alias("at")).agg(F.min("at").alias("first")).scalar()
    )
    good = F.coalesce(F.col("__at") < first, F.lit(True))
    lists = ["rows", "skipped", "json_diffs"]
    needed = {"op", *lists} | ({"columns"} if names is None else set())
    if not needed <= set(events.columns):
        return keyed.filter(good).drop("__at"), keyed.filter(~good).drop("__at")
    found = _row_errors(F.col("columns") if names is None else names)
    entries = F.coalesce(F.array_position(found, F.col("error")) - 1, F.lit(0))
    before = F.greatest(entries, F.lit(0)) * F.when(F.col("op") == "update", 2).otherwise(1)
    halted = F.col("error").isNotNull() & F.coalesce(F.col("__at") == first, F.lit(False))
    keyed = keyed.withColumn("__good", F.when(halted, before).otherwise(0).cast("int"))
    is_cut = F.col("__good") > 0
    head = {c: F.when(is_cut, F.slice(c, F.lit(1), F.col("__good"))).otherwise(F.col(c)) for c in lists}
    tail = {c: F.when(is_cut, F.slice(c, F.col("__good") + 1, F.size(c))).otherwise(F.col(c)) for c in lists}
    accepted = keyed.filter(good | is_cut).withColumns({**head, "error": F.when(~is_cut, F.col("error"))})
    return accepted.drop("__at", "__good"), keyed.filter(~good).withColumns(tail).drop("__at", "__good")
