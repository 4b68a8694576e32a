"""As-of lookup: the last earlier, or first later, row of another table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changetables.plans.scan import Scan, segmented_scan
from changetables.session import fits

#: Up to this many lookup rows the lookup table is sent to every executor.
SMALL_LOOKUP = 1_000


def asof_lookup(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    order: str,
    segment: str,
    value: str,
    direction: str = "last",
    small: int = SMALL_LOOKUP,
) -> DataFrame:
    """Add ``right``'s column ``value`` to every row of ``left``.

    ``last`` takes the last row of ``right`` at or before the left row, ``next``
    the first row strictly after it; both tables share the ``keys``, ``order`` and
    ``segment`` columns, and (keys, order) is unique in ``right``. A lookup table
    counted to be small is turned into intervals and broadcast, so ``left`` is not
    shuffled. A larger one is merged into ``left`` by a segmented scan, which costs
    one shuffle and never compares a row with more than its neighbour.
    """
    if direction not in ("last", "next"):
        raise ValueError(f"direction must be 'last' or 'next', not {direction!r}")
    if fits(right, small):
        return _by_intervals(left, right, keys, order, value, direction)
    return _by_scan(left, right, keys, order, segment, value, direction)


def _by_intervals(left, right, keys, order, value, direction):
    ordered = Window.partitionBy(*keys).orderBy(order)
    names = [F.col(k).alias(f"__{k}") for k in keys]
    if direction == "last":
        lo, hi = F.col(order), F.lead(order).over(ordered)
    else:
        lo, hi = F.lag(order).over(ordered), F.col(order)
    intervals = right.select(*names, lo.alias("__lo"), hi.alias("__hi"), F.col(value))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    inside = [
        F.col("__lo").isNull() | (F.col("__lo") <= F.col(order)),
        F.col("__hi").isNull() | (F.col(order) < F.col("__hi")),
    ]
    on = reduce(lambda a, b: a & b, same + inside)
    return left.join(F.broadcast(intervals), on, "left").select(*left.columns, value)


def _by_scan(left, right, keys, order, segment, value, direction):
    # a lookup row is seen by a left row of the same order for "last" only
    side = F.lit(0)
    marks = right.select(*keys, order, segment, value, side.alias("__side"))
    rows = left.withColumn("__side", F.lit(1)).unionByName(marks, allowMissingColumns=True)
    kind = "last" if direction == "last" else "next_after"
    scanned = segmented_scan(
        rows, keys, [order, "__side"], segment, [Scan("__found", kind, F.col(value))]
    )
    return scanned.filter("__side = 1").select(*left.columns, F.col("__found").alias(value))
