"""Ordered scans per key that no single key can overload.

A plain window over ``partitionBy(key)`` puts all rows of a key in one task. Here a
key that may be large is cut into segments of the log, a small per-segment summary is
carried from segment to segment, and the carried values re-enter the data as one extra
row per (key, segment). The heavy window is then partitioned by (key, segment), so a
task holds at most one segment of a key, and the data is shuffled once. Null keys
group together, as in any window.

``segmented_scan`` cuts every key and is for few, large keys such as sources or
tables. ``keyed_scan`` is for keys that are many and mostly small, such as rows: it
looks for hot keys first, by a sketch of counts, and cuts only those.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changetables.session import fits, materialise

#: Rows of one key that one task may sort.
HOT_ROWS = 2_000_000

#: Up to this many hot keys are sent to every executor. There are at most
#: (rows of the log / HOT_ROWS) of them; if there are more, all keys are cut.
MAX_HOT_KEYS = 50_000

#: Hash buckets of the sketch: the most rows that a task sends when keys are counted.
BUCKETS = 1 << 16


@dataclass(frozen=True)
class Scan:
    """One scanned column.

    kind: ``last`` (last non-null value up to this row), ``last_before`` (excluding
    this row), ``next_after`` (first non-null value after this row), ``sum`` and
    ``sum_before`` (running totals of ``value``), ``max`` (running maximum).
    """

    name: str
    kind: str
    value: Column

    @property
    def backward(self) -> bool:
        return self.kind == "next_after"

    @property
    def total(self):
        """The aggregate of a running total or maximum, None for picked values."""
        return {"sum": F.sum, "sum_before": F.sum, "max": F.max}.get(self.kind)

    @property
    def cell(self) -> str:
        return f"__cell_{self.name}"


def segmented_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    segment: str,
    scans: Sequence[Scan],
) -> DataFrame:
    """Add one column per scan to ``df``.

    ``order`` must be unique within a key, and ``segment`` must ascend with it.
    """
    cells = df.withColumns({s.cell: _cell(s) for s in scans})
    return _scan(cells, cells, df.columns, keys, order, segment, scans)


def keyed_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    segment: str,
    scans: Sequence[Scan],
    hot_rows: int = HOT_ROWS,
    max_hot_keys: int = MAX_HOT_KEYS,
) -> DataFrame:
    """``segmented_scan`` that leaves keys of up to ``hot_rows`` rows in one piece.

    Hot keys are looked for when the scan is set up, see ``hot_keys``; without any, what
    is left is one plain window.
    """
    hot = hot_keys(df, keys, hot_rows)
    cells = df.withColumns({s.cell: _cell(s) for s in scans})
    if hot is None:
        whole = cells.withColumn(segment, F.lit(None).cast(df.schema[segment].dataType))
        return _scan(whole, None, df.columns, keys, order, segment, scans)
    if not fits(hot, max_hot_keys):
        return _scan(cells, cells, df.columns, keys, order, segment, scans)
    names = hot.select(*[F.col(k).alias(f"__hot_{k}") for k in keys], F.lit(True).alias("__is_hot"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__hot_{k}")) for k in keys])
    flagged = cells.join(F.broadcast(names), same, "left")
    cut = flagged.withColumn(segment, F.when(F.col("__is_hot"), F.col(segment)))
    large = cut.filter("__is_hot").select(*cells.columns)
    return _scan(cut.select(*cells.columns), large, df.columns, keys, order, segment, scans)


def hot_keys(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, buckets: int = BUCKETS
) -> DataFrame | None:
    """The keys of more than ``hot_rows`` rows, None if there are none.

    A sketch with one counter per hash bucket comes first: all rows of a key share a bucket,
    so a key can only be hot in a bucket that is, and however many keys there are, a task
    sends at most ``buckets`` counters. Only keys of such buckets are counted by themselves.
    Where buckets are hot by their number of keys alone, a sketch with more of them follows.
    """
    rows = df.select(*keys)
    heavy = _heavy_buckets(rows, keys, hot_rows, buckets)
    held = heavy.agg(F.sum("__n")).first()[0]
    if held is None:
        return None
    if held > buckets * hot_rows // 2:
        buckets = 1 << (8 * held // max(1, hot_rows)).bit_length()
        heavy = _heavy_buckets(rows, keys, hot_rows, buckets)
    near = rows.withColumn("__bucket", _bucket(keys, buckets)).join(heavy, "__bucket", "left_semi")
    counted = near.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    hot = materialise(counted.filter(F.col("__n") > hot_rows).select(*keys), "hot")
    return None if hot.isEmpty() else hot


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets).cast("long"))


def _heavy_buckets(rows: DataFrame, keys: Sequence[str], hot_rows: int, buckets: int) -> DataFrame:
    counts = rows.groupBy(_bucket(keys, buckets).alias("__bucket")).agg(F.count(F.lit(1)).alias("__n"))
    return materialise(counts.filter(F.col("__n") > hot_rows), "heavy")


def _scan(
    cells: DataFrame,
    large: DataFrame | None,
    columns: Sequence[str],
    keys: Sequence[str],
    order: Sequence[str],
    segment: str,
    scans: Sequence[Scan],
) -> DataFrame:
    """Scan ``cells``; ``large`` are the rows whose keys span several segments."""
    pieces = [cells.withColumn("__edge", F.lit(0))]
    if large is not None:
        summary = large.groupBy(*keys, segment).agg(*[_summarise(s, order) for s in scans])
        for edge in (-1, 1):
            group = [s for s in scans if s.backward == (edge > 0)]
            if group:
                pieces.append(_carried(summary, keys, segment, group, edge))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pieces)

    forward = Window.partitionBy(*keys, segment).orderBy("__edge", *order)
    backward = Window.partitionBy(*keys, segment).orderBy(
        F.desc("__edge"), *[F.desc(o) for o in order]
    )
    scanned = rows.select(
        "*", *[_over(s, backward if s.backward else forward).alias(s.name) for s in scans]
    )
    results = [
        (F.col(s.name) if s.total else F.col(s.name)["v"]).alias(s.name) for s in scans
    ]
    return scanned.filter("__edge = 0").select(*columns, *results)


def _cell(scan: Scan) -> Column:
    if scan.total:
        return scan.value
    return F.when(scan.value.isNotNull(), F.struct(scan.value.alias("v")))


def _summarise(scan: Scan, order: Sequence[str]) -> Column:
    cell = F.col(scan.cell)
    if scan.total:
        return scan.total(cell).alias(scan.cell)
    at = F.when(cell.isNotNull(), F.struct(*order))
    pick = F.min_by if scan.backward else F.max_by
    return pick(cell, at).alias(scan.cell)


def _carried(summary: DataFrame, keys, segment: str, scans: Sequence[Scan], edge: int) -> DataFrame:
    along = F.col(segment).asc() if edge < 0 else F.col(segment).desc()
    earlier = (
        Window.partitionBy(*keys).orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = summary.select(
        *keys,
        segment,
        *[
            (s.total(s.cell) if s.total else F.last(s.cell, ignorenulls=True)).over(earlier).alias(s.cell)
            for s in scans
        ],
        F.lit(edge).alias("__edge"),
    )
    return carried.filter(reduce(lambda a, b: a | b, [F.col(s.cell).isNotNull() for s in scans]))


def _over(scan: Scan, window) -> Column:
    end = -1 if scan.kind in ("last_before", "next_after", "sum_before") else Window.currentRow
    frame = window.rowsBetween(Window.unboundedPreceding, end)
    cell = F.col(scan.cell)
    return (scan.total(cell) if scan.total else F.last(cell, ignorenulls=True)).over(frame)
