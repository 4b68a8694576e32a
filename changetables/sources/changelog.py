"""Change-log scans, and where to start reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changetables.functions.gtid import gtid_intervals, normalise_flavor
from changetables.plans.scan import Scan, segmented_scan
from changetables.schema import LOG_SCHEMA
from changetables.session import fits

#: Executed-set intervals up to this number become a filter the scan can use.
SMALL_SET = 1_000

#: Transaction numbers per segment of a source.
SEQ_SEGMENT = 1_000_000


def read_changelog(
    spark: SparkSession,
    path: str,
    *,
    streaming: bool = False,
    file_format: str = "parquet",
    schema: T.StructType = LOG_SCHEMA,
    max_files: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """The change log at ``path``, as a table or as a stream of arriving files."""
    reader = (spark.readStream if streaming else spark.read).format(file_format).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def file_sequence(file: Column) -> Column:
    """Number of a log file; names compare wrongly once the number gains a digit."""
    return F.regexp_extract(file, r"(\d+)\z", 1).try_cast("long")


def _sequence_of(file: str) -> int:
    digits = file[len(file.rstrip("0123456789")) :]
    if not digits:
        raise ValueError(f"log file {file!r} carries no number")
    return int(digits)


def from_position(log: DataFrame, file: str, pos: int) -> DataFrame:
    """Events that start at or after a position; the bounds reach the file scan."""
    seq = _sequence_of(file)
    return log.filter(
        (F.col("file_seq") > seq) | ((F.col("file_seq") == seq) & (F.col("pos") >= pos))
    )


def resume_after(log: DataFrame, file: str, pos: int) -> DataFrame:
    """Events that end after a saved position."""
    seq = _sequence_of(file)
    return log.filter(
        (F.col("file_seq") > seq) | ((F.col("file_seq") == seq) & (F.col("end_pos") > pos))
    )


def after_gtid_set(
    log: DataFrame, gtid_set: str, flavor: str | None = "mysql", small: int = SMALL_SET
) -> DataFrame:
    """Events of transactions outside an executed set; events without an id stay.

    Source names are lower case in the log, as they are in the parsed set.
    A small set becomes comparisons on (gtid_source, gtid_seq), which prune Parquet
    row groups. A set with more intervals is merged into the log by a segmented
    scan: a number is executed if the greatest upper end of all intervals starting
    at or below it reaches it.
    """
    spark = log.sparkSession
    normalise_flavor(flavor)
    sets = spark.createDataFrame([(gtid_set,)], "gtid_set string")
    intervals = gtid_intervals(sets, "gtid_set", flavor)
    if fits(intervals, small):
        return log.filter(_outside(intervals))
    return _outside_by_scan(log, intervals)


def _outside(intervals: DataFrame) -> Column:
    by_source: dict[str, list[tuple[int, int]]] = {}
    for row in intervals.orderBy("gtid_source", "lo", "hi").collect():
        merged = by_source.setdefault(row.gtid_source, [])
        if merged and row.lo <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(merged[-1][1], row.hi))
        else:
            merged.append((row.lo, row.hi))
    source, seq = F.col("gtid_source"), F.col("gtid_seq")
    keep = source.isNull() | seq.isNull()
    if not by_source:
        return F.lit(True)
    keep = keep | ~source.isin(*by_source)
    for name, merged in by_source.items():
        gaps = seq < merged[0][0]
        for (_, hi), (lo, _) in zip(merged, merged[1:]):
            gaps = gaps | ((seq > hi) & (seq < lo))
        keep = keep | ((source == name) & (gaps | (seq > merged[-1][1])))
    return keep


def _outside_by_scan(log: DataFrame, intervals: DataFrame) -> DataFrame:
    return outside_by_scan(log, intervals, ["gtid_source"])


def outside_by_scan(log: DataFrame, intervals: DataFrame, keys: list[str]) -> DataFrame:
    """Events whose number no interval (``keys``, lo, hi) of the same keys holds.

    Events without an id stay and take no part in the scan, whatever their number.
    """
    named = F.col("gtid_seq").isNotNull()
    for key in keys:
        named = named & F.col(key).isNotNull()
    marks = intervals.select(
        *keys, F.col("lo").alias("gtid_seq"), F.col("hi").alias("__hi"), F.lit(0).alias("__side")
    )
    rows = (
        log.filter(named)
        .withColumn("__side", F.lit(1))
        .unionByName(marks, allowMissingColumns=True)
        .withColumn("__segment", F.expr(f"gtid_seq div {SEQ_SEGMENT}"))
    )
    scanned = segmented_scan(
        rows,
        keys,
        ["gtid_seq", "__side"],
        "__segment",
        [Scan("__reach", "max", F.col("__hi"))],
    )
    executed = F.coalesce(F.col("__reach") >= F.col("gtid_seq"), F.lit(False))
    kept = scanned.filter((F.col("__side") == 1) & ~executed).select(*log.columns)
    return kept.unionByName(log.filter(~named))
