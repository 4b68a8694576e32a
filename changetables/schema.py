"""Schemas of the change log, the progress ledger and the metrics table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Total order of a log: file number, byte position, row inside the event.
ORDER_TYPE = T.StructType(
    [
        T.StructField("file_seq", T.LongType()),
        T.StructField("pos", T.LongType()),
        T.StructField("ordinal", T.IntegerType()),
    ]
)

#: Bytes of log per segment. A segment bounds the rows one task may have to sort,
#: whatever the skew of the keys.
SEGMENT_BYTES = 64 * 1024 * 1024

_STRING, _LONG, _INT = T.StringType(), T.LongType(), T.IntegerType()

_HEADER = [
    T.StructField("source_id", _STRING),
    T.StructField("file", _STRING),
    T.StructField("file_seq", _LONG),
    T.StructField("pos", _LONG),
    T.StructField("end_pos", _LONG),
    T.StructField("gtid_source", _STRING),
    T.StructField("gtid_seq", _LONG),
    T.StructField("gtid_set", _STRING),
    T.StructField("event_ts", T.TimestampType()),
    T.StructField("event_type", _STRING),
    T.StructField("op", _STRING),
    T.StructField("schema_name", _STRING),
    T.StructField("table_name", _STRING),
    T.StructField("query", _STRING),
]

#: One row per event as captured: row images are positional text values.
EVENT_SCHEMA = T.StructType(
    _HEADER
    + [
        T.StructField("column_count", _INT),
        T.StructField("columns", T.ArrayType(_STRING)),
        T.StructField("rows", T.ArrayType(T.ArrayType(_STRING))),
        T.StructField("skipped", T.ArrayType(T.ArrayType(_INT))),
        T.StructField("json_diffs", T.ArrayType(T.ArrayType(_INT))),
    ]
)

#: One row per changed row: images are name/value maps plus the names present.
LOG_SCHEMA = T.StructType(
    _HEADER
    + [
        T.StructField("kind", _STRING),
        T.StructField("ordinal", _INT),
        T.StructField("columns", T.ArrayType(_STRING)),
        T.StructField("before", T.MapType(_STRING, _STRING)),
        T.StructField("after", T.MapType(_STRING, _STRING)),
        T.StructField("before_present", T.ArrayType(_STRING)),
        T.StructField("after_present", T.ArrayType(_STRING)),
    ]
)

#: Saved progress, one row per source.
LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("source_id", _STRING),
        T.StructField("flavor", _STRING),
        T.StructField("mode", _STRING),
        T.StructField("gtid_set", _STRING),
        T.StructField("binlog_file", _STRING),
        T.StructField("binlog_pos", _LONG),
        T.StructField("server_id", _LONG),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("version", _LONG),
    ]
)

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("metric", _STRING),
        T.StructField("label", _STRING),
        T.StructField("value", T.DoubleType()),
    ]
)


def event_key() -> Column:
    """The total order of a whole event, equal to that of its first row."""
    return F.struct(
        F.col("file_seq").cast("long").alias("file_seq"),
        F.col("pos").cast("long").alias("pos"),
        F.lit(0).cast("int").alias("ordinal"),
    )


def position_key(log: DataFrame) -> Column:
    """``order_key`` for a log of changes, ``event_key`` for a log of events."""
    return order_key() if "ordinal" in log.columns else event_key()


def order_key() -> Column:
    """The total order of a change as one comparable column."""
    return F.struct(
        F.col("file_seq").cast("long").alias("file_seq"),
        F.col("pos").cast("long").alias("pos"),
        F.col("ordinal").cast("int").alias("ordinal"),
    )


def before_all() -> Column:
    """An order key that precedes every change (rows that were there already)."""
    return F.struct(
        F.lit(-1).cast("long").alias("file_seq"),
        F.lit(-1).cast("long").alias("pos"),
        F.lit(-1).cast("int").alias("ordinal"),
    )


def segment_key(segment_bytes: int = SEGMENT_BYTES) -> Column:
    """The byte range of the log a change lies in; ascends with the order key."""
    return F.struct(
        F.col("file_seq").cast("long").alias("file_seq"),
        F.expr(f"pos div {int(segment_bytes)}").cast("long").alias("part"),
    )


def segment_before_all() -> Column:
    return F.struct(F.lit(-1).cast("long").alias("file_seq"), F.lit(-1).cast("long").alias("part"))


def image_columns(changes: DataFrame) -> list[str]:
    """Column names of the typed row images of ``changes``."""
    return changes.schema["after"].dataType.names
