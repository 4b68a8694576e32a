"""Labels and classification of log events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changetables.functions.text import label_or_unknown, trim_space

# Event kinds, row operations and transaction control words.
ROW_OPS = ("insert", "update", "delete")
TXN_WORDS = ("begin", "commit", "rollback")


def event_type_label(event_type: Column) -> Column:
    """Lower-case header type; a missing header reads ``unknown``."""
    return label_or_unknown(F.lower(event_type))


def event_kind(event_type: Column) -> Column:
    """``rows``, ``query``, ``xid`` or ``other`` from the header type."""
    name = F.lower(event_type)
    return (
        F.when(name.rlike("rows(?!_?query)"), "rows")
        .when(name.startswith("query"), "query")
        .when(name.startswith("xid"), "xid")
        .otherwise("other")
    )


def rows_label(op: Column) -> Column:
    """``rows_insert``, ``rows_update``, ``rows_delete``; anything else ``rows_unknown``."""
    return F.when(op.isin(*ROW_OPS), F.concat(F.lit("rows_"), op)).otherwise("rows_unknown")


def apply_label(kind: Column, op: Column) -> Column:
    """Label under which an event is applied; null for events that change nothing."""
    return F.when(kind == "rows", rows_label(op)).when(kind == "query", "query")


def is_txn_control(query: Column) -> Column:
    """The whole trimmed text is BEGIN, COMMIT or ROLLBACK, in any case."""
    return F.lower(trim_space(query)).isin(*TXN_WORDS)


def is_skipped_query(query: Column) -> Column:
    """Query text that is never applied: blank text and transaction control."""
    text = trim_space(F.coalesce(query, F.lit("")))
    return (text == "") | F.lower(text).isin(*TXN_WORDS)


def lag_seconds(read_ts: Column, event_ts: Column) -> Column:
    """Seconds from the event's header time to its reading, at least 0.

    Null where the header carries no time. Header times have whole seconds.
    """
    event_s = F.floor(F.unix_micros(event_ts) / F.lit(1_000_000))
    lag = F.unix_micros(read_ts) / F.lit(1_000_000) - event_s
    return F.when(event_s > 0, F.greatest(F.lit(0.0), lag))


def drop_null_events(log: DataFrame, event: str = "event_type") -> DataFrame:
    """Drop log entries that carry no event."""
    return log.filter(F.col(event).isNotNull())


def classify(log: DataFrame) -> DataFrame:
    """Route events: add ``kind`` and ``label``, trim the query text.

    ``label`` is null for events that are read but never applied. Row events of an
    unsupported operation get ``rows_unknown`` and change nothing.
    """
    return (
        log.withColumn("kind", event_kind(F.col("event_type")))
        .withColumn("query", trim_space(F.col("query")))
        .withColumn("label", apply_label(F.col("kind"), F.col("op")))
    )
