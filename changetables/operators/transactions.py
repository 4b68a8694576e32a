"""Grouping events into the transactions of their source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changetables.functions.text import trim_space
from changetables.plans.scan import Scan, segmented_scan
from changetables.schema import SEGMENT_BYTES, position_key, segment_key


def with_txn_id(log: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Add ``txn_id``: how many BEGINs the source has logged up to the event.

    Replay ignores transaction boundaries; the number lets a reader cut micro-batches
    on a commit.
    """
    begins = F.lower(trim_space(F.coalesce("query", F.lit("")))) == "begin"
    keyed = log.withColumns({"__at": position_key(log), "__segment": segment_key(segment_bytes)})
    scanned = segmented_scan(
        keyed,
        ["source_id"],
        ["__at"],
        "__segment",
        [Scan("txn_id", "sum", begins.cast("long"))],
    )
    return scanned.drop("__at", "__segment")
