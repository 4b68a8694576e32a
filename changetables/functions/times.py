"""Checkpoint times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_RFC3339 = r"\A\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?(Z|[+-]\d\d:\d\d)\z"


def format_time(at: Column) -> Column:
    """UTC text of whole seconds; no time gives the empty text."""
    return F.coalesce(F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.lit(""))


def parse_time(text: Column) -> Column:
    """RFC 3339 first, then ``yyyy-MM-dd HH:mm:ss``, read as UTC; otherwise null."""
    return F.when(text.rlike(_RFC3339), text.try_cast("timestamp")).otherwise(
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))
    )
