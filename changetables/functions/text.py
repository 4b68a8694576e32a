"""Small text helpers shared by the column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Any white space, as Unicode defines it.
SPACE = r"(?U)\s"


def trim_space(text: Column) -> Column:
    """Remove white space of any kind from both ends (``trim`` removes blanks only)."""
    return F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")


def blank_to_null(text: Column) -> Column:
    return F.when(text != "", text)


def label_or_unknown(label: Column) -> Column:
    """Metric label: an empty or missing label reads ``unknown``."""
    return F.coalesce(blank_to_null(label), F.lit("unknown"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is computed once however often it is used.

    Filters pushed below a projection repeat its expressions; a bound value keeps a
    long text expression from being repeated inside itself.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
