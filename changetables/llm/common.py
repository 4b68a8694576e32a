"""Column and table helpers that several operators of this package share."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changetables.functions.text import let

#: White space between words: blank, tab, line feed, vertical tab, form feed, return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"

#: Tables up to this many bytes are broadcast; larger ones are joined by a shuffle.
BROADCAST_BYTES = 32 << 20


def release() -> None:
    """Give what a task has freed back to the system: idle Python workers live on beside the next stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim is not None:
        trim(0)


def words(text: Column) -> Column:
    """Words of a text as an array; none for a null or blank text."""
    bare = F.btrim(text, F.lit(SPACES))
    return let(bare, lambda t: F.when(F.length(t) > 0, F.split(t, SPACE_RUN)).otherwise(F.array().cast("array<string>")))


def matches(text: Column, pattern: str, body) -> Column:
    """``body(found, between)`` over all leftmost, non-overlapping matches of a text.

    ``found`` are the matched strings, ``between`` the strings around them (one more).
    A text without a match is searched once.
    """
    none = F.array().cast("array<string>")
    return let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: let(
            F.when(F.size(found) > 0, F.split(text, pattern)).otherwise(none),
            lambda between: body(found, between),
        ),
    )


def broadcast_if_small(df: DataFrame, row_bytes: int, bound: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows of at most ``row_bytes`` fit the bound.

    Beyond it the join is left to adaptive execution, which splits skewed keys.
    """
    return F.broadcast(df) if df.count() * row_bytes <= bound else df


def prior_weight(level: DataFrame, least: float, most: float) -> float:
    """Weight of a beta-binomial prior by moments, within two bounds.

    ``level`` has a row per group: ``n`` outcomes, ``bad`` of them bad (or expected to be),
    and ``above``, the rate of the group's parent. The weight is how many outcomes the
    parent's rate counts for: few where the groups' rates spread far beyond chance.
    """
    above = F.col("above")
    spread = F.pow(F.col("bad") / F.col("n") - above, F.lit(2.0)) * F.col("n") / (above * (1 - above))
    got = level.where("n > 0").agg(F.sum(spread).alias("s"), F.count(F.lit(1)).alias("g"), F.sum("n").alias("n")).first()
    if not got["g"] or got["n"] <= got["g"] or got["s"] <= got["g"]:
        return most
    return min(most, max(least, (got["n"] - got["g"]) / (got["s"] - got["g"]) - 1))


def shrunk(level: DataFrame, least: float, most: float) -> DataFrame:
    """``level`` with ``weight``, its outcomes and the prior's together, and ``rate``, the posterior mean."""
    weight = prior_weight(level, least, most)
    return level.withColumn("weight", F.col("n") + weight).withColumn(
        "rate", (F.col("bad") + weight * F.col("above")) / F.col("weight")
    )
