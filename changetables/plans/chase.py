"""Following chains of successor links by pointer doubling.

Each round joins the links with themselves, so a chain of n links is settled after
about log2(n) rounds. Link targets are unique on the looked-up side; many links may
share a target, and adaptive execution splits such a target's partition. Every round
is written to the shared scratch folder, nothing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changetables.session import materialise


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def resolve_roots(links: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """(id, next, next_erases) -> (id, root): where a chain starting at id ends.

    A chain ends at the id without ``next``; ``root`` is null where the chain runs
    into an erasing successor, which itself has no row in ``links``. ``links`` is read
    more than once and should come from a written table. ``carried`` columns come along:
    each id gets the value of the last link on its way that has one, its own and the
    end's included.
    """
    target = (
        F.when(F.col("next").isNull(), F.col("id"))
        .when(F.col("next_erases"), F.lit(None))
        .otherwise(F.col("next"))
    )
    is_open = F.col("next").isNotNull() & ~F.coalesce(F.col("next_erases"), F.lit(False))
    state = links.select("id", is_open.alias("open"), target.alias("target"), *carried)
    closed, pending = [state.filter(~F.col("open"))], state.filter("open")
    while not pending.isEmpty():
        known = _union(closed + [pending]).select(
            F.col("id").alias("target"), F.col("open"), F.col("target").alias("further"),
            *[F.col(c).alias(f"later_{c}") for c in carried],
        )
        step = pending.select("id", "target", *carried).join(known, "target")
        latest = [F.coalesce(f"later_{c}", c).alias(c) for c in carried]
        state = materialise(step.select("id", "open", F.col("further").alias("target"), *latest), "links")
        closed.append(state.filter(~F.col("open")))
        pending = state.filter("open")
    return _union(closed).select("id", F.col("target").alias("root"), *carried)


def reachable(links: DataFrame, starts: DataFrame) -> DataFrame:
    """All ids that can be reached from ``starts`` (id) over ``links`` (id, next).

    Round k jumps 2^k links at once from everything seen so far.
    """
    jump = links.filter("next is not null").select("id", "next")
    seen = materialise(starts.select("id").distinct(), "seen")
    while not jump.isEmpty():
        found = seen.join(jump, "id").select(F.col("next").alias("id"))
        seen = materialise(seen.unionByName(found).distinct(), "seen")
        further = jump.select(F.col("id").alias("next"), F.col("next").alias("further"))
        jump = materialise(
            jump.join(further, "next").select("id", F.col("further").alias("next")), "jump"
        )
    return seen
