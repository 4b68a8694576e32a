"""Applying a log to a destination table as one batch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from changetables.operators.exact import expand_copies, replay
from changetables.operators.keyed import conflicts, halt_at_first_conflict, latest_by_key


def apply_to_table(
    changes: DataFrame,
    base: DataFrame,
    keys: Sequence[str] | None = None,
    mode: str = "latest",
    on_conflict: str = "overwrite",
    defaults: Mapping[str, Column] | None = None,
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """The destination's rows after ``changes``; publish them with ``write_table``.

    ``latest``: the last writer of each key wins. ``exact``: every change acts on all
    rows equal to its before image. ``one``: every change acts on one row. Tables
    without a key use one of the last two. ``on_conflict="halt"`` applies only what
    precedes the first insert into a key that exists; ``report`` applies all and returns
    the rows and the ``conflicts``. ``defaults`` are for columns that an insert lacks.
    """
    if mode not in ("latest", "exact", "one"):
        raise ValueError(f"mode must be 'latest', 'exact' or 'one', not {mode!r}")
    if on_conflict not in ("overwrite", "halt", "report"):
        raise ValueError(f"on_conflict must be 'overwrite', 'halt' or 'report', not {on_conflict!r}")
    if not keys and (mode == "latest" or on_conflict != "overwrite"):
        raise ValueError("this needs the table's keys")
    if on_conflict == "halt":
        changes = halt_at_first_conflict(changes, keys, base)
    if mode == "latest":
        rows = latest_by_key(changes, keys, base, defaults)
    else:
        rows = expand_copies(replay(changes, base, "all" if mode == "exact" else "one", defaults=defaults))
    return (rows, conflicts(changes, keys, base)) if on_conflict == "report" else rows
