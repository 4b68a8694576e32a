"""Replay of a log onto tables that have a key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changetables.functions.rows import explode_present
from changetables.operators import exact
from changetables.operators.partial import carries, is_whole, partial_kinds
from changetables.plans.chase import reachable
from changetables.plans.scan import HOT_ROWS, Scan, keyed_scan
from changetables.schema import (
    SEGMENT_BYTES,
    before_all,
    image_columns,
    order_key,
    segment_before_all,
    segment_key,
)
from changetables.session import materialise


def moves_key(keys: Sequence[str], may_lack: bool = False) -> Column:
    """Updates to another key; a key that the after image may lack stays as it was."""
    same = [F.col(f"before.{k}").eqNullSafe(F.col(f"after.{k}")) for k in keys]
    if may_lack:
        same = [~carries("after", k) | s for k, s in zip(keys, same)]
    return (F.col("op") == "update") & ~reduce(lambda a, b: a & b, same)


def _lists_columns(changes: DataFrame) -> bool:
    return "after_present" in changes.columns


def _whole_row(changes: DataFrame) -> Column:
    """The after image; raises for an update that carries only some columns."""
    if not _lists_columns(changes):
        return F.col("after")
    whole = (F.col("op") != "update") | is_whole("after", image_columns(changes))
    message = "an update carries only some columns; see latest_by_key, fold_partial or replay"
    return F.when(whole, F.col("after")).otherwise(F.raise_error(F.lit(message)))


def split_key_updates(
    changes: DataFrame, keys: Sequence[str], keep: Sequence[str] = (), rows: bool = True
) -> DataFrame:
    """Changes as per-key actions: ``row`` is the new row, null for a removal.

    An update that moves the key removes the old key (sub 0) and writes the new one
    (sub 1), in this order. ``creates`` marks actions that need their key to be free.
    Without ``rows`` only the keys of the images are read. An update whose after image
    lacks the key (``after_present``) keeps it; one that lacks other columns has no new
    row by itself and raises if ``rows`` are wanted.
    """
    row_type = changes.schema["after"].dataType.simpleString()
    may_lack = _lists_columns(changes)
    moves = moves_key(keys, may_lack)
    deletes, inserts = F.col("op") == "delete", F.col("op") == "insert"

    def key(side: str, name: str) -> Column:
        if side == "after" and may_lack:
            kept = (F.col("op") == "update") & ~carries("after", name)
            return F.when(kept, F.col(f"before.{name}")).otherwise(F.col(f"after.{name}"))
        return F.col(f"{side}.{name}")

    def action(sub: int, row: Column, creates: Column, side: str) -> Column:
        return F.struct(
            F.lit(sub).alias("sub"),
            F.lit(sub == 0).alias("removes"),
            creates.alias("creates"),
            *([row.cast(row_type).alias("row")] if rows else []),
            *[key(side, k).alias(k) for k in keys],
        )

    actions = [
        F.when(deletes | moves, action(0, F.lit(None), F.lit(False), "before")),
        F.when(inserts | (F.col("op") == "update"), action(1, _whole_row(changes), inserts | moves, "after")),
    ]
    header = [*keep, "op", order_key().alias("at")]
    return explode_present(changes, header, actions, "a").select(*keep, "op", "at", "a.*")


def latest_actions(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last action per key: the new row, or null if the key is gone.

    A maximum per key combines on the map side, so a key holding a third of the log
    sends one row per task.
    """
    actions = split_key_updates(changes, keys)
    return actions.groupBy(*keys).agg(
        F.max_by(F.struct("row"), F.struct("at", "sub"))["row"].alias("row"),
        F.max(F.struct("at", "sub")).alias("at"),
    )


def latest_by_key(
    changes: DataFrame,
    keys: Sequence[str],
    base: DataFrame | None = None,
    defaults: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Current rows: the last writer of each key wins; keys are never NULL.

    Equals the ordered replay if ``base`` was consistent with the log's start. The
    base is only anti-joined with the changed keys; if adaptive execution finds
    those small, they are broadcast.

    Images that carry only some columns (``before_present``, ``after_present``) are
    folded per column, see ``fold_partial``; an insert takes ``defaults`` for those it
    lacks. If one of them moves a row whose other columns it does not carry, or lacks the
    key in its before image, the whole log is replayed exactly.
    """
    partial, keys_leave_open = partial_kinds(changes, keys)
    if keys_leave_open:
        return exact.expand_copies(exact.replay(changes, base, defaults=defaults))
    if partial:
        return fold_partial(changes, base, keys, defaults)
    rows = latest_actions(changes, keys).filter("row is not null").select("row.*")
    if base is None:
        return rows
    touched = split_key_updates(changes, keys, rows=False).select(*keys).distinct()
    return base.join(touched, list(keys), "left_anti").unionByName(rows)


def key_actions_with_liveness(
    changes: DataFrame,
    keys: Sequence[str],
    base: DataFrame | None = None,
    segment_bytes: int = SEGMENT_BYTES,
    hot_rows: int = HOT_ROWS,
    idle: DataFrame | None = None,
) -> DataFrame:
    """Actions plus ``was_live``: did the key exist just before the action?

    Inserts, removals and key moves change whether a key exists; an update in place
    does not, nor do the moves at the positions ``idle`` (at), which found no row.
    """
    split = split_key_updates(changes, keys, ["file_seq", "pos"], rows=False)
    if idle is not None:
        unmoved = idle.select("at", F.lit("update").alias("op"), F.lit(1).alias("sub"))
        split = split.join(unmoved, ["at", "op", "sub"], "left_anti")
    actions = split.select(
        *keys,
        "op",
        "at",
        "sub",
        "creates",
        segment_key(segment_bytes).alias("segment"),
        F.when(F.col("creates"), True).when(F.col("removes"), False).alias("__live"),
    )
    if base is not None:
        start = base.select(
            *keys,
            before_all().alias("at"),
            F.lit(0).alias("sub"),
            segment_before_all().alias("segment"),
            F.lit(True).alias("__live"),
        )
        actions = actions.unionByName(start, allowMissingColumns=True)
    scanned = keyed_scan(
        actions,
        keys,
        ["at", "sub"],
        "segment",
        [Scan("was_live", "last_before", F.col("__live"))],
        hot_rows,
    )
    return scanned.filter("op is not null").select(
        *keys, "op", "at", "sub", "creates", F.coalesce("was_live", F.lit(False)).alias("was_live")
    )


def idle_moves(
    changes: DataFrame,
    keys: Sequence[str],
    base: DataFrame | None = None,
    segment_bytes: int = SEGMENT_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Positions (at) of key moves whose old key did not exist, so that they changed nothing.

    A key exists if its row was inserted, or moved there by a move that did find a row,
    since its last removal. What a move puts down is taken away by the next removal of the
    new key: if that is a move, too, the first leads to it. So every move has at most one
    successor, and the moves that found a row are those that can be reached from one whose
    key was inserted. One scan finds inserts and successors; following them takes a
    logarithmic number of joins of moves only.
    """
    op, removes = F.col("op"), F.col("removes")
    actions = split_key_updates(changes, keys, ["file_seq", "pos"], rows=False).select(
        *keys,
        "op",
        "at",
        "sub",
        "removes",
        "creates",
        segment_key(segment_bytes).alias("segment"),
        F.when(removes, False).when(op == "insert", True).alias("__sure"),
        F.when(removes, F.struct("at", (op == "update").alias("moves"))).alias("__gone"),
    )
    if base is not None:
        start = base.select(
            *keys,
            before_all().alias("at"),
            F.lit(0).alias("sub"),
            segment_before_all().alias("segment"),
            F.lit(True).alias("__sure"),
        )
        actions = actions.unionByName(start, allowMissingColumns=True)
    scans = [Scan("sure", "last_before", F.col("__sure")), Scan("gone", "next_after", F.col("__gone"))]
    scanned = keyed_scan(actions, keys, ["at", "sub"], "segment", scans, hot_rows)
    moves = materialise(
        scanned.filter((op == "update") & (removes | F.col("creates"))).select("at", "removes", "sure", "gone"), "moves"
    )
    starts = moves.filter(removes & F.col("sure")).select(F.col("at").alias("id"))
    led = F.when(F.col("gone.moves"), F.col("gone.at"))
    links = moves.filter(~removes).select(F.col("at").alias("id"), led.alias("next"))
    found = reachable(links, starts).withColumnRenamed("id", "at")
    return moves.filter("removes").select("at").join(found, "at", "left_anti")


def conflicts(
    changes: DataFrame,
    keys: Sequence[str],
    base: DataFrame | None = None,
    segment_bytes: int = SEGMENT_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Inserts, and updates moving a row, into a key that exists already.

    A move whose old key does not exist finds no row and creates nothing; whether it
    exists may depend on a chain of earlier moves, see ``idle_moves``.
    """
    idle = None
    if not changes.filter(moves_key(keys, _lists_columns(changes))).isEmpty():
        idle = materialise(idle_moves(changes, keys, base, segment_bytes, hot_rows), "idle-moves")
    actions = key_actions_with_liveness(changes, keys, base, segment_bytes, hot_rows, idle)
    return actions.filter("creates and was_live").select(*keys, "op", "at.*")


def halt_at_first_conflict(
    changes: DataFrame,
    keys: Sequence[str],
    base: DataFrame | None = None,
    segment_bytes: int = SEGMENT_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The changes before the first conflict, rows of the same event included."""
    found = conflicts(changes, keys, base, segment_bytes, hot_rows)
    first = found.select(order_key().alias("at")).agg(F.min("at").alias("first")).scalar()
    return changes.filter(F.coalesce(order_key() < first, F.lit(True)))


def fold_partial(
    changes: DataFrame,
    base: DataFrame | None,
    keys: Sequence[str],
    defaults: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Current rows from updates that carry only some columns.

    ``after_present`` names the columns of each after image; a column that is present
    with NULL is set to NULL, one that is absent keeps its value (or, for an insert,
    takes its default). Updates of a key that does not exist change nothing. An
    update that moves the key must carry the whole row.
    """
    defaults = defaults or {}
    names = image_columns(changes)
    others = [c for c in names if c not in keys]
    if base is None:
        base = changes.sparkSession.createDataFrame([], changes.schema["after"].dataType)
    whole = is_whole("after", names)
    moves = F.coalesce(moves_key(keys, True), F.lit(False))
    checked = F.when(
        moves & ~whole, F.raise_error(F.lit("an update that moves the key needs a whole row"))
    ).otherwise(moves)
    marked = changes.withColumn("__moves", checked)

    def key_of(side: Column) -> list[Column]:
        return [
            F.when(side == "before", F.col(f"before.{k}")).otherwise(F.col(f"after.{k}")).alias(k)
            for k in keys
        ]

    def step(kind: str, sub: int, side: str) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), F.lit(sub).alias("sub"), F.lit(side).alias("side")
        )

    op = F.col("op")
    steps = [
        F.when((op == "delete") | F.col("__moves"), step("drop", 0, "before")),
        F.when((op == "insert") | F.col("__moves"), step("reset", 1, "after")),
        F.when((op == "update") & ~F.col("__moves"), step("set", 1, "before")),
    ]
    header = [order_key().alias("at"), "before", "after", "after_present"]
    actions = explode_present(marked, header, steps, "s").select(
        "at", "after", "after_present", "s.kind", "s.sub", *key_of(F.col("s.side"))
    )

    when = F.struct("at", "sub")
    folded = []
    for name in others:
        given = carries("after", name)
        value = F.when(given, F.col(f"after.{name}")).otherwise(defaults.get(name, F.lit(None)))
        touched = F.when((F.col("kind") == "reset") | ((F.col("kind") == "set") & given), when)
        folded.append(F.max_by(F.struct(value.alias("v")), touched).alias(f"__{name}"))
    state = actions.groupBy(*keys).agg(
        F.max_by(F.col("kind") == "reset", F.when(F.col("kind") != "set", when)).alias("__alive"),
        *folded,
    )
    reset = state.filter("__alive").select(
        *keys, *[F.col(f"__{c}.v").alias(c) for c in others]
    )
    kept = (
        base.join(state, list(keys), "left")
        .filter("__alive is null")
        .select(
            *keys,
            *[
                F.when(F.col(f"__{c}").isNotNull(), F.col(f"__{c}.v")).otherwise(F.col(c)).alias(c)
                for c in others
            ],
        )
    )
    return kept.unionByName(reset).select(*names)


def history(
    changes: DataFrame,
    keys: Sequence[str],
    keep: Sequence[str] = (),
    segment_bytes: int = SEGMENT_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every version of every row with the positions it held between.

    ``valid_to`` is null for the current version. ``keep`` names log columns, such as
    the event time, to carry along as ``<name>`` and ``<name>_to``.
    """
    carried = sorted({"file_seq", "pos", *keep})
    actions = split_key_updates(changes, keys, keep=carried).withColumn(
        "segment", segment_key(segment_bytes)
    )
    closing = F.struct("at", *keep)
    scanned = keyed_scan(
        actions, keys, ["at", "sub"], "segment", [Scan("next", "next_after", closing)], hot_rows
    )
    return scanned.filter("row is not null").select(
        "row.*",
        F.col("at").alias("valid_from"),
        F.col("next.at").alias("valid_to"),
        *[F.col(c).alias(c) for c in keep],
        *[F.col(f"next.{c}").alias(f"{c}_to") for c in keep],
    )
