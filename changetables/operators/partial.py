"""Exact replay of row images that carry only some of a table's columns.

A delete or update acts on every row that equals its before image in the columns that
the image carries; an update sets the columns that its after image carries and leaves
the others as they were. A row is a token, as in exact replay, and its next change is
the first later one of any presence pattern whose carried values it has: for each
pattern the tokens are looked up by their projection on it, and the least position over
the patterns wins.

What a change puts down is known only in the columns of its two images. A link to the
next change is settled at once where those columns decide it. They always do where all
patterns name the same key, or where before images are whole or lack the same columns.
Settled links are followed by pointer doubling, with the assignments on the way folded
into one. Where they leave it open, the token stops, gets its whole row and is looked up
again; each such round passes one open change of a chain.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changetables.plans.chase import resolve_roots
from changetables.plans.scan import HOT_ROWS, Scan, keyed_scan
from changetables.schema import (
    SEGMENT_BYTES,
    before_all,
    image_columns,
    order_key,
    segment_before_all,
    segment_key,
)
from changetables.session import fits, materialise

PRESENT = ("before_present", "after_present")

#: Up to this many pairs of patterns are sent to every executor.
SMALL_PATTERNS = 10_000


def carries(side: str, name: str) -> Column:
    """Does the image ``before`` or ``after`` carry a column? Without a list, all of them."""
    return F.coalesce(F.array_contains(f"{side}_present", F.lit(name)), F.lit(True))


def is_whole(side: str, names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [carries(side, n) for n in names])


def partial_kinds(changes: DataFrame, keys: Sequence[str] = ()) -> tuple[bool, bool]:
    """Are there partial images; and such that keys alone do not decide?

    The second holds for updates that move the key without their whole row and for before
    images without the key. Logs without presence columns are not read.
    """
    if not set(PRESENT) <= set(changes.columns):
        return False, False
    names = image_columns(changes)
    takes, puts = F.col("op").isin("update", "delete"), F.col("op").isin("insert", "update")
    whole = (~takes | is_whole("before", names)) & (~puts | is_whole("after", names))
    hard = F.lit(False)
    if keys:
        moved = [carries("after", k) & ~F.col(f"before.{k}").eqNullSafe(F.col(f"after.{k}")) for k in keys]
        moves = (F.col("op") == "update") & reduce(lambda a, b: a | b, moved)
        hard = (takes & ~is_whole("before", keys)) | (moves & ~is_whole("after", names))
    found = changes.agg(F.max(~whole), F.max(hard)).first()
    return bool(found[0]), bool(found[1])


def _flags(side: str, names: Sequence[str]) -> Column:
    """A digit for each column: 1 if the image carries it."""
    return F.concat(*[F.when(carries(side, n), "1").otherwise("0") for n in names])


def _both(known: Column, pattern: str) -> Column:
    return F.concat(*[F.substr(known, F.lit(i + 1), F.lit(1)) if p == "1" else F.lit("0") for i, p in enumerate(pattern)])


def _either(a: Column, b: Column, width: int) -> Column:
    digit = lambda x, i: F.substr(x, F.lit(i + 1), F.lit(1))
    return F.concat(*[F.greatest(digit(a, i), digit(b, i)) for i in range(width)])


def _projected(row: str, flags: Column, names: Sequence[str]) -> list[Column]:
    """The values of the flagged columns, the others null, each under a name of its own."""
    return [
        F.when(F.substr(flags, F.lit(i + 1), F.lit(1)) == "1", F.col(f"{row}.`{n}`")).alias(f"__k{i}")
        for i, n in enumerate(names)
    ]


def _next_changes(
    nodes: DataFrame, takes: DataFrame, patterns: list[str], names: list[str], segment_bytes: int, hot_rows: int
) -> DataFrame:
    """``nodes`` (__row, __known, __at, __segment, …) with ``__next`` (at, erases) and ``__open``.

    ``__open``: a change before the next one agrees in all columns that are known, but
    carries others. Nodes are one row each, by position and row.
    """
    keep = nodes.columns
    looked_up = [
        F.struct(F.lit(p).alias("pattern"), _both(F.col("__known"), p).alias("shared")) for p in patterns
    ]
    asked = nodes.select(*keep, F.explode(F.array(*looked_up)).alias("p")).select(
        *keep, F.col("p.pattern").alias("__pattern"), F.col("p.shared").alias("__shared")
    )
    pairs = materialise(asked.select("__pattern", "__shared").distinct(), "patterns")
    if fits(pairs, SMALL_PATTERNS):
        pairs = F.broadcast(pairs)
    by = ["__pattern", "__shared", *[f"__k{i}" for i in range(len(names))]]
    hits = takes.join(pairs, "__pattern").select(
        "__pattern",
        "__shared",
        *_projected("__before", F.col("__shared"), names),
        "__at",
        "__segment",
        F.lit(0).alias("__role"),
        F.struct(F.col("__at").alias("at"), F.col("__erases").alias("erases")).alias("__hit"),
    )
    sought = asked.select(
        *keep, "__pattern", "__shared", *_projected("__row", F.col("__shared"), names), F.lit(1).alias("__role")
    )
    scanned = keyed_scan(
        sought.unionByName(hits, allowMissingColumns=True),
        by,
        ["__at", "__role"],
        "__segment",
        [Scan("__next", "next_after", F.col("__hit"))],
        hot_rows,
    ).filter("__role = 1")
    settled = F.col("__pattern") == F.col("__shared")
    if len(patterns) == 1:
        first = scanned.select(
            *keep, F.when(settled, F.col("__next")).alias("__next"), F.when(~settled, F.col("__next")).alias("__maybe")
        )
    else:
        rest = [c for c in keep if c not in ("__at", "__row")]
        first = scanned.groupBy("__at", "__row").agg(
            *[F.first(c).alias(c) for c in rest],
            F.min(F.when(settled, F.col("__next"))).alias("__next"),
            F.min(F.when(~settled, F.col("__next"))).alias("__maybe"),
        )
    is_open = F.col("__maybe").isNotNull() & F.coalesce(F.col("__maybe.at") < F.col("__next.at"), F.lit(True))
    return first.select(*keep, "__next", is_open.alias("__open"))


def replay_partial(
    changes: DataFrame,
    base: DataFrame | None = None,
    defaults: Mapping[str, Column] | None = None,
    segment_bytes: int = SEGMENT_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Distinct rows with their number of ``copies`` after ``changes`` (see ``replay``).

    ``before_present`` and ``after_present`` name the columns that the images carry; a
    list that is null stands for all. An insert gives absent columns their ``defaults``
    (an expression each, NULL where there is none). A change without any before column
    would act on the whole table and raises.
    """
    names = image_columns(changes)
    typed = changes.schema["after"].dataType.simpleString()
    defaults = defaults or {}
    for name in set(PRESENT) - set(changes.columns):
        changes = changes.withColumn(name, F.lit(None).cast("array<string>"))
    takes_op, puts_op = F.col("op").isin("update", "delete"), F.col("op").isin("insert", "update")
    nothing = "0" * len(names)
    acts = changes.filter(takes_op | puts_op).select(
        "op",
        "before",
        "after",
        F.when(takes_op, _flags("before", names)).alias("__pattern"),
        F.when(puts_op, _flags("after", names)).alias("__sets"),
        order_key().alias("__at"),
        segment_key(segment_bytes).alias("__segment"),
    )
    checked = F.when(F.col("__pattern") == nothing, F.raise_error(F.lit("a before image carries no column")))
    acts = materialise(acts.withColumn("__pattern", checked.otherwise(F.col("__pattern"))), "partial-changes")
    takes = acts.filter(takes_op).select(
        "__pattern", F.col("before").alias("__before"), (F.col("op") == "delete").alias("__erases"), "__at", "__segment"
    )
    # one entry for each set of columns that before images carry
    patterns = sorted(r[0] for r in takes.select("__pattern").distinct().collect())

    def set_in(i: int) -> Column:
        return F.substr("__sets", F.lit(i + 1), F.lit(1)) == "1"

    inserted = [
        F.when(set_in(i), F.col(f"after.`{n}`")).otherwise(defaults.get(n, F.lit(None))).alias(n) for i, n in enumerate(names)
    ]
    known_after = [F.when(set_in(i), F.col(f"after.`{n}`")).otherwise(F.col(f"before.`{n}`")).alias(n) for i, n in enumerate(names)]
    everything = F.lit("1" * len(names))
    row = F.when(F.col("op") == "insert", F.struct(*inserted)).otherwise(F.struct(*known_after)).cast(typed)
    nodes = acts.filter(puts_op).select(
        row.alias("__row"),
        F.when(F.col("op") == "insert", everything).otherwise(_either(F.col("__pattern"), F.col("__sets"), len(names))).alias("__known"),
        "__at",
        "__segment",
        F.when(F.col("op") == "insert", F.lit(1)).cast("long").alias("__copies"),
        F.struct(
            *[F.when((F.col("op") == "update") & set_in(i), F.struct(F.col(f"after.`{n}`").alias("v"))).alias(f"s{i}") for i, n in enumerate(names)]
        ).alias("__sets"),
    )
    sets_type = nodes.schema["__sets"].dataType.simpleString()
    if base is not None:
        counted = base.groupBy(*names).agg(F.count(F.lit(1)).alias("__copies"))
        nodes = nodes.unionByName(_tokens(counted, names, typed, before_all(), segment_before_all(), sets_type))
    if not patterns:
        return _counted([nodes.select("__row.*", F.col("__copies").alias("copies"))], names)

    linked = materialise(_next_changes(nodes, takes, patterns, names, segment_bytes, hot_rows), "partial-links")
    updates = linked.filter("__copies is null")
    stops = F.col("__open") | F.col("__next").isNull()
    carried = {f"__s{i}": F.col(f"__sets.s{i}") for i in range(len(names))}
    roots = resolve_roots(
        updates.select(
            F.col("__at").alias("id"),
            F.when(~stops, F.col("__next.at")).alias("next"),
            F.when(~stops, F.col("__next.erases")).alias("next_erases"),
            F.struct(F.col("__open").alias("v")).alias("__stops_open"),
            *[c.alias(n) for n, c in carried.items()],
        ),
        ["__stops_open", *carried],
    ).filter("root is not null")

    done: list[DataFrame] = []
    tokens = linked.filter("__copies is not null")
    while True:
        done.append(tokens.filter("__next is null").select("__row.*", F.col("__copies").alias("copies")))
        taken = tokens.filter("not __next.erases").select("__row", F.col("__next.at").alias("id"), "__copies")
        assigned = [
            F.when(F.col(f"__s{i}").isNotNull(), F.col(f"__s{i}.v")).otherwise(F.col(f"__row.`{n}`")).alias(n)
            for i, n in enumerate(names)
        ]
        moved = taken.join(roots, "id").select(
            *assigned, "__copies", F.col("root").alias("__root"), F.col("__stops_open.v").alias("__again")
        )
        moved = materialise(
            moved.groupBy(*names, "__root", "__again").agg(F.sum("__copies").alias("__copies")), "partial-rows"
        )
        done.append(moved.filter("not __again").select(*names, F.col("__copies").alias("copies")))
        again = moved.filter("__again")
        if again.isEmpty():
            return _counted(done, names)
        segment = F.struct(
            F.col("__root.file_seq").alias("file_seq"),
            F.expr(f"__root.pos div {int(segment_bytes)}").cast("long").alias("part"),
        )
        whole = _tokens(again, names, typed, F.col("__root"), segment, sets_type)
        tokens = materialise(_next_changes(whole, takes, patterns, names, segment_bytes, hot_rows), "partial-links")


def _tokens(rows: DataFrame, names: list[str], typed: str, at: Column, segment: Column, sets_type: str) -> DataFrame:
    """Rows whose every column is known, as nodes."""
    return rows.select(
        F.struct(*names).cast(typed).alias("__row"),
        F.lit("1" * len(names)).alias("__known"),
        at.alias("__at"),
        segment.alias("__segment"),
        F.col("__copies").cast("long").alias("__copies"),
        F.lit(None).cast(sets_type).alias("__sets"),
    )


def _counted(parts: list[DataFrame], names: list[str]) -> DataFrame:
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    return rows.groupBy(*names).agg(F.sum("copies").alias("copies"))
