"""Exact replay onto a bag of rows, with or without a key.

An update or delete acts on every row equal to its before image, NULL equal to NULL.
A row is a token that sits at its value until the first later update or delete of
that value takes it along; an update puts it down at the after image. Which change
takes a token next depends only on value and position, so all changes are linked to
their successors at once and the links are followed by pointer doubling.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changetables.functions.rows import explode_present
from changetables.operators.partial import partial_kinds, replay_partial
from changetables.plans.chase import reachable, resolve_roots
from changetables.plans.scan import HOT_ROWS, Scan, keyed_scan
from changetables.schema import (
    ORDER_TYPE,
    SEGMENT_BYTES,
    before_all,
    image_columns,
    order_key,
    segment_before_all,
    segment_key,
)
from changetables.session import materialise


@dataclass(frozen=True)
class Links:
    """Rows put down by the base, inserts and updates, each with what takes it next.

    Columns: the row's values, ``__at``, ``__copies`` (null for updates, which pass
    on what they take) and ``__next`` (at, erases).
    """

    rows: DataFrame
    values: list[str]

    @property
    def tokens(self) -> DataFrame:
        return self.rows.filter("__copies is not null")

    @property
    def updates(self) -> DataFrame:
        return self.rows.filter("__copies is null")


def link(
    changes: DataFrame,
    base: DataFrame | None = None,
    segment_bytes: int = SEGMENT_BYTES,
    hot_rows: int = HOT_ROWS,
) -> Links:
    """Find the next change acting on every row put down.

    Equal base rows are counted before the shuffle. A value with more than
    ``hot_rows`` entries is spread over the log's segments, so a value that makes up a
    third of the log is not sorted in one task.
    """
    values = image_columns(changes)
    typed = changes.schema["after"].dataType
    takes, puts = F.col("op").isin("update", "delete"), F.col("op").isin("insert", "update")
    hit = F.struct(F.col("__at").alias("at"), (F.col("op") == "delete").alias("erases"))
    no_hit = F.lit(None).cast(f"struct<at:{ORDER_TYPE.simpleString()},erases:boolean>")

    def side(role: int, image: str, hit: Column, copies: Column) -> Column:
        return F.struct(
            F.lit(role).alias("__role"),
            F.col(image).cast(typed).alias("image"),
            hit.alias("__hit"),
            copies.cast("long").alias("__copies"),
        )

    sides = [
        F.when(takes, side(0, "before", hit, F.lit(None))),
        F.when(puts, side(1, "after", no_hit, F.when(F.col("op") == "insert", 1))),
    ]
    placed = changes.select(
        "op", "before", "after", order_key().alias("__at"), segment_key(segment_bytes).alias("__segment")
    )
    rows = explode_present(placed, ["__at", "__segment"], sides, "s").select(
        "__at", "__segment", "s.__role", "s.__hit", "s.__copies", "s.image.*"
    )
    if base is not None:
        counted = base.groupBy(*values).agg(F.count(F.lit(1)).alias("__copies"))
        rows = rows.unionByName(
            counted.select(
                *values,
                "__copies",
                before_all().alias("__at"),
                segment_before_all().alias("__segment"),
                F.lit(1).alias("__role"),
            ),
            allowMissingColumns=True,
        )
    scanned = keyed_scan(
        rows,
        values,
        ["__at", "__role"],
        "__segment",
        [Scan("__next", "next_after", F.col("__hit"))],
        hot_rows,
    )
    return Links(
        scanned.filter("__role = 1").select(*values, "__at", "__copies", "__next"), values
    )


def replay(
    changes: DataFrame,
    base: DataFrame | None = None,
    match: str = "all",
    segment_bytes: int = SEGMENT_BYTES,
    hot_rows: int = HOT_ROWS,
    defaults: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The bag of rows after replaying ``changes`` onto ``base``.

    Returns the distinct rows with their number of ``copies``; see ``expand_copies``.
    ``match="all"``: a change acts on all equal rows and on nothing if there are
    none. ``match="one"``: a change stands for exactly one row, as at its source, and
    needs whole images. Where images carry only some columns (``before_present``,
    ``after_present``), those are matched and set, see ``partial``; an insert takes
    ``defaults`` for the others.
    """
    if match not in ("all", "one"):
        raise ValueError(f"match must be 'all' or 'one', not {match!r}")
    if partial_kinds(changes)[0]:
        if match == "one":
            raise ValueError("match='one' needs whole images")
        return replay_partial(changes, base, defaults, segment_bytes, hot_rows)
    if match == "one":
        return net_copies(changes, base).filter("copies > 0")
    found = link(changes, base, segment_bytes, hot_rows)
    links = Links(materialise(found.rows, "replay"), found.values)
    untouched = (
        links.tokens.filter("__next is null")
        .groupBy(*links.values)
        .agg(F.sum("__copies").alias("copies"))
    )
    taken = (
        links.tokens.filter("not __next.erases")
        .groupBy(F.col("__next.at").alias("id"))
        .agg(F.sum("__copies").alias("copies"))
    )
    roots = resolve_roots(
        links.updates.select(
            F.col("__at").alias("id"),
            F.col("__next.at").alias("next"),
            F.col("__next.erases").alias("next_erases"),
        )
    )
    landed = (
        taken.join(roots.filter("root is not null"), "id")
        .groupBy("root")
        .agg(F.sum("copies").alias("copies"))
    )
    moved = links.updates.join(landed, F.col("__at") == F.col("root")).select(*links.values, "copies")
    return (
        untouched.unionByName(moved).groupBy(*links.values).agg(F.sum("copies").alias("copies"))
    )


def replay_append_delete(
    changes: DataFrame,
    base: DataFrame | None = None,
    segment_bytes: int = SEGMENT_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Replay of a log of inserts and deletes only: rows no later delete matches.

    No chain has to be followed, so nothing is written in between.
    """
    found = link(
        changes.filter(F.col("op").isin("insert", "delete")), base, segment_bytes, hot_rows
    )
    return (
        found.tokens.filter("__next is null")
        .groupBy(*found.values)
        .agg(F.sum("__copies").alias("copies"))
    )


def net_copies(changes: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """Copies of each row if every change stands for one row; below 0 shows drift."""
    values = image_columns(changes)
    typed = changes.schema["after"].dataType
    signed = lambda n, side: F.struct(
        F.lit(n).cast("long").alias("n"), F.col(side).cast(typed).alias("image")
    )
    sides = [
        F.when(F.col("op").isin("update", "delete"), signed(-1, "before")),
        F.when(F.col("op").isin("insert", "update"), signed(1, "after")),
    ]
    rows = explode_present(changes, [], sides, "s").select("s.image.*", "s.n")
    if base is not None:
        rows = rows.unionByName(base.select(*values, F.lit(1).cast("long").alias("n")))
    return rows.groupBy(*values).agg(F.sum("n").alias("copies")).filter("copies <> 0")


def unmatched_changes(
    changes: DataFrame,
    base: DataFrame | None = None,
    segment_bytes: int = SEGMENT_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Updates and deletes that met no row at all when they were replayed."""
    found = link(changes, base, segment_bytes, hot_rows)
    links = Links(materialise(found.rows, "unmatched"), found.values)
    hops = links.updates.select(F.col("__at").alias("id"), F.col("__next.at").alias("next"))
    starts = links.tokens.filter("__next is not null").select(F.col("__next.at").alias("id"))
    met = reachable(hops, starts).withColumnRenamed("id", "__at")
    consumers = changes.filter(F.col("op").isin("update", "delete"))
    return (
        consumers.withColumn("__at", order_key()).join(met, "__at", "left_anti").drop("__at")
    )


def expand_copies(rows: DataFrame, chunk: int = 100_000) -> DataFrame:
    """Repeat each row ``copies`` times.

    Counts are first cut into chunks that are spread over the tasks, so a row with
    very many copies is not written by one of them.
    """
    values = [c for c in rows.columns if c != "copies"]
    chunks = F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / F.lit(chunk)))
    spread = rows.filter("copies > 0").select("*", F.explode(chunks).alias("__chunk"))
    left = F.least(F.lit(chunk), F.col("copies") - F.col("__chunk") * F.lit(chunk)).cast("int")
    return (
        spread.withColumn("__left", left)
        .repartition(*values, "__chunk")
        .select(*values, F.explode(F.sequence(F.lit(1), F.col("__left"))).alias("__copy"))
        .select(*values)
    )
