"""Continuous apply of a change log to keyed tables.

Every micro-batch is reduced to one action per key, written to a fresh delta folder and
then recorded in the target's progress ledger, which gives it the target's own next
number (see ``state``). Readers see recorded folders only. A batch that comes again is
known by its query and number: recorded, it is skipped; unrecorded, its first attempt is
never read. A new query with a new checkpoint folder goes on numbering where the last one
stopped. Every action keeps its log position, and readers take the highest one per key, so
the result does not depend on how files were cut into batches or in which order they
came. Removals are kept as rows without content for the same reason. A target has one
running query at a time.

A log of many tables may hold DDL statements. What they erase or rename is decided when the
tables are read, by position, so a TRUNCATE or DROP may arrive in any order. A RENAME must
not arrive after changes that follow it in the log, since a name's rows before and after it
are kept apart from then on; such a batch raises.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from changetables.functions.ddl import with_ddl
from changetables.functions.rows import explode_present
from changetables.functions.text import trim_space
from changetables.operators.ddl_effects import ddl_effects
from changetables.operators.keyed import latest_actions, moves_key
from changetables.operators.partial import carries, is_whole
from changetables.plans.asof import asof_lookup
from changetables.schema import SEGMENT_BYTES, before_all, order_key, position_key, segment_key
from changetables.session import materialise
from changetables.sources.versions import read_or_empty
from changetables.streaming.state import (
    RESET,
    TableSet,
    Target,
    applied,
    cell_of,
    clean,
    compact,
    create,
    last_attempt,
    latest,
    list_names,
    live_rows,
    merge_state,
    progress,
    read_current,
    read_current_table,
    read_effects,
    read_state,
    write_batch,
)

__all__ = [
    "TableSet", "Target", "apply_batch", "clean", "committed", "compact", "create", "drain", "latest_actions", "live_rows",
    "merge_state", "read_current", "read_current_table", "read_state", "read_unlisted", "start_apply",
    "start_apply_tables", "table_actions", "target_actions", "unlisted_changes",
]

apply_batch = write_batch


def _at(sub: int) -> Column:
    return F.struct(order_key().alias("at"), F.lit(sub).alias("sub"))


def _reset(at: Column, alive: bool) -> Column:
    return F.struct(at.alias("at"), F.lit(alive).alias("alive"))


def target_actions(changes: DataFrame, target: Target) -> DataFrame:
    """The last action per key of typed changes, as the target's state holds it.

    For a partial target: each column's last value and the last insert or removal. An
    update that moves the key must carry the whole row, and before images their key.
    """
    keys = list(target.keys)
    if not target.partial:
        return latest_actions(changes, keys)
    for side in ("before", "after"):
        if f"{side}_present" not in changes.columns:
            changes = changes.withColumn(f"{side}_present", F.lit(None).cast("array<string>"))
    op = F.col("op")
    moves = F.coalesce(moves_key(keys, True), F.lit(False))
    unknown = (op != "insert") & ~is_whole("before", keys)
    checked = (
        F.when(unknown, F.raise_error(F.lit("a before image lacks the key")))
        .when(moves & ~is_whole("after", target.fields.names), F.raise_error(F.lit("an update that moves the key needs a whole row")))
        .otherwise(moves)
    )

    def action(sub: int, side: str, alive: bool | None, filled: bool) -> Column:
        at, cells = _at(sub), []
        for f in target.others:
            given = F.col(f"after.`{f.name}`")
            default = F.lit(target.defaults.get(f.name)).cast(f.dataType)
            cell = F.struct(at.alias("at"), F.when(carries("after", f.name), given).otherwise(default).alias("v"))
            use = F.lit(True) if filled else (carries("after", f.name) if alive is None else F.lit(False))
            cells.append(F.when(use, cell).cast(cell_of(f.dataType)).alias(f.name))
        return F.struct(
            *[F.col(f"{side}.`{k}`").alias(k) for k in keys],
            F.lit(None).cast(RESET).alias("reset") if alive is None else _reset(at, alive).alias("reset"),
            F.struct(*cells).alias("cells"),
            at.alias("at"),
        )

    moved = F.col("__moves")
    steps = [
        F.when((op == "delete") | moved, action(0, "before", False, False)),
        F.when((op == "insert") | moved, action(1, "after", True, True)),
        F.when((op == "update") & ~moved, action(1, "before", None, False)),
    ]
    actions = explode_present(changes.withColumn("__moves", checked), [], steps, "a").select("a.*")
    return latest(actions, target)


def _query_of(spark: SparkSession, checkpoint: str) -> str:
    """The identity that Spark keeps in a checkpoint folder."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def committed(
    batch: DataFrame, target: Target | TableSet, query: str, batch_id: int
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The changes of committed transactions, and what the next batch needs.

    A change waits until its source logs a commit (an XID event, or the statement COMMIT)
    behind it. Changes that wait are written beside the batch, whole, and join the next one;
    they are one open transaction per source if the log arrives in order. A change that comes
    after its commit is applied at once.
    """
    spark = batch.sparkSession
    before = last_attempt(spark, target) if batch_id > applied(spark, target, query)[1] else None
    statement = F.lower(trim_space(F.coalesce("query", F.lit("")))) if "query" in batch.columns else F.lit("")
    is_commit = (F.col("event_type") == "XIDEvent") | (statement == "commit")
    at = position_key(batch)
    marks = batch.filter(is_commit).select("source_id", at.alias("upto"))
    rows = batch.filter(~F.coalesce(is_commit, F.lit(False)))
    if before is not None and list_names(spark, f"{target.root}/held/{before}"):
        rows = spark.read.schema(batch.schema).parquet(f"{target.root}/held/{before}").unionByName(rows)
        marks = spark.read.schema(marks.schema).parquet(f"{target.root}/commits/{before}").unionByName(marks)
    marks = materialise(marks.groupBy("source_id").agg(F.max("upto").alias("upto")), "commits")
    placed = rows.withColumn("__at", position_key(rows)).join(
        marks.withColumnRenamed("source_id", "__source"), F.col("source_id").eqNullSafe(F.col("__source")), "left"
    )
    is_ready = F.coalesce(F.col("__at") <= F.col("upto"), F.lit(False))
    sides = placed.withColumn("__ready", is_ready).drop("__at", "upto", "__source")
    waiting = sides.filter("not __ready").drop("__ready")
    return sides.filter("__ready").drop("__ready"), {"held": waiting, "commits": marks}


def start_apply(
    stream: DataFrame,
    target: Target,
    checkpoint: str,
    *,
    engine: str = "deltas",
    trigger: Mapping | None = None,
    commits: bool = False,
) -> StreamingQuery:
    """Apply a stream of typed changes to one table until stopped.

    ``deltas`` reduces each micro-batch by itself. ``state`` keeps the last action of
    every key in the state store and emits each key's current action as it changes;
    it suits short triggers. ``trigger`` takes ``DataStreamWriter.trigger`` arguments
    and defaults to ``availableNow``, which drains what has arrived and stops. With
    ``commits`` (of the engine ``deltas``) the stream also has the log's commit events, and
    readers never see a part of a transaction, see ``committed``.
    """
    if commits and engine != "deltas":
        raise ValueError("commits needs the engine 'deltas'")
    if engine not in ("deltas", "state"):
        raise ValueError(f"engine must be 'deltas' or 'state', not {engine!r}")

    def apply(actions: DataFrame, batch_id: int) -> None:
        write_batch(actions, batch_id, target, _query_of(actions.sparkSession, checkpoint))

    def whole(batch: DataFrame, batch_id: int) -> None:
        query = _query_of(batch.sparkSession, checkpoint)
        ready, beside = committed(batch, target, query, batch_id)
        write_batch(target_actions(ready.filter("op is not null"), target), batch_id, target, query, beside=beside)

    if engine == "state":
        writer = target_actions(stream, target).writeStream.outputMode("update").foreachBatch(apply)
    elif commits:
        writer = stream.writeStream.foreachBatch(whole)
    else:
        writer = stream.writeStream.foreachBatch(lambda batch, batch_id: apply(target_actions(batch, target), batch_id))
    return writer.option("checkpointLocation", checkpoint).trigger(
        **(trigger or {"availableNow": True})
    ).start()


def table_actions(changes: DataFrame, tables: TableSet, renames: DataFrame | None = None) -> DataFrame:
    """The last action per table, epoch and key of name/value changes to many tables.

    The list of tables comes from the driver and is broadcast; ``unlisted_changes`` are
    the others. A name that an after image lacks was not changed. ``renames`` are the
    effects that start a new epoch for a name.
    """
    if renames is None:
        changes = changes.withColumn("epoch", before_all())
    else:
        changes = _with_epochs(changes, renames)
    known = changes.join(F.broadcast(_listed(changes.sparkSession, tables)), ["schema_name", "table_name"])
    op, before, after = F.col("op"), F.col("before"), F.col("after")
    new = lambda n: F.when((op == "update") & ~F.map_contains_key(after, n), before[n]).otherwise(after[n])
    keyed = known.withColumns(
        {"__old": F.transform("key_names", lambda n: before[n]), "__new": F.transform("key_names", new)}
    )
    moves = (op == "update") & (F.col("__old") != F.col("__new"))
    lacking = F.size(F.array_except(F.map_keys(before), F.map_keys(after))) > 0
    text = "map<string,string>"
    if not tables.partial:

        def action(sub: int, key: Column, row: Column) -> Column:
            return F.struct(key.alias("key"), row.cast(text).alias("row"), _at(sub).alias("at"))

        message = "an update carries only some columns; use a partial set of tables"
        row = F.when((op == "update") & lacking, F.raise_error(F.lit(message))).otherwise(after)
        steps = [
            F.when((op == "delete") | moves, action(0, F.col("__old"), F.lit(None))),
            F.when(op.isin("insert", "update"), action(1, F.col("__new"), row)),
        ]
    else:
        cells = F.transform_values(after, lambda _, v: F.struct(_at(1).alias("at"), v.alias("v")))
        none = F.lit(None)

        def action(sub: int, key: Column, alive: bool | None, cells: Column) -> Column:
            reset = none.cast(RESET) if alive is None else _reset(_at(sub), alive)
            held = cells.cast(T.MapType(T.StringType(), cell_of(T.StringType())))
            return F.struct(key.alias("key"), reset.alias("reset"), held.alias("cells"), _at(sub).alias("at"))

        message = "an update that moves the key needs a whole row"
        moved_cells = F.when(~lacking, cells).otherwise(F.raise_error(F.lit(message)))
        steps = [
            F.when((op == "delete") | moves, action(0, F.col("__old"), False, none)),
            F.when(op == "insert", action(1, F.col("__new"), True, cells)),
            F.when(moves, action(1, F.col("__new"), True, moved_cells)),
            F.when((op == "update") & ~moves, action(1, F.col("__old"), None, cells)),
        ]
    actions = explode_present(keyed, ["schema_name", "table_name", "epoch"], steps, "a")
    return latest(actions.select("schema_name", "table_name", "epoch", "a.*"), tables)


def _with_epochs(changes: DataFrame, renames: DataFrame) -> DataFrame:
    """``epoch``: the last rename to or from a change's table before it."""
    names = F.array(
        F.struct(F.col("schema_name").alias("s"), F.col("table_name").alias("t")),
        F.struct(F.col("to_schema").alias("s"), F.col("to_table").alias("t")),
    )
    marks = renames.select("file_seq", "pos", "ordinal", F.explode(names).alias("x")).select(
        F.col("x.s").alias("schema_name"),
        F.col("x.t").alias("table_name"),
        order_key().alias("__at"),
        segment_key().alias("__segment"),
        order_key().alias("__epoch"),
    )
    placed = changes.withColumns({"__at": order_key(), "__segment": segment_key(SEGMENT_BYTES)})
    found = asof_lookup(placed, marks.distinct(), ["schema_name", "table_name"], "__at", "__segment", "__epoch")
    return found.withColumn("epoch", F.coalesce("__epoch", before_all())).drop("__at", "__segment", "__epoch")


def _listed(spark: SparkSession, tables: TableSet) -> DataFrame:
    return spark.createDataFrame(
        [(*name, list(keys)) for name, keys in tables.tables.items()],
        "schema_name string, table_name string, key_names array<string>",
    )


def unlisted_changes(changes: DataFrame, tables: TableSet) -> DataFrame:
    """Changes to tables that the set does not list, whole."""
    return changes.join(F.broadcast(_listed(changes.sparkSession, tables)), ["schema_name", "table_name"], "left_anti")


def read_unlisted(spark: SparkSession, tables: TableSet, schema: T.StructType) -> DataFrame:
    """What ``start_apply_tables`` set aside, a batch that was repeated only once."""
    marked = T.StructType([*schema.fields, T.StructField("query", T.StringType()), T.StructField("batch", T.LongType())])
    return read_or_empty(spark, f"{tables.root}/unlisted", marked).select(*schema.names)


def apply_tables_batch(batch: DataFrame, batch_id: int, tables: TableSet, query: str = "") -> None:
    """Apply one batch of row changes and, where it has a column ``query``, statements."""
    spark = batch.sparkSession
    if batch_id <= applied(spark, tables, query)[1]:
        return
    changes, effects, renames = batch, None, None
    if "query" in batch.columns:
        changes = batch.filter("op is not null")
        found = ddl_effects(with_ddl(batch.filter("op is null and query is not null")))
        effects = materialise(found, "effects")
        known = read_effects(spark, tables)
        renames = (effects if known is None else known.unionByName(effects)).filter("action = 'rename'").distinct()
        if renames.isEmpty():
            renames = None
        else:
            _refuse_late(effects, tables)
    others = unlisted_changes(changes, tables)
    if others.take(1):
        others.write.mode("overwrite").parquet(f"{tables.root}/unlisted/query={query}/batch={batch_id}")
    write_batch(table_actions(changes, tables, renames), batch_id, tables, query, effects)


def _refuse_late(effects: DataFrame, tables: TableSet) -> None:
    """Raise if a rename precedes a position that was applied already."""
    at = F.struct("file_seq", "pos")
    first = effects.filter("action = 'rename'").agg(F.min(at)).first()[0]
    last = progress(effects.sparkSession, tables).agg(F.max(F.when(F.col("pos").isNotNull(), at))).first()[0]
    if first is not None and last is not None and tuple(first) < tuple(last):
        raise ValueError(f"a RENAME at {tuple(first)} came after changes up to {tuple(last)} were applied")


def start_apply_tables(
    stream: DataFrame, tables: TableSet, checkpoint: str, trigger: Mapping | None = None
) -> StreamingQuery:
    """Apply one log of name/value changes to many tables, routed by table name.

    Rows without ``op`` are statements: their column ``query`` is read for DDL. Changes to
    tables that are not listed go whole to the folder ``unlisted`` under the set's root, by
    query and batch, so a table that appears while the stream runs is kept.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        apply_tables_batch(batch, batch_id, tables, _query_of(batch.sparkSession, checkpoint))

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def drain(query: StreamingQuery, timeout: float | None = None) -> None:
    """Wait until a draining query has applied everything that had arrived."""
    query.awaitTermination(timeout)
    if query.exception():
        raise query.exception()
