"""Queries that run the log as a stream and read the tables it leaves."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from changetables.operators import apply as batch
from changetables.session import scratch_root
from changetables.sources.changelog import read_changelog
from changetables.sources.versions import read_table, write_table
from changetables.streaming import apply
from workloads import logs
from workloads.registry import ORACLES, query
from workloads.replays import _FINAL

ACCOUNT = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def _folder(spark) -> str:
    return os.path.join(scratch_root(spark), f"stream-{uuid.uuid4().hex}")


def _stream(spark, sf):
    events = read_changelog(
        spark, sf, streaming=True, schema=logs.EVENTS_SCHEMA, glob="events.parquet", max_files=1
    )
    return logs.account_log(events)


def _applied(spark, sf, engine):
    folder = _folder(spark)
    target = apply.Target(f"{folder}/accounts", ("user_id",), ACCOUNT)
    apply.drain(
        apply.start_apply(_stream(spark, sf), target, f"{folder}/checkpoint", engine=engine)
    )
    return target


@query(ORACLES["latest_by_key_events"])
def stream_latest(spark, sf):
    return apply.read_current(spark, _applied(spark, sf, "deltas"))


@query(ORACLES["latest_by_key_events"])
def stream_latest_state(spark, sf):
    return apply.read_current(spark, _applied(spark, sf, "state"))


def _landed(spark, sf, folder, parts):
    """The events of some sixths of the log, landed as files that arrive out of order."""
    events = logs.events(spark, sf)
    for part in parts:
        events.filter(F.pmod("event_id", F.lit(6)) == part).write.mode("append").parquet(folder)


def _drained(spark, folder, target, checkpoint):
    stream = read_changelog(spark, folder, streaming=True, schema=logs.EVENTS_SCHEMA, max_files=1)
    apply.drain(apply.start_apply(logs.account_log(stream), target, checkpoint))


@query(ORACLES["latest_by_key_events"])
def stream_many_batches(spark, sf):
    """A log in several files, a micro-batch each, stopped and taken up again."""
    folder = _folder(spark)
    target = apply.Target(f"{folder}/accounts", ("user_id",), ACCOUNT)
    for parts in ((4, 0, 2), (5, 1, 3)):
        _landed(spark, sf, f"{folder}/log", parts)
        _drained(spark, f"{folder}/log", target, f"{folder}/checkpoint")
    return apply.read_current(spark, target)


@query(ORACLES["latest_by_key_events"])
def stream_restart(spark, sf):
    """New queries with new checkpoint folders go on, before and after a compaction."""
    folder = _folder(spark)
    target = apply.Target(f"{folder}/accounts", ("user_id",), ACCOUNT)
    for turn, parts in enumerate(((1, 5), (0, 4), (2, 3))):
        _landed(spark, sf, f"{folder}/log-{turn}", parts)
        _drained(spark, f"{folder}/log-{turn}", target, f"{folder}/checkpoint-{turn}")
        if turn == 1:
            apply.compact(spark, target)
    return apply.read_current(spark, target)


@query(
    f"""select schema_name, table_name, count(*) as rows, round(sum(value), 2) as total from (select *,
 {logs.SCHEMA} as schema_name, {logs.TABLE} as table_name from ({ORACLES["latest_by_key_events"]}) q) r
 group by 1, 2"""
)
def stream_tables(spark, sf):
    names = ["user_id", "event_type", "value"]
    text = lambda side: F.when(
        F.col(side).isNotNull(),
        F.map_from_arrays(
            F.array(*map(F.lit, names)), F.array(*[F.col(f"{side}.{n}").cast("string") for n in names])
        ),
    )
    log = _stream(spark, sf).withColumns({"before": text("before"), "after": text("after")})
    folder = _folder(spark)
    names = [(schema, f"acct_{i}") for schema in ("shop", "crm", "ops") for i in range(4)]
    tables = apply.TableSet(f"{folder}/tables", dict.fromkeys(names, ("user_id",)))
    apply.drain(apply.start_apply_tables(log, tables, f"{folder}/checkpoint"))
    rows = apply.read_state(spark, tables).filter("row is not null")
    return rows.groupBy("schema_name", "table_name").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum(F.col("row")["value"].cast("double")), 2).alias("total")
    )


@query(_FINAL)
def apply_to_table(spark, sf):
    """The batch sink: two versions of the table, each applying a part of the log."""
    orders = logs.table(spark, sf, "orders")
    changes, root = logs.order_log(orders), _folder(spark)
    write_table(logs.order_base(orders), root, "orders")
    for part, mode in ((changes.filter("file_seq <= 2"), "latest"), (changes.filter("file_seq > 2"), "one")):
        rows = batch.apply_to_table(part, read_table(spark, root, "orders"), ["o_orderkey"], mode)
        write_table(rows, root, "orders")
    return read_table(spark, root, "orders")


@query(_FINAL)
def apply_batches(spark, sf):
    """The streaming sink's table: filled, two batches out of order, then compacted."""
    orders = logs.table(spark, sf, "orders")
    changes, base = logs.order_log(orders), logs.order_base(orders)
    target = apply.Target(f"{_folder(spark)}/orders", ("o_orderkey",), base.schema)
    apply.create(target, base)
    keys = list(target.keys)
    for batch_id, files in enumerate(((3, 4), (1, 2))):
        part = changes.filter(F.col("file_seq").isin(*files))
        apply.apply_batch(apply.latest_actions(part, keys), batch_id, target)
    apply.compact(spark, target)
    return apply.read_current(spark, target)
