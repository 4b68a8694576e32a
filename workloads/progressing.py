"""Queries on saved progress and on resuming from it."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from changetables.functions import times
from changetables.operators import progress
from changetables.schema import LEDGER_SCHEMA
from changetables.session import scratch_root
from changetables.sources import ledger as ledgers
from workloads import logs
from workloads.registry import query


def _log(spark, sf):
    """The mixed log with empty sets, files and positions in places."""
    log = logs.mixed_log(logs.events(spark, sf))
    return log.withColumns(
        {
            "gtid_set": F.expr("case when event_type = 'XIDEvent' then gtid_set when event_type = 'QueryEvent' then '' end"),
            "file": F.expr("case when k = 3 then '' else file end"),
            "end_pos": F.expr("case when k = 4 then 0 else end_pos end"),
        }
    )


_START = [("src-0", "mysql", "gtid", "base-set", "log-bin.000000", 77, 5, None, 40)]


def _start(spark):
    return spark.createDataFrame(_START, LEDGER_SCHEMA)


_MARKED = f"""with e as (select event_id, ts, {logs.SOURCE} as source_id,
  case when event_type = 'view' then cast(event_id as varchar) end as gs,
  case when ({logs.K}) = 3 then null else {logs.FILE} end as f,
  case when ({logs.K}) = 4 then null else 104 + event_id % 2500 * 100 end as p from events),
 m as (select *, row_number() over w as n, last_value(gs ignore nulls) over w as gl,
  last_value(f ignore nulls) over w as fl, last_value(p ignore nulls) over w as pl
  from e window w as (partition by source_id order by event_id)),
 b as (select *, {{b}} from m)"""
_WITH_BASE = _MARKED.format(
    b="""coalesce(gl, case source_id when 'src-0' then 'base-set' else '' end) as gtid_set, coalesce(fl,
  case source_id when 'src-0' then 'log-bin.000000' else '' end) as binlog_file,
  coalesce(pl, case source_id when 'src-0' then 77 else 0 end) as binlog_pos"""
)


@query(
    f"""{_WITH_BASE} select event_id, n, binlog_file, binlog_pos, gtid_set from b"""
)
def running_position(spark, sf):
    marked = progress.running_position(_log(spark, sf), _start(spark), logs.SEGMENT)
    return marked.select(
        "event_id",
        "n",
        F.coalesce("binlog_file", F.lit("")).alias("binlog_file"),
        F.coalesce("binlog_pos", F.lit(0)).alias("binlog_pos"),
        F.coalesce("gtid_set_saved", F.lit("")).alias("gtid_set"),
    )


@query(
    f"""{_WITH_BASE}, l as (select source_id, max(n) as last from b group by 1)
 select source_id, n, gtid_set, binlog_file, binlog_pos, case source_id when 'src-0' then 'gtid' end as mode,
  (n + 99) // 100 + case source_id when 'src-0' then 40 else 0 end as version,
  case when n % 100 = 0 then 'interval' else 'final' end as reason, epoch_us(ts) as saved_us
 from b join l using (source_id) where n % 100 = 0 or n = last"""
)
def checkpoint_log(spark, sf):
    saved = progress.checkpoints(
        _log(spark, sf), 100, _start(spark), segment_bytes=logs.SEGMENT
    )
    return saved.select(
        "source_id", "n", "gtid_set", "binlog_file", "binlog_pos", "mode", "version", "reason",
        F.unix_micros("updated_at").alias("saved_us"),
    )


@query(
    f"""{_WITH_BASE} select source_id, max(n) as version, count(*) as checkpoints from b group by 1"""
)
def checkpoint_every_event(spark, sf):
    saved = progress.checkpoints(_log(spark, sf), 0, segment_bytes=logs.SEGMENT)
    return saved.groupBy("source_id").agg(
        F.max("version").alias("version"), F.count(F.lit(1)).alias("checkpoints")
    )


# -- ledger and resume: every customer is a source ------------------------------------

_HOST = "case when c_nationkey = 3 then ' ' else 'host-' || cast(c_nationkey as string) end"
_KEY = """case when c_nationkey = 5 then 'named-' || cast(c_custkey as string) else
 (case when c_nationkey = 3 then 'unknown' else 'host-' || cast(c_nationkey as string) end) || ':3306#'
 || cast(c_custkey as string) end"""


def _configs(spark, sf):
    return logs.table(spark, sf, "customer").selectExpr(
        "case when c_nationkey = 5 then ' named-' || cast(c_custkey as string) else '  ' end as source_id",
        f"{_HOST} as host",
        "3306 as port",
        "c_custkey as server_id",
        "case when c_nationkey = 7 then ' MariaDB ' when c_nationkey = 8 then '' else 'mysql' end as flavor",
        "c_nationkey >= 10 as gtid_enabled",
        "'cfg:1-' || cast(c_custkey as string) as gtid_set",
        "'log-bin.000009' as binlog_file",
        "cast(4 as bigint) as binlog_pos",
    )


_SAVED_MODE = "case c_mktsegment when 'BUILDING' then 'pos' when 'MACHINERY' then 'GTID' when 'AUTOMOBILE' then 'gtid' when 'HOUSEHOLD' then 'pos' else 'file' end"
_SAVED = {
    "source_id": _KEY,
    "flavor": "case when c_nationkey = 9 then ' ' else 'mysql' end",
    "mode": _SAVED_MODE,
    "gtid_set": "case when c_acctbal < 1000 then ' ' else 'saved:' || cast(c_custkey as string) end",
    "binlog_file": "case when c_acctbal between 1000 and 2000 then '' else 'log-bin.000012' end",
    "binlog_pos": "case when c_acctbal between 2000 and 3000 then 0 when c_acctbal between 3000 and 4000 "
    "then 4294967296 else 1000 + c_custkey end",
    "server_id": "case when c_nationkey = 4 then 0 else c_custkey + 1 end",
    "updated_at": "cast('2024-01-01' as timestamp)",
    "version": "c_custkey + 1",
}
_WHERE = "c_nationkey <> 6"


def _ledger(spark, sf):
    saved = logs.table(spark, sf, "customer").filter(_WHERE)
    return saved.selectExpr(*[f"{sql} as {name}" for name, sql in _SAVED.items()])


_PLAN = f"""with s as (select *, {", ".join(f"{sql} as s_{name}" for name, sql in _SAVED.items() if name != 'updated_at')},
   {_WHERE} as has from customer),
 w as (select *, case when not has then null
   when lower(s_mode) = 'gtid' and trim(s_gtid_set) = '' then 'gtid_set_empty'
   when lower(s_mode) = 'pos' and (s_binlog_file = '' or s_binlog_pos = 0) then 'position_empty'
   when lower(s_mode) = 'pos' and s_binlog_pos > 4294967295 then 'position_overflow'
   when lower(s_mode) not in ('gtid', 'pos') then 'mode_invalid' end as warning from s),
 r as (select *, has and warning is null as ok from w)
 select s_source_id as source_id, warning, cast(ok as int) as resumed,
  case when ok and trim(s_flavor) <> '' then s_flavor when c_nationkey = 7 then 'mariadb' else 'mysql' end as flavor,
  case when ok then s_mode when c_nationkey >= 10 then 'gtid' else 'pos' end as mode,
  case when ok then s_gtid_set else 'cfg:1-' || c_custkey end as gtid_set,
  case when ok then s_binlog_file else 'log-bin.000009' end as binlog_file,
  case when ok then s_binlog_pos else 4 end as binlog_pos,
  case when ok and s_server_id <> 0 then s_server_id else c_custkey end as server_id,
  case when ok then s_version else 0 end as version from r"""


@query(_PLAN)
def resume_plan(spark, sf):
    plan = progress.resume_plan(_ledger(spark, sf), _configs(spark, sf))
    return plan.drop("updated_at").withColumn("resumed", F.col("resumed").cast("int"))


@query(
    f"""select event_id from (select event_id, {logs.SOURCE} as source_id from events) q
 where (source_id = 'src-0' and event_id >= 2500 + 1200) or (source_id = 'src-1' and event_id >= 5000)"""
)
def resume_log(spark, sf):
    plan = spark.createDataFrame(
        [("src-0", "pos", "log-bin.000002", 120004), ("src-1", "POS", "log-bin.000002", 250004)],
        "source_id string, mode string, binlog_file string, binlog_pos long",
    )
    return progress.resume_log(logs.account_log(logs.events(spark, sf)), plan).select("event_id")


@query(
    f"""select event_id from (select event_id, {logs.SOURCE} as source_id from events) q
 where (source_id = 'src-0' and event_id >= 2500 + 1200)
 or (source_id = 'src-1' and event_id not between 1 and 3000 and event_id not between 4000 and 4500)
 or (source_id = 'src-2' and event_id > 6000)"""
)
def resume_log_gtid(spark, sf):
    """Positions and transaction sets of both flavors, a set for each source.

    The derived log numbers its transactions from 0, which no set holds.
    """
    plan = spark.createDataFrame(
        [
            ("src-0", "pos", "mysql", "", "log-bin.000002", 120004),
            ("src-1", "GTID", "mysql", "src-1:1-3000:4000-4500,src-2:1-9999999", "", 0),
            ("src-2", "gtid", "MariaDB", "src-1-6000", "", 0),
        ],
        "source_id string, mode string, flavor string, gtid_set string, binlog_file string, binlog_pos long",
    )
    log = logs.account_log(logs.events(spark, sf))
    domain = F.when(F.col("source_id") == "src-2", "src").otherwise(F.col("gtid_source"))
    return progress.resume_log(log.withColumn("gtid_source", domain), plan).select("event_id")


@query(
    """select c_custkey, (case when c_nationkey = 3 then 'unknown' else 'host-' || cast(c_nationkey as string) end)
 || ':3306#' || cast(c_custkey as string) as source_key from customer"""
)
def source_keys(spark, sf):
    return logs.table(spark, sf, "customer").select(
        "c_custkey",
        progress.source_key(F.expr(_HOST), F.lit(3306), F.col("c_custkey")).alias("source_key"),
    )


@query(
    f"""select {_KEY} as source_id, case when c_nationkey > 12 then 'new' else {_SAVED['flavor']} end as flavor,
 case when c_nationkey > 12 then 1 else c_custkey + 1 end as version from customer where {_WHERE}"""
)
def ledger_upsert(spark, sf):
    updates = (
        logs.table(spark, sf, "customer")
        .filter("c_nationkey > 12")
        .selectExpr(*[f"{sql} as {name}" for name, sql in _SAVED.items()])
        .withColumns({"flavor": F.lit("new"), "version": F.lit(1).cast("long")})
    )
    merged = ledgers.save_checkpoint(_ledger(spark, sf), updates)
    return merged.select("source_id", "flavor", "version")


_JSON = f"""'{{"source_id":"' || {_KEY} || '","flavor":"' || {_SAVED['flavor']} || '","mode":"' || {_SAVED_MODE} || '"'
 || case when c_acctbal < 1000 then ',"gtid_set":" "' else ',"gtid_set":"saved:' || c_custkey || '"' end
 || case when c_acctbal between 1000 and 2000 then '' else ',"binlog_file":"log-bin.000012"' end
 || case when c_acctbal between 2000 and 3000 then '' when c_acctbal between 3000 and 4000
      then ',"binlog_pos":4294967296' else ',"binlog_pos":' || (1000 + c_custkey) end
 || case when c_nationkey = 4 then '' else ',"server_id":' || (c_custkey + 1) end
 || ',"updated_at":"2024-01-01T00:00:00Z","version":' || (c_custkey + 1) || '}}'"""


@query(f"select {_KEY} as source_id, {_JSON} as json from customer where {_WHERE}")
def checkpoint_json(spark, sf):
    return ledgers.checkpoints_to_json(_ledger(spark, sf))


@query(
    f"""select {_KEY} as source_id, {_SAVED_MODE} as mode, {_SAVED['binlog_pos']} as binlog_pos,
 c_custkey + 11 as version from customer where {_WHERE}"""
)
def ledger_round_trip(spark, sf):
    path = os.path.join(scratch_root(spark), f"ledger-{uuid.uuid4().hex}")
    assert ledgers.load_ledger(spark, path).isEmpty()
    older = _ledger(spark, sf).withColumn("binlog_pos", F.lit(1).cast("long"))
    ledgers.write_checkpoints(older, path)
    ledgers.write_checkpoints(_ledger(spark, sf).withColumn("version", F.col("version") + 10), path)
    return ledgers.load_ledger(spark, path).select("source_id", "mode", "binlog_pos", "version")


@query(
    """select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as text, epoch_us(ts) as from_rfc3339,
 epoch_us(date_trunc('second', ts)) as from_text from events"""
)
def checkpoint_times(spark, sf):
    log = logs.events(spark, sf).withColumn("at", F.col("ts").cast("timestamp"))
    text = times.format_time(F.col("at"))
    rfc = F.date_format(F.col("at") + F.expr("interval 8 hours"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+08:00'")
    return log.select(
        "event_id",
        text.alias("text"),
        F.unix_micros(times.parse_time(rfc)).alias("from_rfc3339"),
        F.unix_micros(times.parse_time(text)).alias("from_text"),
    )
