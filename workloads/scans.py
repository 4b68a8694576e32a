"""Queries on reading the log: positions, executed sets, catalogues."""

from __future__ import annotations

from pyspark.sql import functions as F

from changetables.functions.gtid import gtid_intervals as intervals_of
from changetables.sources import catalogue, changelog, gtid, versions
from workloads import logs
from workloads.registry import query

_POS = ", ".join(f"{sql} as {name}" for name, sql in logs.POSITION.items())

ACCOUNTS = f"""select {logs.SOURCE} as source_id, {logs.FILE} as file, {_POS},
 {logs.SOURCE} as gtid_source, event_id as gtid_seq, ts as event_ts, {logs.SCHEMA} as schema_name,
 {logs.TABLE} as table_name, {logs.OP} as op, {logs.HEADER} as header, event_type, event_id, user_id,
 value, props from events"""


def _accounts(spark, sf):
    return logs.account_log(logs.events(spark, sf))


@query(
    f"""select file, count(*) as events, min(pos) as first_pos, max(end_pos) as last_pos
 from ({ACCOUNTS}) group by file"""
)
def changelog_scan(spark, sf):
    return _accounts(spark, sf).groupBy("file").agg(
        F.count(F.lit(1)).alias("events"),
        F.min("pos").alias("first_pos"),
        F.max("end_pos").alias("last_pos"),
    )


@query(f"select {logs.FILE} as file, cast(event_id // 2500 + 1 as bigint) as file_seq from events")
def file_sequence(spark, sf):
    return _accounts(spark, sf).select(
        "file", changelog.file_sequence(F.col("file")).alias("file_seq")
    )


@query("select event_id from events where event_id >= 2500 + 1200")
def from_position(spark, sf):
    return changelog.from_position(_accounts(spark, sf), "log-bin.000002", 120004).select("event_id")


@query("select event_id from events where event_id > 2500 + 1199")
def resume_after(spark, sf):
    return changelog.resume_after(_accounts(spark, sf), "log-bin.000002", 120004).select("event_id")


EXECUTED = "src-0:1-500:700-800:750-900,src-1:3,src-1:100-4000"
_AFTER_SET = f"""select event_id from ({ACCOUNTS}) where not (
 (source_id = 'src-0' and (event_id between 1 and 500 or event_id between 700 and 900))
 or (source_id = 'src-1' and (event_id = 3 or event_id between 100 and 4000)))"""


@query(_AFTER_SET)
def after_gtid_set(spark, sf):
    return changelog.after_gtid_set(_accounts(spark, sf), EXECUTED).select("event_id")


@query(_AFTER_SET)
def after_gtid_set_merged(spark, sf):
    return changelog.after_gtid_set(_accounts(spark, sf), EXECUTED, small=0).select("event_id")


@query(
    f"""select event_id from ({ACCOUNTS})
 where event_id > case source_id when 'src-0' then 3000 else 4500 end or event_id = 0"""
)
def after_gtid_set_mariadb(spark, sf):
    return changelog.after_gtid_set(
        _accounts(spark, sf).withColumn("gtid_source", F.substring("source_id", 5, 1)),
        "0-1-3000,1-7-4500",
        "mariadb",
    ).select("event_id")


@query(
    """select event_id, 'a' || user_id as gtid_source, event_id as lo, event_id + 5 as hi from events
 union all select event_id, 'a' || user_id, event_id + 10, event_id + 10 from events
 union all select event_id, 'b', user_id, user_id from events"""
)
def gtid_intervals(spark, sf):
    sets = logs.events(spark, sf).select(
        "event_id",
        F.format_string(
            " A%d:%d-%d:%d , b:%d",
            "user_id", "event_id", F.col("event_id") + 5, F.col("event_id") + 10, "user_id",
        ).alias("gtid_set"),
    )
    return intervals_of(sets, "gtid_set", "mysql")


@query(
    """select event_id, cast(user_id as varchar) as gtid_source, cast(1 as bigint) as lo, event_id as hi
 from events"""
)
def gtid_intervals_mariadb(spark, sf):
    sets = logs.events(spark, sf).select(
        "event_id", F.concat_ws("-", "user_id", F.lit(1), "event_id").alias("gtid_set")
    )
    return intervals_of(sets, "gtid_set", "mariadb")


_RUNS = """with n as (select distinct gtid_source, gtid_seq from ({log})),
 r as (select *, gtid_seq - row_number() over (partition by gtid_source order by gtid_seq) as run from n)
 select gtid_source, min(gtid_seq) as lo, max(gtid_seq) as hi from r group by gtid_source, run"""


@query(_RUNS.format(log=ACCOUNTS))
def gtid_total(spark, sf):
    return gtid.gtid_set_total(_accounts(spark, sf), bucket=64)


@query(_RUNS.format(log=ACCOUNTS + " where event_id <= 2500 + 700"))
def gtid_asof(spark, sf):
    return gtid.gtid_set_asof(_accounts(spark, sf), 2, 4 + 700 * 100)


@query(f"select gtid_source, cast(1 as bigint) as lo, max(gtid_seq) as hi from ({ACCOUNTS}) group by 1")
def gtid_total_mariadb(spark, sf):
    return gtid.gtid_set_total(_accounts(spark, sf), "mariadb")


@query(
    f"""select gtid_source, gtid_source || ':' || string_agg(case when lo = hi then cast(lo as varchar)
 else lo || '-' || hi end, ':' order by lo) as gtid_set from ({_RUNS.format(log=ACCOUNTS)}) group by gtid_source"""
)
def gtid_text(spark, sf):
    return gtid.gtid_set_text(gtid.gtid_set_total(_accounts(spark, sf)))


@query(
    """select event_id, case when event_type in ('view', 'error') then cast(event_id as varchar) else '' end
 as carried from events"""
)
def carried_gtid_set(spark, sf):
    from changetables.functions.events import classify

    log = classify(logs.mixed_log(logs.events(spark, sf)))
    return log.select(
        "event_id", gtid.carried_gtid_set(F.col("kind"), F.col("gtid_set")).alias("carried")
    )


@query("select o_orderstatus, count(*) as orders from orders group by 1")
def base_table_scan(spark, sf):
    rows = versions.read_table(spark, sf, "orders.parquet")
    return rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))


@query(
    """select 'customer' as schema_name, cast(o_custkey as varchar) as table_name,
 string_agg('c' || o_orderkey, ',' order by o_orderkey) as columns from orders group by o_custkey"""
)
def table_columns(spark, sf):
    columns = logs.table(spark, sf, "orders").select(
        F.lit("customer").alias("schema_name"),
        F.col("o_custkey").cast("string").alias("table_name"),
        F.col("o_orderkey").alias("ordinal_position"),
        F.concat(F.lit("c"), F.col("o_orderkey")).alias("column_name"),
    )
    found = catalogue.table_columns(columns)
    return found.withColumn("columns", F.concat_ws(",", "columns"))


_SCHEMA_ASOF = f"""with a as ({ACCOUNTS}),
 h as (select schema_name, table_name, event_id as hid, 'id,c' || event_id as columns from a
   where op = 'delete' union all
   select distinct schema_name, table_name, cast(-1 as bigint), 'id,first' from a)
 select a.event_id, h.columns from a asof left join h
   on a.schema_name = h.schema_name and a.table_name = h.table_name and a.event_id >= h.hid"""


def _schema_asof(spark, sf, small):
    log = _accounts(spark, sf)
    tables = log.select("schema_name", "table_name").distinct()
    first = tables.withColumn("columns", F.array(F.lit("id"), F.lit("first")))
    altered = log.filter("op = 'delete'").withColumn(
        "columns", F.array(F.lit("id"), F.concat(F.lit("c"), F.col("event_id")))
    )
    known = catalogue.schema_history(first, altered)
    found = catalogue.schema_asof(log, known, small)
    return found.select("event_id", F.concat_ws(",", "catalogue_columns").alias("columns"))


@query(_SCHEMA_ASOF)
def schema_asof(spark, sf):
    return _schema_asof(spark, sf, 1_000)


@query(_SCHEMA_ASOF)
def schema_asof_merged(spark, sf):
    return _schema_asof(spark, sf, 0)
