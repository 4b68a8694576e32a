"""Queries for metrics and for comparing tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from changetables.operators import metrics, reconcile
from workloads import logs
from workloads.registry import query
from workloads.texts import _KIND, _LABEL, _T

_AUDIT = f"""with a as (select event_id, {logs.SOURCE} as source_id, {logs.K} as k, {_KIND} as kind, {_LABEL} as label,
  {logs.MIXED_TYPE} as header, {logs.SCHEMA} as s, case when ({logs.K}) = 7 then '' else {logs.TABLE} end as t, {_T} as form,
  value / 100 as seconds, ts as event_ts, ts + to_microseconds(cast(round((value - 50) * 1000000) as bigint)) as ts
  from events)"""


def _audit(spark, sf):
    return logs.audit_log(logs.events(spark, sf))


@query(f"{_AUDIT} select lower(header) as event_type, count(*) as events from a group by 1")
def metrics_events_read(spark, sf):
    return metrics.events_read(_audit(spark, sf))


_SHOP = "(case when kind = 'rows' then t <> '' and s <> 'shop' when kind = 'query' then form not in (12, 13, 14, 15) and s <> 'shop' else false end)"


@query(f"{_AUDIT} select kind, count(*) as events from a where {_SHOP} group by 1")
def metrics_events_filtered(spark, sf):
    return metrics.events_filtered(_audit(spark, sf), F.col("schema_name") == "shop")


@query(
    f"""{_AUDIT} select label as event_type, count(*) as applied, count(*) filter (not {_SHOP}
  and label <> 'rows_unknown' and not (kind = 'query' and form in (12, 13, 14, 15))) as effective
 from a where label is not null and k not in (1, 2) group by 1"""
)
def metrics_events_applied(spark, sf):
    return metrics.events_applied(_audit(spark, sf), F.col("schema_name") == "shop")


@query(
    f"""{_AUDIT} select stage, count(*) as errors from (select kind as stage from a where k in (1, 2) and kind <> 'xid'
  union all select 'exec' from a where k = 1 and kind <> 'xid' union all select 'state' from a where k = 3) q group by 1"""
)
def metrics_apply_errors(spark, sf):
    return metrics.apply_errors(_audit(spark, sf))


@query(f"{_AUDIT} select count(*) as errors from a where k = 4")
def metrics_read_errors(spark, sf):
    return metrics.read_errors(_audit(spark, sf))


@query(f"{_AUDIT} select source_id, cast(arg_max(k = 10, ts) as int) as up from a where k in (10, 11) group by 1")
def metrics_up(spark, sf):
    return metrics.pipeline_up(_audit(spark, sf))


@query(
    f"""{_AUDIT}, b as (select unnest([0.005,0.01,0.025,0.05,0.1,0.25,0.5,1.0,2.5,5.0,10.0]::double[]) as bound,
  unnest(['0.005','0.01','0.025','0.05','0.1','0.25','0.5','1','2.5','5','10']) as le
  union all select 'infinity'::double, '+Inf')
 select label as event_type, le, count(*) filter (seconds <= bound) as events, count(*) as total,
  round(sum(seconds), 4) as seconds from a, b where label is not null group by 1, 2"""
)
def lag_histogram(spark, sf):
    found = metrics.duration_histogram(_audit(spark, sf))
    return found.select("event_type", "le", "events", F.col("count").alias("total"), F.round("sum", 4).alias("seconds"))


_LAG = "greatest(0, (epoch_us(ts) - epoch_us(date_trunc('second', event_ts))) / 1000000.0)"


@query(f"{_AUDIT} select source_id, round(arg_max({_LAG}, event_id), 3) as lag from a group by 1")
def metrics_current_lag(spark, sf):
    found = metrics.current_lag(_audit(spark, sf), "ts")
    return found.select("source_id", F.round("lag_seconds", 3).alias("lag"))


@query(
    f"""{_AUDIT} select epoch_us(date_trunc('day', event_ts)) as day, round(max({_LAG}), 3) as lag_max from a group by 1"""
)
def metrics_lag_windows(spark, sf):
    found = metrics.lag_quantiles(_audit(spark, sf), "1 day", "ts")
    return found.select(F.unix_micros("start").alias("day"), F.round("lag_max", 3).alias("lag_max"))


@query(
    f"""{_AUDIT} select epoch_us(date_trunc('day', event_ts)) as day, round(max({_LAG}), 3) as lag_max,
  round(quantile_disc({_LAG}, 0.5), 3) as lag_p50, round(quantile_disc({_LAG}, 0.95), 3) as lag_p95 from a group by 1"""
)
def metrics_lag_windows_all(spark, sf):
    found = metrics.lag_quantiles(_audit(spark, sf), "1 day", "ts")
    lags = [F.round(c, 3).alias(c) for c in ("lag_max", "lag_p50", "lag_p95")]
    return found.select(F.unix_micros("start").alias("day"), *lags)


@query(
    f"""{_AUDIT} select case when k = 5 then 'fail' else 'success' end as result, count(*) as checkpoints
 from a where k between 5 and 9 group by 1"""
)
def metrics_checkpoints(spark, sf):
    return metrics.checkpoint_results(_audit(spark, sf))


@query(
    f"""{_AUDIT} select source_id, cast(floor(epoch_us(max(ts)) / 1000000) as bigint) as last_checkpoint
 from a where k between 6 and 9 group by 1"""
)
def metrics_last_checkpoint(spark, sf):
    return metrics.last_checkpoint(_audit(spark, sf))


@query(
    f"""{_AUDIT} select 'x_binlog_events_read_total' as metric, lower(header) as label, count(*)::double as value from a group by 2
 union all select 'x_binlog_read_errors_total', '', count(*) from a where k = 4
 union all select 'x_events_filtered_total', kind, count(*) from a where {_SHOP} group by 2
 union all select 'x_events_applied_total', label, count(*) from a where label is not null and k not between 1 and 4 group by 2
 union all select 'x_event_apply_errors_total', stage, count(*) from (select kind as stage from a where k in (1, 2) and kind <> 'xid'
   union all select 'exec' from a where k = 1 and kind <> 'xid' union all select 'state' from a where k = 3) q group by 2
 union all select 'x_state_checkpoint_total', case when k = 5 then 'fail' else 'success' end, count(*)
   from a where k between 5 and 9 group by 2
 union all select 'x_worker_up', source_id, arg_max(k = 10, ts)::int from a where k in (10, 11) group by 2
 union all select 'x_replication_lag_seconds', source_id, round(arg_max({_LAG}, event_id), 3) from a group by 2
 union all select 'x_state_last_checkpoint_timestamp_seconds', source_id, floor(epoch_us(max(ts)) / 1000000)
   from a where k between 6 and 9 group by 2
 union all select 'x_event_apply_duration_seconds_count', label, count(*) from a where label is not null group by 2
 union all select 'x_event_apply_duration_seconds_sum', label, round(sum(seconds), 3) from a where label is not null group by 2
 union all select 'x_event_apply_duration_seconds_bucket', label || '|' || le, count(*) filter (seconds <= bound)
   from a, (select unnest(['0.005','0.01','0.025','0.05','0.1','0.25','0.5','1.0','2.5','5.0','10.0','infinity']::double[]) as bound,
    unnest(['0.005','0.01','0.025','0.05','0.1','0.25','0.5','1','2.5','5','10','+Inf']) as le) b
   where label is not null group by 2"""
)
def metrics_snapshot(spark, sf):
    table = metrics.metrics_snapshot(_audit(spark, sf), F.col("schema_name") == "shop", prefix="x_")
    return table.withColumn("value", F.round("value", 3))


@query(
    f"""{_AUDIT}, w as (select source_id, date_trunc('day', ts) as day, arg_max(k = 10, case when k in (10, 11) then ts end) as up,
   count(*) filter (k = 4) as r, count(*) filter (k = 3 or (k in (1, 2) and kind <> 'xid')) as e, min({_LAG}) as lag,
   count(*) filter (k between 6 and 9) as c from a group by 1, 2)
 select source_id, epoch_us(day) as window_start,
  cast(coalesce(not last_value(up ignore nulls) over v, false) as int) as down,
  cast(r > coalesce(lag(r) over v, 0) as int) as read_errors_rise,
  cast(e > coalesce(lag(e) over v, 0) as int) as apply_errors_rise,
  cast(lag > 0.5 as int) as lag_over_slo, cast(c = 0 as int) as no_checkpoint
 from w window v as (partition by source_id order by day)"""
)
def alerts(spark, sf):
    found = metrics.alerts(_audit(spark, sf), "1 day", 0.5)
    flags = [c for c in found.columns if c not in ("source_id", "window_start")]
    return found.select(
        "source_id",
        F.unix_micros("window_start").alias("window_start"),
        *[F.col(c).cast("int").alias(c) for c in flags],
    )


# -- reconciliation ------------------------------------------------------------------

_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice"


def _pair(spark, sf):
    """Orders, and a copy with changed, lost, added and duplicated rows."""
    orders = logs.table(spark, sf, "orders")
    source = orders.selectExpr(
        "o_orderkey", "nullif(o_custkey, 7) as o_custkey", "o_orderstatus", "o_totalprice"
    )
    copied = orders.filter("not (o_orderstatus = 'P' and o_orderpriority = '5-LOW')").selectExpr(
        "o_orderkey",
        "nullif(o_custkey, 7) as o_custkey",
        "case when o_orderpriority = '1-URGENT' then 'X' else o_orderstatus end as o_orderstatus",
        "case when o_orderpriority = '1-URGENT' and o_orderstatus = 'O' then o_totalprice + 1 else o_totalprice end as o_totalprice",
    )
    added = orders.filter("o_orderstatus = 'O' and o_orderpriority = '2-HIGH'").selectExpr(
        "-1 - o_orderkey as o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )
    twice = orders.filter("o_orderstatus = 'F' and o_orderpriority = '3-MEDIUM'").selectExpr(
        "o_orderkey", "nullif(o_custkey, 7) as o_custkey", "o_orderstatus", "o_totalprice"
    )
    moved = orders.filter("o_orderstatus = 'F' and o_orderpriority = '4-NOT SPECIFIED'").selectExpr(
        "o_orderkey", "o_custkey", "'Y' as o_orderstatus", "o_totalprice + 2 as o_totalprice"
    )
    return source, copied.unionByName(added).unionByName(twice).unionByName(moved)


@query(
    """select 'customer' as table_name, count(*) as source_rows, count(*) as target_rows, 'OK' as verdict from customer
 union all select 'orders', count(*), count(*) - count(*) filter (o_orderstatus = 'P' and o_orderpriority = '5-LOW')
  + count(*) filter (o_orderstatus = 'O' and o_orderpriority = '2-HIGH') + count(*) filter (o_orderstatus = 'F' and
  o_orderpriority in ('3-MEDIUM', '4-NOT SPECIFIED')), 'MISMATCH' from orders
 union all select 'part', count(*), null, 'MISMATCH' from part"""
)
def recon_counts(spark, sf):
    source, target = _pair(spark, sf)
    customers = logs.table(spark, sf, "customer")
    return reconcile.compare_counts(
        {"orders": source, "customer": customers, "part": logs.table(spark, sf, "part")},
        {"orders": target, "customer": customers},
    )


@query("select 'events' as table_name, count(*) as source_rows, count(*) filter (event_type <> 'click') as target_rows from events")
def side_by_side_counts(spark, sf):
    events = logs.events(spark, sf)
    return reconcile.side_by_side_counts({"events": events}, {"events": events.filter("event_type <> 'click'")})


@query(
    """select o_orderkey, 'changed' as kind, cast(1 as bigint) as copies, case when o_orderstatus = 'O'
   then 'o_orderstatus,o_totalprice' else 'o_orderstatus' end as changed_columns, o_orderstatus as source_status,
   'X' as target_status from orders where o_orderpriority = '1-URGENT'
 union all select o_orderkey, 'missing', 1, '', o_orderstatus, null from orders
   where o_orderstatus = 'P' and o_orderpriority = '5-LOW'
 union all select -1 - o_orderkey, 'extra', 1, '', null, o_orderstatus from orders
   where o_orderstatus = 'O' and o_orderpriority = '2-HIGH'
 union all select o_orderkey, 'extra', 1, '', null, 'F' from orders
   where o_orderstatus = 'F' and o_orderpriority = '3-MEDIUM'
 union all select o_orderkey, 'extra', 1, '', null, 'Y' from orders
   where o_orderstatus = 'F' and o_orderpriority = '4-NOT SPECIFIED'"""
)
def recon_diff(spark, sf):
    source, target = _pair(spark, sf)
    return reconcile.diff_tables(source, target, ["o_orderkey"]).select(
        "o_orderkey", "kind", "copies", "changed_columns",
        F.col("source_row.o_orderstatus").alias("source_status"),
        F.col("target_row.o_orderstatus").alias("target_status"),
    )


@query(
    """with s as (select l_returnflag, l_linestatus, l_quantity, count(*) as n from lineitem group by all),
 t as (select case when l_tax = 0 then null else l_returnflag end as l_returnflag, l_linestatus, l_quantity,
   count(*) as n from lineitem where l_discount < 0.08 group by all)
 select coalesce(s.l_returnflag, t.l_returnflag) as l_returnflag, coalesce(s.l_linestatus, t.l_linestatus) as l_linestatus,
  coalesce(s.l_quantity, t.l_quantity) as l_quantity,
  case when coalesce(s.n, 0) > coalesce(t.n, 0) then 'missing' else 'extra' end as kind,
  abs(coalesce(s.n, 0) - coalesce(t.n, 0)) as copies
 from s full join t on s.l_returnflag is not distinct from t.l_returnflag and s.l_linestatus = t.l_linestatus
  and s.l_quantity = t.l_quantity where coalesce(s.n, 0) <> coalesce(t.n, 0)"""
)
def recon_diff_keyless(spark, sf):
    items = logs.table(spark, sf, "lineitem")
    columns = ["l_returnflag", "l_linestatus", "l_quantity"]
    other = items.filter("l_discount < 0.08").withColumn(
        "l_returnflag", F.expr("case when l_tax = 0 then null else l_returnflag end")
    )
    found = reconcile.diff_tables(items.select(*columns), other.select(*columns))
    row = F.coalesce("source_row", "target_row")
    return found.select(*[row[c].alias(c) for c in columns], "kind", "copies")


@query(
    """select l_orderkey, l_linenumber, count(*) as copies from lineitem group by 1, 2 having count(*) > 1"""
)
def dup_check(spark, sf):
    return reconcile.duplicates(logs.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """select distinct c_custkey from customer where c_custkey not in
 (select o_custkey from orders where o_orderstatus = 'F' and o_orderpriority = '5-LOW')"""
)
def missing_tables(spark, sf):
    customers = logs.table(spark, sf, "customer")
    orders = logs.table(spark, sf, "orders").filter("o_orderstatus = 'F' and o_orderpriority = '5-LOW'")
    ordered = orders.select(F.col("o_custkey").alias("c_custkey"))
    return reconcile.missing_tables(customers, ordered, ["c_custkey"])


@query(
    """select c.c_custkey as table_name, n.n_name as column_name from customer c, nation n where c.c_nationkey = n.n_nationkey
 and c.c_mktsegment <> 'BUILDING' and n.n_name not in (select n_name from nation where n_regionkey = 1)"""
)
def missing_columns(spark, sf):
    nations = logs.table(spark, sf, "nation")
    customers = logs.table(spark, sf, "customer")
    named = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("table_name"), F.col("n_name").alias("column_name"), "n_regionkey", "c_mktsegment"
    )
    return reconcile.missing_columns(named, named.filter("n_regionkey = 1 or c_mktsegment = 'BUILDING'"))
