"""Queries that replay a log: keyed, exact, partial, with DDL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from changetables.functions.ddl import with_ddl
from changetables.functions.rows import explode_present
from changetables.operators import ddl_effects as effects
from changetables.operators import exact, keyed
from changetables.operators.transactions import with_txn_id
from workloads import logs
from workloads.registry import ORACLES, query

_POS = ", ".join(f"{sql} as {name}" for name, sql in logs.POSITION.items())


def _accounts(spark, sf):
    return logs.account_log(logs.events(spark, sf))


def _slots(spark, sf):
    return logs.slot_log(logs.events(spark, sf))


def _orders(spark, sf):
    orders = logs.table(spark, sf, "orders")
    return logs.order_log(orders), logs.order_base(orders)


@query(
    """select user_id, event_type, value from (select *, row_number() over (partition by user_id
 order by event_id desc) as r from events) q where r = 1 and event_type <> 'error'"""
)
def latest_by_key_events(spark, sf):
    return keyed.latest_by_key(_accounts(spark, sf), ["user_id"])


_FINAL_ORDERS = """select case when o_orderpriority = '5-LOW' then -1 - o_orderkey else o_orderkey end as o_orderkey,
 o_custkey, {status} as o_orderstatus, {price} as o_totalprice from orders
 where o_orderstatus <> 'P' or o_orderpriority = '4-NOT SPECIFIED'"""
_BUMP = "o_orderpriority in ('1-URGENT', '2-HIGH')"
_FINAL = _FINAL_ORDERS.format(
    status=f"case when {_BUMP} then 'U' else o_orderstatus end",
    price=f"case when {_BUMP} then o_totalprice + 1 else o_totalprice end",
)


@query(_FINAL)
def latest_by_key_orders(spark, sf):
    changes, base = _orders(spark, sf)
    return keyed.latest_by_key(changes, ["o_orderkey"], base)


@query(
    """select o_orderkey, 0 as sub, 'update' as op, 1 as removes, 3 as file_seq from orders
   where o_orderpriority = '5-LOW'
 union all select -1 - o_orderkey, 1, 'update', 0, 3 from orders where o_orderpriority = '5-LOW'
 union all select o_orderkey, 1, 'insert', 0, 1 from orders where o_orderstatus = 'O'
 union all select o_orderkey, 1, 'update', 0, 2 from orders where o_orderpriority in ('1-URGENT', '2-HIGH')
 union all select case when o_orderpriority = '5-LOW' then -1 - o_orderkey else o_orderkey end, 0, 'delete', 1, 4
   from orders where o_orderstatus = 'P' and o_orderpriority <> '4-NOT SPECIFIED'"""
)
def key_change_orders(spark, sf):
    changes, _ = _orders(spark, sf)
    return keyed.split_key_updates(changes, ["o_orderkey"]).select(
        "o_orderkey",
        "sub",
        "op",
        F.col("removes").cast("int").alias("removes"),
        F.col("at.file_seq").cast("int").alias("file_seq"),
    )


@query(_FINAL)
def exact_replay_orders(spark, sf):
    changes, base = _orders(spark, sf)
    return exact.expand_copies(exact.replay(changes, base), chunk=2)


# tokens follow the next update or delete of their value, found with one window
_CHASE = f"""with recursive e as (select event_id as id, {logs.OP} as op, {logs.SLOT_BEFORE} as b,
   {logs.SLOT_AFTER} as a from events),
 s as (select id, 0 as role, b as slot, op, id as hit from e where op <> 'insert'
   union all select id, 1, a, op, null from e where op <> 'delete'),
 n as (select id, role, slot, op, min(hit) over (partition by slot order by id, role
   rows between 1 following and unbounded following) as next from s),
 p as (select id, slot, op, next from n where role = 1),
 walk as (select id as token, id, slot, next from p where op = 'insert'
   union all select w.token, p.id, p.slot, p.next from walk w join p on p.id = w.next)"""


@query(
    f"""{_CHASE} select slot, count(*) as copies from walk where next is null group by slot"""
)
def exact_replay_events(spark, sf):
    return exact.replay(_slots(spark, sf))


@query(
    f"""{_CHASE} select id as event_id from e where op <> 'insert' and id not in
 (select next from walk where next is not null)"""
)
def unmatched_changes(spark, sf):
    return exact.unmatched_changes(_slots(spark, sf)).select("event_id")


# the same with values and keys cut into log segments, as hot ones are
CUT = dict(segment_bytes=logs.SEGMENT, hot_rows=50)


@query(ORACLES["exact_replay_events"])
def exact_replay_cut(spark, sf):
    return exact.replay(_slots(spark, sf), **CUT)


@query(ORACLES["unmatched_changes"])
def unmatched_changes_cut(spark, sf):
    return exact.unmatched_changes(_slots(spark, sf), **CUT).select("event_id")


@query(
    """with d as (select l_returnflag, l_linestatus, l_quantity, max((date_trunc('month', l_shipdate), l_orderkey)) as last
   from lineitem where l_tax = 0 group by all)
 select i.l_returnflag, i.l_linestatus, i.l_quantity, count(*) as copies from lineitem i left join d
   using (l_returnflag, l_linestatus, l_quantity)
 where d.last is null or (date_trunc('month', i.l_shipdate), i.l_orderkey) > d.last group by all"""
)
def bag_replay_lineitem(spark, sf):
    log = logs.bag_log(logs.table(spark, sf, "lineitem"))
    return exact.replay_append_delete(log)


@query(
    """select l_returnflag, l_linestatus, l_quantity, count(*) - count(*) filter (l_tax = 0) as copies
 from lineitem group by all having copies > 0"""
)
def multiset_lineitem(spark, sf):
    return exact.replay(logs.bag_log(logs.table(spark, sf, "lineitem")), match="one")


@query(
    f"""with s as (select {logs.SLOT_BEFORE} as slot, -1 as n from events where event_type <> 'signup'
 union all select {logs.SLOT_AFTER}, 1 from events where event_type <> 'error')
 select slot, cast(sum(n) as bigint) as copies from s group by slot having sum(n) <> 0"""
)
def net_copies_events(spark, sf):
    return exact.net_copies(_slots(spark, sf))


_LIVE = """with e as (select *, last_value(case event_type when 'signup' then 1 when 'error' then 0 end ignore nulls)
   over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding) as live
   from events), c as (select event_id, user_id from e where event_type = 'signup' and live = 1)"""


@query(f"{_LIVE} select user_id, event_id // 2500 + 1 as file_seq, 4 + event_id % 2500 * 100 as pos from c")
def conflicts_events(spark, sf):
    found = keyed.conflicts(_accounts(spark, sf), ["user_id"])
    return found.select("user_id", "file_seq", "pos")


@query(f"{_LIVE} select event_id from events where event_id < (select min(event_id) from c)")
def halt_at_conflict(spark, sf):
    log = _accounts(spark, sf)
    return keyed.halt_at_first_conflict(log, ["user_id"]).select("event_id")


@query(ORACLES["conflicts_events"])
def conflicts_cut(spark, sf):
    found = keyed.conflicts(_accounts(spark, sf), ["user_id"], **CUT)
    return found.select("user_id", "file_seq", "pos")


@query(
    """with c as (select *, max(case when o_orderstatus = 'O' then 1 else 0 end) over (partition by o_custkey
   order by o_orderkey) as moved, lead(o_orderkey) over w as next, lead(o_orderstatus) over w as next_status
   from orders window w as (partition by o_custkey order by o_orderkey))
 select next as o_orderkey, o_orderkey as pos from c where moved = 1 and next_status = 'O'"""
)
def conflict_chains(spark, sf):
    """Each order's row moves to the customer's next order, in turn; open ones exist before."""
    orders = logs.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    ahead = F.lead("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    image = lambda key: F.struct(key.alias("o_orderkey"), "o_custkey")
    moves = orders.withColumn("next", ahead).filter("next is not null").select(
        F.lit(2).cast("long").alias("file_seq"), F.col("o_orderkey").alias("pos"), F.lit(0).alias("ordinal"),
        F.lit("update").alias("op"), image(F.col("o_orderkey")).alias("before"), image(F.col("next")).alias("after"),
    )
    base = orders.filter("o_orderstatus = 'O'").select("o_orderkey", "o_custkey")
    return keyed.conflicts(moves, ["o_orderkey"], base).select("o_orderkey", "pos")


@query(
    """select o_orderkey, case when o_orderstatus = 'O' then -1 else o_custkey end as o_custkey,
 case o_orderpriority when '1-URGENT' then 'U' when '2-HIGH' then null else o_orderstatus end as o_orderstatus,
 case when o_orderpriority = '3-MEDIUM' then o_totalprice + 5 else o_totalprice end as o_totalprice
 from orders where o_orderstatus <> 'P' or o_orderpriority = '4-NOT SPECIFIED'"""
)
def partial_update_orders(spark, sf):
    orders = logs.table(spark, sf, "orders")
    row = F.struct(*logs.ORDER_COLUMNS)
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")

    def image(key, status=None, price=None):
        none = lambda kind: F.lit(None).cast(kind)
        return F.struct(
            key.alias("o_orderkey"),
            none("long").alias("o_custkey"),
            (none("string") if status is None else status).alias("o_orderstatus"),
            (none("double") if price is None else price).alias("o_totalprice"),
        )

    def step(number, op, before, after, *present):
        return F.struct(
            F.lit(number).cast("long").alias("file_seq"),
            F.lit(op).alias("op"),
            before.alias("before"),
            after.alias("after"),
            F.array(*map(F.lit, present)).cast("array<string>").alias("after_present"),
        )

    key, nothing = F.col("o_orderkey"), F.when(F.lit(False), row)
    steps = [
        F.when(status == "O", step(1, "insert", nothing, row, "o_orderkey", "o_orderstatus", "o_totalprice")),
        F.when(
            priority == "1-URGENT",
            step(2, "update", image(key), image(key, F.lit("U")), "o_orderstatus"),
        ),
        F.when(priority == "2-HIGH", step(2, "update", image(key), image(key), "o_orderstatus")),
        F.when(
            priority == "3-MEDIUM",
            step(3, "update", image(key), image(key, price=F.col("o_totalprice") + 5), "o_totalprice"),
        ),
        F.when(
            priority == "5-LOW",
            step(3, "update", image(-1 - key), image(-1 - key, F.lit("X")), "o_orderstatus"),
        ),
        F.when(
            (status == "P") & (priority != "4-NOT SPECIFIED"), step(4, "delete", image(key), nothing)
        ),
    ]
    header = [(F.lit(4) + key * 100).alias("pos"), F.lit(0).alias("ordinal")]
    changes = explode_present(orders, header, steps, "s").select("pos", "ordinal", "s.*")
    base = orders.filter("o_orderstatus <> 'O'").select(*logs.ORDER_COLUMNS)
    defaults = {"o_custkey": F.lit(-1).cast("long")}
    return keyed.fold_partial(changes, base, ["o_orderkey"], defaults)


@query(
    """with n as (select *, lead(event_id) over (partition by user_id order by event_id) as next,
   lead(ts) over (partition by user_id order by event_id) as ts_to from events)
 select user_id, event_type, value, event_id // 2500 + 1 as from_file, 4 + event_id % 2500 * 100 as from_pos,
  next // 2500 + 1 as to_file, 4 + next % 2500 * 100 as to_pos, epoch_us(ts) as ts_from, epoch_us(ts_to) as ts_to
 from n where event_type <> 'error'"""
)
def row_history(spark, sf):
    return _history(keyed.history(_accounts(spark, sf), ["user_id"], ["event_ts"]))


@query(ORACLES["row_history"])
def row_history_cut(spark, sf):
    return _history(keyed.history(_accounts(spark, sf), ["user_id"], ["event_ts"], **CUT))


def _history(versions):
    return versions.select(
        "user_id",
        "event_type",
        "value",
        F.col("valid_from.file_seq").alias("from_file"),
        F.col("valid_from.pos").alias("from_pos"),
        F.col("valid_to.file_seq").alias("to_file"),
        F.col("valid_to.pos").alias("to_pos"),
        F.unix_micros("event_ts").alias("ts_from"),
        F.unix_micros("event_ts_to").alias("ts_to"),
    )


@query(
    f"""select event_id, cast(sum(case when ({logs.K}) % 20 = 12 then 1 else 0 end) over
 (partition by user_id % 2 order by event_id) as bigint) as txn_id from events"""
)
def txn_rollup(spark, sf):
    log = logs.query_log(logs.events(spark, sf))
    return with_txn_id(log, logs.SEGMENT).select("event_id", "txn_id")


# -- DDL -----------------------------------------------------------------------------

_K10 = f"({logs.K}) % 10"
_EPOCH_TEXT = f"""case {_K10} when 0 then 'TRUNCATE TABLE ' || s || '.' || t
 when 1 then 'RENAME TABLE ' || t || ' TO arch_' || t
 when 2 then 'DROP TABLE IF EXISTS arch_' || t || ', ' || s || '.gone'
 when 3 then 'RENAME TABLE arch_' || t || ' TO ' || s || '.' || t
 when 4 then 'ALTER TABLE ' || t || ' RENAME TO arch_' || t
 else 'ALTER TABLE ' || t || ' ADD COLUMN c int' end"""

_EPOCHS = f"""with recursive e as (select event_id as id, event_type, {logs.SCHEMA} as s, {logs.TABLE} as t,
   {_K10} as k from events),
 d as (select id, s, case when k in (0, 1, 4) then t else 'arch_' || t end as t,
   case when k in (1, 4) then 'arch_' || t when k = 3 then t end as dest
   from e where event_type = 'error' and k <= 4),
 x as (select id, s, t, null as dest, id as hit, 0 as role from d
   union all select id, s, dest, dest, null, 1 from d where dest is not null
   union all select id, s, t, t, null, 2 from e where event_type <> 'error'),
 n as (select *, min(hit) over (partition by s, t order by id, role rows between 1 following and unbounded
   following) as next from x),
 walk as (select id as event_id, s, t, next from n where role = 2
   union all select w.event_id, n.s, n.t, n.next from walk w join n on n.id = w.next and n.role = 1)
 select event_id, s as final_schema, t as final_table from walk where next is null"""


def _epoch_log(spark, sf):
    texts = logs.events(spark, sf).selectExpr(
        "*", f"{logs.SCHEMA} as s", f"{logs.TABLE} as t"
    )
    ddl = texts.filter("event_type = 'error'").selectExpr(
        *[f"{sql} as {name}" for name, sql in logs.POSITION.items() if name != "ordinal"],
        "s as schema_name",
        f"{_EPOCH_TEXT} as query",
    )
    changes = _accounts(spark, sf).filter("op <> 'delete'")
    return changes, effects.ddl_effects(with_ddl(ddl))


def _epochs(spark, sf, **options):
    changes, ddl = _epoch_log(spark, sf)
    kept = effects.apply_ddl_epochs(changes, ddl, logs.SEGMENT, **options)
    return kept.select("event_id", "final_schema", "final_table")


@query(_EPOCHS)
def ddl_epochs(spark, sf):
    return _epochs(spark, sf)


@query(_EPOCHS)
def ddl_epochs_merged(spark, sf):
    return _epochs(spark, sf, small=0)


@query(
    f"""select {_K10} as form, count(*) * case when {_K10} = 2 then 2 else 1 end as effects from events
 where event_type = 'error' and {_K10} <= 4 group by 1"""
)
def ddl_effects(spark, sf):
    _, found = _epoch_log(spark, sf)
    keyed_events = logs.events(spark, sf).selectExpr(
        "cast(floor(event_id / 2500.0) as bigint) + 1 as file_seq",
        "cast(4 + (event_id % 2500) * 100 as bigint) as pos",
        f"{_K10} as form",
    )
    return found.join(keyed_events, ["file_seq", "pos"]).groupBy("form").agg(
        F.count(F.lit(1)).alias("effects")
    )


_DROPS = f"""with e as (select event_id, event_type, {logs.SCHEMA} as s from events),
 d as (select s, max(event_id) as last from e where event_type = 'error' group by s)
 select event_id from e left join d using (s) where event_type <> 'error' and (last is null or event_id > last)"""


@query(_DROPS)
def drop_database_epochs(spark, sf):
    events = logs.events(spark, sf)
    ddl = events.filter("event_type = 'error'").selectExpr(
        *[f"{sql} as {name}" for name, sql in logs.POSITION.items() if name != "ordinal"],
        "'' as schema_name",
        f"'DROP DATABASE ' || {logs.SCHEMA} as query",
    )
    changes = _accounts(spark, sf).filter("op <> 'delete'")
    found = effects.ddl_effects(with_ddl(ddl))
    return effects.apply_ddl_epochs(changes, found, logs.SEGMENT).select("event_id")


@query(
    """select event_id, user_id, case when event_id < 2500 then 'none' else event_type end as kind,
 case when event_id < 2500 + 2000 then null else floor(value) end as amount
 from events"""
)
def schema_evolution(spark, sf):
    old_type = F.create_map(F.lit("id"), F.col("user_id").cast("string"), F.lit("note"), F.col("what"))
    new_type = F.create_map(
        F.lit("id"), F.col("user_id").cast("string"), F.lit("kind"), F.col("what"), F.lit("amount"),
        F.floor("value").cast("string"),
    )
    mid_type = F.create_map(
        F.lit("id"), F.col("user_id").cast("string"), F.lit("kind"), F.col("what"), F.lit("amount"), F.col("what")
    )
    steps = [
        {"at": (2, 0), "action": "drop", "column": "note"},
        {"at": (2, 1), "action": "add", "column": "kind0", "type": "string", "default": "none"},
        {"at": (2, 2), "action": "rename", "column": "kind0", "to": "kind"},
        {"at": (2, 3), "action": "add", "column": "amount", "type": "string"},
        {"at": (2, 200004), "action": "modify", "column": "amount", "type": "bigint"},
    ]
    at = F.struct("file_seq", "pos")
    image = (
        F.when(F.col("file_seq") < 2, old_type)
        .when((F.col("file_seq") == 2) & (F.col("pos") < 200004), mid_type)
        .otherwise(new_type)
    )
    log = _accounts(spark, sf).withColumn("image", image)
    evolved = log.select("event_id", effects.evolve_images(F.col("image"), at, steps).alias("m"))
    return evolved.select(
        "event_id",
        F.col("m")["id"].cast("long").alias("user_id"),
        F.col("m")["kind"].alias("kind"),
        F.col("m")["amount"].cast("double").alias("amount"),
    )


@query(
    """select cast(o_orderkey as bigint) as id, null as note, o_orderstatus as status, cast(0 as int) as rank,
   try_cast(o_orderpriority as int) as priority from orders
 union all select c_custkey, c_name, null, null, null from customer"""
)
def evolve_table(spark, sf):
    orders = logs.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    steps = [
        {"action": "rename", "column": "o_orderkey", "to": "id"},
        {"action": "rename", "column": "o_orderstatus", "to": "status"},
        {"action": "drop", "column": "o_totalprice"},
        {"action": "add", "column": "rank", "type": "int", "default": 0},
        {"action": "modify", "column": "o_orderpriority", "type": "int"},
        {"action": "rename", "column": "o_orderpriority", "to": "priority"},
    ]
    customers = logs.table(spark, sf, "customer").selectExpr("c_custkey as id", "c_name as note")
    return effects.union_epochs([effects.evolve_schema(orders, steps), customers])


@query(
    f"""select event_id, case when schema_name = 'shop' then event_type end as label,
 case when schema_name = 'crm' then event_type end as note,
 case when schema_name = 'ops' then case when event_id < 2500 then 'none' else event_type end end as memo,
 case when event_id % 3 <> 0 then cast(user_id as varchar) when schema_name <> 'crm' then 'x' end as amount
 from (select *, {logs.SCHEMA} as schema_name from events) e"""
)
def evolve_by_log(spark, sf):
    """Tables of three schemas, each with changes of its own; the steps are a table as well."""
    log = _accounts(spark, sf)
    steps = spark.createDataFrame(
        [
            ("shop", 2, 0, "rename", "note", "kind", None, None),
            ("shop", 2, 200004, "rename", "kind", "label", None, None),
            ("crm", 2, 0, "modify", "amount", None, "INT", None),
            ("ops", 2, 0, "drop", "note", None, None, None),
            ("ops", 2, 1, "add", "note", None, "string", "none"),
            ("ops", 2, 200004, "rename", "note", "memo", None, None),
        ],
        "schema_name string, file_seq long, pos long, action string, `column` string, `to` string, type string, `default` string",
    ).withColumn("ordinal", F.lit(0))
    tables = log.select("schema_name", "table_name").distinct()
    first, last = F.col("file_seq") < 2, (F.col("file_seq") > 2) | (F.col("pos") >= 200004)
    schema, number = F.col("schema_name"), F.col("user_id").cast("string")
    name = (
        F.when((schema == "crm") | first, F.lit("note"))
        .when(schema == "shop", F.when(last, F.lit("label")).otherwise(F.lit("kind")))
        .otherwise(F.when(last, F.lit("memo")).otherwise(F.lit("note")))
    )
    odd = F.when((schema != "crm") | first, F.lit("x"))
    amount = F.when(F.col("event_id") % 3 != 0, number).otherwise(odd)
    images = log.withColumn("image", F.create_map(name, F.col("what"), F.lit("amount"), amount))
    evolved = effects.evolve_by_log(images, tables.join(steps, "schema_name"), ["image"])
    return evolved.select("event_id", *[F.col("image")[c].alias(c) for c in ("label", "note", "memo", "amount")])
