"""Queries on row images that carry only some columns, and on DDL over rows that are there."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from changetables.functions.ddl import with_ddl
from changetables.operators import ddl_effects as effects
from changetables.operators import exact, keyed
from changetables.sources.changelog import read_changelog
from changetables.streaming import apply
from workloads import logs
from workloads.registry import query
from workloads.replays import _BUMP, _EPOCH_TEXT, _EPOCHS, _FINAL, _FINAL_ORDERS, _orders
from workloads.streams import ACCOUNT, _folder

# -- a table without a key: slot and tag ---------------------------------------------

_TAG = "'t' || cast(user_id % 3 as string)"
_BEFORE_TAG = f"({logs.K}) % 10 = 0 and event_type <> 'error'"
_SETS_SLOT = f"case when event_type = 'signup' then true else ({logs.K}) % 3 <> 1 end"
_SETS_TAG = f"case when event_type = 'signup' then ({logs.K}) % 4 <> 0 else ({logs.K}) % 3 <> 0 end"
_NEW_TAG = "'t' || cast(event_id % 3 as string)"


@query(
    f"""with recursive c as (select event_id as id, {logs.OP} as op, {logs.SLOT_BEFORE} as slot, {_TAG} as tag,
   {_BEFORE_TAG} as by_tag, {_SETS_SLOT} as sets_slot, {_SETS_TAG} as sets_tag, {logs.SLOT_AFTER} as new_slot,
   {_NEW_TAG} as new_tag from events),
 walk as (
   select id as token, id as since, new_slot as slot, case when sets_tag then new_tag else 'none' end as tag,
     true as alive from c where op = 'insert'
   union all
   select n.token, h.id, case when h.sets_slot then h.new_slot else n.slot end,
     case when h.sets_tag then h.new_tag else n.tag end, h.op = 'update'
   from (select w.token, w.slot, w.tag, min(c.id) as next from walk w join c on c.slot is not distinct from w.slot
     and c.op <> 'insert' and c.id > w.since and (not c.by_tag or c.tag = w.tag) where w.alive group by all) n
   join c h on h.id = n.next),
 last as (select token, max(since) as since from walk group by token)
 select slot, tag, count(*) as copies from walk join last using (token, since) where alive group by slot, tag"""
)
def partial_replay_keyless(spark, sf):
    """Changes match by slot, or by slot and tag, and set one of them or both."""
    log = logs._header(logs.events(spark, sf)).selectExpr(
        "file_seq",
        "pos",
        "ordinal",
        "op",
        f"case when op <> 'insert' then named_struct('slot', {logs.SLOT_BEFORE}, 'tag', {_TAG}) end as before",
        f"case when op <> 'delete' then named_struct('slot', {logs.SLOT_AFTER}, 'tag', {_NEW_TAG}) end as after",
        f"case when {_BEFORE_TAG.replace('event_type', 'what')} then array('slot', 'tag') else array('slot') end as before_present",
        f"""filter(array(case when {_SETS_SLOT.replace('event_type', 'what')} then 'slot' end,
          case when {_SETS_TAG.replace('event_type', 'what')} then 'tag' end), x -> x is not null) as after_present""",
    )
    return exact.replay(log, defaults={"tag": F.lit("none")})


# -- minimal images of orders --------------------------------------------------------


def _minimal(changes):
    """Before images with the key only, after images of updates with what changed."""
    key, names = "o_orderkey", logs.ORDER_COLUMNS
    changed = F.array(
        *[F.when(~F.col(f"before.{n}").eqNullSafe(F.col(f"after.{n}")), n) for n in names]
    )
    present = F.when(F.col("op") == "update", F.filter(changed, lambda n: n.isNotNull()))
    row_type = changes.schema["after"].dataType

    def only(side, names_column):
        kept = [
            F.when(F.array_contains(names_column, n), F.col(f"{side}.{n}")).alias(n) for n in names
        ]
        return F.when(F.col(side).isNotNull(), F.struct(*kept)).cast(row_type)

    listed = changes.withColumns({"before_present": F.array(F.lit(key)), "after_present": present})
    whole = F.coalesce("after_present", F.array(*map(F.lit, names)))
    return listed.select(
        "file_seq", "pos", "ordinal", "op", only("before", F.col("before_present")).alias("before"),
        only("after", whole).alias("after"), "before_present", "after_present",
    )


_UNMOVED = _FINAL_ORDERS.format(
    status=f"case when {_BUMP} then 'U' else o_orderstatus end",
    price=f"case when {_BUMP} then o_totalprice + 1 else o_totalprice end",
)


@query(f"select * from ({_UNMOVED}) q where o_orderkey >= 0")
def partial_key_absent(spark, sf):
    """Updates whose after images lack the key, folded column by column."""
    orders = logs.table(spark, sf, "orders").filter("o_orderpriority <> '5-LOW'")
    return keyed.latest_by_key(_minimal(logs.order_log(orders)), ["o_orderkey"], logs.order_base(orders))


@query(_FINAL)
def partial_key_moves(spark, sf):
    """The same with updates that carry nothing but a new key, replayed exactly."""
    changes, base = _orders(spark, sf)
    return keyed.latest_by_key(_minimal(changes), ["o_orderkey"], base)


# -- streams -------------------------------------------------------------------------

_LAST = "max(case when {when} then event_id end) over (partition by user_id)"


@query(
    f"""with e as (select *, {_LAST.format(when="event_type in ('signup', 'error')")} as reset from events),
 f as (select user_id, reset, max(case when event_id = reset then event_type end) as kind,
   arg_max(event_type, event_id) filter (event_type = 'view' and event_id > reset) as seen,
   arg_max(value, event_id) filter (event_type in ('click', 'purchase') and event_id > reset) as value
   from e group by user_id, reset)
 select user_id, coalesce(seen, 'signup') as event_type, coalesce(value, -1.0) as value from f where kind = 'signup'"""
)
def partial_stream(spark, sf):
    """Updates of one column each, in files that arrive out of order, compacted once."""
    folder = _folder(spark)
    target = apply.Target(
        f"{folder}/accounts", ("user_id",), ACCOUNT, partial=True, defaults={"value": -1.0}
    )
    kind = F.col("what")
    given = F.when(kind == "view", F.array(F.lit("event_type"))).when(
        kind.isin("click", "purchase"), F.array(F.lit("value"))
    ).otherwise(F.array(F.lit("user_id"), F.lit("event_type")))
    for turn, parts in enumerate(((2, 0), (3, 1))):
        for part in parts:
            rows = logs.events(spark, sf).filter(F.pmod("event_id", F.lit(4)) == part)
            rows.write.mode("append").parquet(f"{folder}/log")
        stream = read_changelog(spark, f"{folder}/log", streaming=True, schema=logs.EVENTS_SCHEMA, max_files=1)
        log = logs.account_log(stream).withColumns({"before_present": F.array(F.lit("user_id")), "after_present": given})
        apply.drain(apply.start_apply(log, target, f"{folder}/checkpoint"))
        if turn == 0:
            apply.compact(spark, target)
            apply.clean(spark, target)
    return apply.read_current(spark, target)


@query(
    """with c as (select max(event_id) as last from events where event_id % 7 = 6),
 r as (select *, row_number() over (partition by user_id order by event_id desc) as r from events, c where event_id <= last)
 select user_id, event_type, value from r where r = 1 and event_type <> 'error'"""
)
def stream_commits(spark, sf):
    """Transactions of seven events, cut between files; the last one has no commit yet."""
    folder = _folder(spark)
    target = apply.Target(f"{folder}/accounts", ("user_id",), ACCOUNT)
    count = logs.events(spark, sf).count()
    for turn in range(3):
        part = logs.events(spark, sf).filter(F.floor(F.col("event_id") * 3 / count) == turn)
        log = logs.account_log(part).withColumn("source_id", F.lit("src"))
        commit = log.filter("event_id % 7 = 6").withColumns(
            {
                "event_type": F.lit("XIDEvent"),
                "op": F.lit(None).cast("string"),
                "pos": F.col("pos") + 50,
                **{c: F.lit(None).cast(log.schema[c].dataType) for c in ("before", "after")},
            }
        )
        log.unionByName(commit).write.mode("append").parquet(f"{folder}/log")
        stream = read_changelog(spark, f"{folder}/log", streaming=True, schema=log.schema)
        apply.drain(apply.start_apply(stream, target, f"{folder}/checkpoint", commits=True))
    return apply.read_current(spark, target)


# -- DDL over rows that are there -----------------------------------------------------

_BASE_NAMES = (
    "case c_custkey % 3 when 0 then 'shop' when 1 then 'crm' else 'ops' end",
    "case when c_custkey % 5 = 0 then 'arch_' else '' end || 'acct_' || cast(c_custkey % 4 as string)",
)
_WITH_BASE = _EPOCHS.replace(
    "union all select id, s, t, t, null, 2 from e where event_type <> 'error')",
    "union all select id, s, t, t, null, 2 from e where event_type <> 'error'\n"
    f"   union all select -1 - c_custkey, {_BASE_NAMES[0]}, {_BASE_NAMES[1]}, null, null, 2 from customer)",
)


def _statements(events):
    return events.selectExpr("*", f"{logs.SCHEMA} as s", f"{logs.TABLE} as t").selectExpr(
        "event_id",
        *[f"{sql} as {name}" for name, sql in logs.POSITION.items()],
        "s as schema_name",
        f"case when event_type = 'error' then {_EPOCH_TEXT} end as query",
    )


@query(_WITH_BASE)
def ddl_epochs_base(spark, sf):
    """Rows of the log and rows that were there before it, after all statements."""
    events = logs.events(spark, sf)
    ddl = _statements(events).filter("query is not null").drop("ordinal", "event_id")
    changes = logs.account_log(events).filter("op <> 'delete'")
    base = logs.table(spark, sf, "customer").selectExpr(
        "-1 - c_custkey as event_id", f"{_BASE_NAMES[0]} as schema_name", f"{_BASE_NAMES[1]} as table_name"
    )
    kept = effects.apply_ddl_epochs(changes, effects.ddl_effects(with_ddl(ddl)), logs.SEGMENT, base=base)
    return kept.select("event_id", "final_schema", "final_table")


@query(
    f"""with w as ({_EPOCHS}), r as (select w.*, e.user_id, e.event_type, e.value, row_number() over (
   partition by final_schema, final_table, user_id order by event_id desc) as r from w join events e using (event_id))
 select final_schema as schema_name, final_table as table_name, user_id, event_type, value from r where r = 1"""
)
def stream_ddl(spark, sf):
    """Row changes and statements in one stream of several batches, compacted once."""
    folder, names = _folder(spark), ["user_id", "event_type", "value"]
    tables = apply.TableSet(
        f"{folder}/tables",
        {(s, f"{p}acct_{i}"): ("user_id",) for s in ("shop", "crm", "ops") for p in ("", "arch_") for i in range(4)},
        buckets=4,
    )
    text = lambda side: F.when(
        F.col(side).isNotNull(),
        F.map_from_arrays(
            F.array(*map(F.lit, names)), F.array(*[F.col(f"{side}.{n}").cast("string") for n in names])
        ),
    )
    count = logs.events(spark, sf).count()
    for turn in range(3):
        part = logs.events(spark, sf).filter((F.floor(F.col("event_id") * 3 / count) == turn))
        # a turn's files are one batch: split between batches they could come out of order
        part.write.mode("append").parquet(f"{folder}/log")
        stream = read_changelog(spark, f"{folder}/log", streaming=True, schema=logs.EVENTS_SCHEMA)
        is_statement = F.col("op") == "delete"
        log = (
            logs.account_log(stream)
            .withColumns({"before": text("before"), "after": text("after"), "query": _query_text()})
            .withColumn("op", F.when(~is_statement, F.col("op")))
        )
        # account_log keys its before images only; what it leaves alone is written whole
        log = log.withColumn("before", F.when(F.col("op") == "update", F.col("after")))
        apply.drain(apply.start_apply_tables(log, tables, f"{folder}/checkpoint"))
        if turn == 1:
            apply.compact(spark, tables)
            apply.clean(spark, tables)
    rows = apply.live_rows(apply.read_state(spark, tables), tables)
    return rows.select(
        "schema_name",
        "table_name",
        *[F.col("row")[f.name].cast(f.dataType).alias(f.name) for f in ACCOUNT],
    )


def _query_text():
    """The statement of an event that stands for one."""
    text = re.sub(r"\|\| s\b", "|| schema_name", re.sub(r"\|\| t\b", "|| table_name", _EPOCH_TEXT))
    return F.when(F.col("op") == "delete", F.expr(text))
