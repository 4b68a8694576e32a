"""Queries on row images: binding, pairing, skipped columns, types, checks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from changetables.functions import rows as images
from changetables.functions.types import declared_fields
from changetables.operators import validate as checks
from changetables.operators.images import (
    bind_columns as bind,
    decode_rows as decode,
    explode_rows as explode_images,
    normalise_rows as normalise,
    pair_updates as pair_images,
    typed_changes as typed,
)
from changetables.sources.catalogue import schema_history
from workloads import logs
from workloads.registry import ORACLES, query


def _history(events):
    tables = events.filter("table_name is not null").select("schema_name", "table_name").distinct()
    return schema_history(
        tables.withColumn("columns", F.array(F.lit("id"), F.lit("status"), F.lit("price")))
    )


def _bound(spark, sf):
    events = logs.packed_events(logs.table(spark, sf, "orders"))
    return bind(events, _history(events))


def _valid(spark, sf):
    return checks.split_valid(checks.validate(_bound(spark, sf)))[0].drop("error")


# one row per image pair of every order, as the source of the expected results
_BASE = """with o as (select o_orderkey as pos, o_custkey as file_seq, o_orderstatus as st, o_orderpriority as pr,
  cast(o_orderkey as varchar) as id, cast(cast(o_totalprice as decimal(12,2)) as varchar) as price,
  cast(cast(o_totalprice as decimal(12,2)) + cast(1 as decimal(12,2)) as varchar) as higher from orders),
 ok as (select * from o where pr not in ('4-NOT SPECIFIED', '2-HIGH') and not (st = 'P' and pr = '1-URGENT'))"""
_INSERTS = """select pos, 0 as ordinal, 'insert' as op, null as b_status, null as b_price, 'O' as a_status,
  price as a_price, 'id,status,price' as present from ok where st = 'O'
 union all select pos, 1, 'insert', null, null, 'U', case when pr = '5-LOW' then null else higher end,
  case when pr = '5-LOW' then 'id,status' else 'id,status,price' end from ok where st = 'O'"""
_DELETES = "select pos, 0, 'delete', 'P', price, null, null, '' from ok where st = 'P'"
_UPDATES = """select pos, 0 as ordinal, 'update' as op, 'F' as b_status, price as b_price, 'U' as a_status,
  case when pr = '5-LOW' then null else higher end as a_price,
  case when pr = '5-LOW' then 'id,status' else 'id,status,price' end as present from ok where st = 'F'
 union all select pos, 1, 'update', 'U', higher, 'F', price, 'id,status,price' from ok where st = 'F'"""


def _flat(changes):
    return changes.select(
        "pos",
        "ordinal",
        "op",
        F.col("before.status").alias("b_status"),
        F.col("before.price").alias("b_price"),
        F.col("after.status").alias("a_status"),
        F.col("after.price").alias("a_price"),
        F.concat_ws(",", "after_present").alias("present"),
    )


@query(
    """select o_orderkey as pos, case when o_orderpriority = '4-NOT SPECIFIED' or
 (o_orderstatus = 'P' and o_orderpriority = '1-URGENT' and false) then null else 'id,status,price' end as columns
 from orders"""
)
def bind_columns(spark, sf):
    return _bound(spark, sf).select(
        "pos", F.when(F.col("columns").isNotNull(), F.concat_ws(",", "columns")).alias("columns")
    )


@query(f"{_BASE} {_INSERTS} union all {_DELETES}")
def explode_rows(spark, sf):
    return _flat(explode_images(_valid(spark, sf)))


@query(f"{_BASE} {_UPDATES}")
def pair_updates(spark, sf):
    return _flat(pair_images(_valid(spark, sf)))


@query(f"{_BASE} {_INSERTS} union all {_DELETES} union all {_UPDATES}")
def decode_rows(spark, sf):
    return _flat(decode(_valid(spark, sf)))


@query(
    f"""{_BASE}, c as ({_INSERTS} union all {_DELETES} union all {_UPDATES})
 select pos, ordinal, op, case when op <> 'insert' then cast(pos as varchar) end as b_id, b_status, b_price,
  case when op <> 'delete' then cast(pos as varchar) end as a_id, a_status, a_price from c"""
)
def typed_changes(spark, sf):
    fields = T.StructType(
        [
            T.StructField("id", T.DecimalType(20, 0)),
            T.StructField("status", T.StringType()),
            T.StructField("price", T.DecimalType(12, 2)),
        ]
    )
    image = lambda side, c: F.col(f"{side}.{c}").cast("string").alias(f"{side[0]}_{c}")
    return typed(decode(_valid(spark, sf)), fields).select(
        "pos", "ordinal", "op", *[image(side, c) for side in ("before", "after") for c in ("id", "status", "price")]
    )


@query(ORACLES["typed_changes"])
def typed_changes_all(spark, sf):
    return typed_changes(spark, sf)


ALL_TYPES = {
    "id": "bigint unsigned",
    "c_int": "int not null",
    "c_varchar": "varchar(255)",
    "c_json": "json",
    "c_decimal": "decimal(10,2)",
    "c_bool": "tinyint(1)",
    "c_blob": "blob",
    "c_date": "date",
    "c_time": "time(3)",
    "c_ts": "timestamp null",
}


@query(
    """select cast(o_orderkey + 9223372036854775808 as varchar) as id, -(o_orderkey % 100) as c_int,
  case when o_orderpriority = '5-LOW' then null else o_orderpriority end as c_varchar,
  '{"a":[1,2.5,{"n":null}],"k":' || o_orderkey || ',"s":"' || o_orderstatus || '"}' as c_json,
  cast(cast(o_totalprice as decimal(10,2)) as varchar) as c_decimal, o_custkey % 2 as c_bool,
  to_base64(encode(o_orderpriority)) as c_blob, o_orderdate::date::varchar as c_date,
  case when o_orderkey % 3 = 0 then '-' else '' end || lpad((o_orderkey % 839)::varchar, greatest(2, length((o_orderkey % 839)::varchar))::int, '0')
    || ':' || lpad((o_custkey % 60)::varchar, 2, '0') || ':07' || case when o_custkey % 2 = 1 then '.25' else '' end as c_time,
  o_orderdate::date::varchar || ' 01:02:03' as c_ts, false as bad from orders where o_orderkey % 839 <> 0
 union all
 select null, null, null, null, null, null, null, null, null, null, true from orders where o_orderkey % 839 = 0"""
)
def typed_all(spark, sf):
    """Values of every column type, typed and written again; unfit ones are set aside."""
    key, sign = F.col("o_orderkey"), F.when(F.col("o_orderkey") % 3 == 0, "-").otherwise("")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    day = F.to_date("o_orderdate").cast("string")
    values = {
        "id": (key.cast("decimal(20,0)") + F.lit("9223372036854775808").cast("decimal(20,0)")).cast("decimal(20,0)").cast("string"),
        "c_int": (-(key % 100)).cast("string"),
        "c_varchar": F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")),
        "c_json": F.concat(
            F.lit('{ "s": "'), "o_orderstatus", F.lit('", "k": '), key.cast("string"), F.lit(', "a": [1, 2.50,{"n" : null}]}')
        ),
        "c_decimal": F.col("o_totalprice").cast("decimal(12,2)").cast("string"),
        "c_bool": (F.col("o_custkey") % 2).cast("string"),
        "c_blob": F.base64(F.col("o_orderpriority").cast("binary")),
        "c_date": day,
        "c_time": F.when(key % 839 == 0, "839:60:00").otherwise(
            F.concat(
                sign, F.when(key % 839 < 10, two(key % 839)).otherwise((key % 839).cast("string")), F.lit(":"),
                two(F.col("o_custkey") % 60), F.lit(":07"), F.when(F.col("o_custkey") % 2 == 1, ".25").otherwise(""),
            )
        ),
        "c_ts": F.concat(day, F.lit(" 01:02:03")),
    }
    image = F.map_from_arrays(F.array(*map(F.lit, values)), F.array(*values.values()))
    fields = declared_fields(ALL_TYPES)
    log = logs.table(spark, sf, "orders").select(
        F.lit("insert").alias("op"), F.lit(None).cast("map<string,string>").alias("before"), image.alias("after")
    )
    good, bad = checks.split_valid(checks.check_types(log, fields))
    rows = normalise(typed(good, fields).select("after.*"))
    text = rows.withColumns({c: F.col(c).cast("string") for c in ("id", "c_decimal", "c_date")})
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in text.schema]
    return text.withColumn("bad", F.lit(False)).unionByName(bad.select(*nothing, F.lit(True).alias("bad")))


@query(
    """select o_orderkey as pos, case when o_orderpriority = '5-LOW' then 'id,status' else 'id,status,price' end
 as second_image, 'id,status,price' as third_image from orders"""
)
def skip_columns(spark, sf):
    events = logs.packed_events(logs.table(spark, sf, "orders"))
    names = F.array(F.lit("id"), F.lit("status"), F.lit("price"))
    image = lambda i: images.present(names, images.skipped_of(F.col("skipped"), F.lit(i)))
    return events.select(
        "pos",
        F.concat_ws(",", image(1)).alias("second_image"),
        F.concat_ws(",", image(2)).alias("third_image"),
    )


@query("select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, value, props from events")
def normalise_rows(spark, sf):
    return normalise(logs.events(spark, sf).select("event_id", "ts", "value", "props"))


@query(
    """with s as (select nullif(cast(regexp_extract(props, '[0-9]+', 0) as int), 0) as slot, event_id from events),
 g as (select nullif(user_id, 0) as slot, min(event_id) as first_event from events group by 1)
 select s.event_id, g.first_event from s, g where s.slot is not distinct from g.slot"""
)
def null_safe_match(spark, sf):
    events = logs.events(spark, sf)
    slots = events.selectExpr(f"{logs.SLOT_BEFORE} as slot", "event_id")
    groups = events.groupBy(F.expr("nullif(user_id, 0)").alias("g_slot")).agg(
        F.min("event_id").alias("first_event")
    )
    on = images.row_match([F.col("slot")], [F.col("g_slot")])
    return slots.join(groups, on).select("event_id", "first_event")


@query(
    f"""{_BASE} select pos, ordinal, a_status as status,
 case when present like '%price%' then a_price else b_price end as price from ({_UPDATES}) q"""
)
def assign_present(spark, sf):
    changes = pair_images(_valid(spark, sf))
    pick = lambda c: images.assign(
        F.col(f"before.{c}"), F.col(f"after.{c}"), F.col("after_present"), c
    ).alias(c)
    return changes.select("pos", "ordinal", pick("status"), pick("price"))


_ERROR = """case when o_orderstatus = 'P' and o_orderpriority = '1-URGENT' then 'missing_table_map'
 when {early} then null when o_orderpriority = '4-NOT SPECIFIED' then 'column_count_mismatch'
 when o_orderpriority = '2-HIGH' then 'json_diff_unsupported' end"""


@query(f"select o_orderkey as pos, {_ERROR.format(early='false')} as error from orders")
def validate_events(spark, sf):
    return checks.validate(_bound(spark, sf)).select("pos", "error")


@query(f"""select o_orderkey as pos, {_ERROR.format(early="o_orderstatus = 'F'")} as error from orders""")
def validate_filtered(spark, sf):
    allowed = F.col("table_name") != "orders_f"
    return checks.validate(_bound(spark, sf), allowed=allowed).select("pos", "error")


@query(
    f"""select error, count(*) as events from (select {_ERROR.format(early='false')} as error from orders) q
 where error is not null group by 1"""
)
def dead_letters(spark, sf):
    rejected = checks.split_valid(checks.validate(_bound(spark, sf)))[1]
    return rejected.groupBy("error").agg(F.count(F.lit(1)).alias("events"))


@query(
    f"""with e as (select o_custkey, o_orderkey, {_ERROR.format(early='false')} as error from orders),
 f as (select min((o_custkey, o_orderkey)) as first from e where error = 'missing_table_map')
 select o_orderkey as pos from e, f where (o_custkey, o_orderkey) < first"""
)
def halt_at_first_error(spark, sf):
    checked = checks.validate(_bound(spark, sf))
    fatal = checked.withColumn("error", F.when(F.col("error") == checks.MISSING_TABLE_MAP, F.col("error")))
    accepted, _ = checks.split_valid(fatal, "halt")
    return accepted.select("pos")
