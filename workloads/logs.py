"""Change logs made of the given tables.

Every row of a table becomes one or more log entries, so a log grows with its table.
The column expressions are plain SQL that Spark and DuckDB read alike; the oracle
texts use the same ones to build the same log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changetables.functions.rows import explode_present
from changetables.sources.changelog import read_changelog

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

#: Log bytes per segment where a query scans few large keys: small, so that small
#: tables span many segments.
SEGMENT = 64 * 1024

# the position of an event in the log, 2,500 events of 100 bytes per file
POSITION = {
    "file_seq": "cast(floor(event_id / 2500.0) as bigint) + 1",
    "pos": "cast(4 + (event_id % 2500) * 100 as bigint)",
    "end_pos": "cast(104 + (event_id % 2500) * 100 as bigint)",
    "ordinal": "0",
}
FILE = "'log-bin.' || lpad(cast(cast(floor(event_id / 2500.0) as bigint) + 1 as string), 6, '0')"
SOURCE = "'src-' || cast(user_id % 2 as string)"
OP = "case event_type when 'signup' then 'insert' when 'error' then 'delete' else 'update' end"
HEADER = (
    "case event_type when 'signup' then 'WriteRowsEventV2' "
    "when 'error' then 'DeleteRowsEventV2' else 'UpdateRowsEventV2' end"
)
SCHEMA = "case user_id % 3 when 0 then 'shop' when 1 then 'crm' else 'ops' end"
TABLE = "'acct_' || cast(user_id % 4 as string)"
SLOT_BEFORE = "nullif(cast(regexp_extract(props, '[0-9]+', 0) as int), 0)"
SLOT_AFTER = "nullif(cast(floor(value / 5) as int), 0)"
K = "cast(regexp_extract(props, '[0-9]+', 0) as int)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_changelog(spark, f"{sf_dir}/events.parquet", schema=EVENTS_SCHEMA)


def _header(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        f"{SOURCE} as source_id",
        f"{FILE} as file",
        *[f"{sql} as {name}" for name, sql in POSITION.items()],
        f"{SOURCE} as gtid_source",
        "event_id as gtid_seq",
        "cast(ts as timestamp) as event_ts",
        f"{SCHEMA} as schema_name",
        f"{TABLE} as table_name",
        f"{OP} as op",
        f"{HEADER} as event_type",
        "event_type as what",
        "event_id",
        "user_id",
        "value",
        "props",
    )


def account_log(events_df: DataFrame) -> DataFrame:
    """Row events on accounts keyed by user; inconsistent on purpose (drift)."""
    image = F.struct("user_id", F.col("what").alias("event_type"), "value")
    key_only = F.struct(
        "user_id",
        F.lit(None).cast("string").alias("event_type"),
        F.lit(None).cast("double").alias("value"),
    )
    return (
        _header(events_df)
        .withColumn("before", F.when(F.col("op") != "insert", key_only))
        .withColumn("after", F.when(F.col("op") != "delete", image))
    )


def slot_log(events_df: DataFrame) -> DataFrame:
    """Row events on a table without a key: one slot number per row, often equal.

    The before and after slots come from unrelated columns, so changes hit several
    rows, none, or rows an earlier change put there; slot 0 reads NULL.
    """
    keyed = _header(events_df)
    return keyed.selectExpr(
        "file_seq",
        "pos",
        "ordinal",
        "op",
        "event_id",
        f"case when op <> 'insert' then named_struct('slot', {SLOT_BEFORE}) end as before",
        f"case when op <> 'delete' then named_struct('slot', {SLOT_AFTER}) end as after",
    )


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]


def order_base(orders: DataFrame) -> DataFrame:
    """Orders that were there before the log starts."""
    return orders.filter("o_orderstatus <> 'O'").select(*ORDER_COLUMNS)


def order_log(orders: DataFrame) -> DataFrame:
    """A consistent log on orders, in four steps that are one log file each.

    1 open orders are inserted; 2 urgent and high ones get status U and a price one
    higher; 3 low ones move to the key -1 - key; 4 orders with status P at the start
    are deleted unless their priority is not specified.
    """
    bumped = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    moved = F.col("o_orderpriority") == "5-LOW"
    deleted = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") != "4-NOT SPECIFIED")
    new_key = -1 - F.col("o_orderkey")

    def image(key, status=F.col("o_orderstatus"), price=F.col("o_totalprice")):
        return F.struct(
            key.alias("o_orderkey"),
            F.col("o_custkey"),
            status.alias("o_orderstatus"),
            price.alias("o_totalprice"),
        )

    first = image(F.col("o_orderkey"))
    second = image(
        F.col("o_orderkey"),
        F.when(bumped, "U").otherwise(F.col("o_orderstatus")),
        F.when(bumped, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
    )
    third = image(new_key)
    last = F.when(moved, third).otherwise(second)

    def step(number: int, op: str, before, after):
        parts = [F.lit(number).cast("long").alias("file_seq"), F.lit(op).alias("op")]
        empty = F.when(F.lit(False), first)
        parts.append((empty if before is None else before).alias("before"))
        parts.append((empty if after is None else after).alias("after"))
        return F.struct(*parts)

    steps = [
        F.when(F.col("o_orderstatus") == "O", step(1, "insert", None, first)),
        F.when(bumped, step(2, "update", first, second)),
        F.when(moved, step(3, "update", second, third)),
        F.when(deleted, step(4, "delete", last, None)),
    ]
    pos = (F.lit(4) + F.col("o_orderkey") * 100).alias("pos")
    return explode_present(orders, [pos], steps, "s").select("s.file_seq", "pos", F.lit(0).alias("ordinal"), "s.op", "s.before", "s.after")


def bag_log(lineitem: DataFrame) -> DataFrame:
    """Inserts of all line items by ship month, and a delete after each untaxed one."""
    image = F.struct("l_returnflag", "l_linestatus", "l_quantity")
    entries = [
        F.struct(F.lit(0).alias("ordinal"), F.lit("insert").alias("op")),
        F.when(F.col("l_tax") == 0, F.struct(F.lit(1).alias("ordinal"), F.lit("delete").alias("op"))),
    ]
    month = F.year("l_shipdate") * 100 + F.month("l_shipdate")
    header = [month.cast("long").alias("file_seq"), F.col("l_orderkey").alias("pos"), image.alias("image")]
    return explode_present(lineitem, header, entries, "e").select(
        "file_seq",
        "pos",
        "e.ordinal",
        "e.op",
        F.when(F.col("e.op") == "delete", F.col("image")).alias("before"),
        F.when(F.col("e.op") == "insert", F.col("image")).alias("after"),
    )


# Query events: one statement per event. Kinds follow the number in ``props``.
QUERY_TEXT = f"""case {K} % 20
 when 0 then 'CREATE TABLE IF NOT EXISTS ' || {TABLE} || ' (id int)'
 when 1 then 'create table `' || {SCHEMA} || '`.`' || {TABLE} || '` (id int)'
 when 2 then 'CREATE TEMPORARY TABLE tmp_' || cast(user_id as string) || '(id int)'
 when 3 then 'ALTER TABLE ' || {SCHEMA} || '.' || {TABLE} || ' ADD COLUMN c int'
 when 4 then 'DROP TABLE IF EXISTS ' || {TABLE} || ', `' || {SCHEMA} || '`.`t' || cast(user_id as string) || '` CASCADE'
 when 5 then 'TRUNCATE TABLE ' || {SCHEMA} || '.' || {TABLE} || ';'
 when 6 then 'truncate ' || {TABLE}
 when 7 then 'RENAME TABLE ' || {TABLE} || ' TO ' || {SCHEMA} || '.old_' || {TABLE} || ', a TO b'
 when 8 then 'CREATE DATABASE ' || {SCHEMA}
 when 9 then '-- new' || chr(10) || ' CREATE SCHEMA IF NOT EXISTS `' || {SCHEMA} || '_x`'
 when 10 then 'DROP DATABASE IF EXISTS tmp_' || cast(user_id as string)
 when 11 then '/* hint */ CREATE VIEW v AS SELECT 1'
 when 12 then 'BEGIN'
 when 13 then ' Commit '
 when 14 then 'rollback'
 when 15 then '   '
 when 16 then '/* open ' || {TABLE}
 when 17 then 'INSERT INTO ' || {TABLE} || ' VALUES (1)'
 when 18 then 'SAVEPOINT s'
 else 'BEGIN;' end"""
SESSION_SCHEMA = f"case when event_type = 'view' then '' else {SCHEMA} end"


def query_log(events_df: DataFrame) -> DataFrame:
    """Query events: DDL and other statements of every form the filter knows."""
    return events_df.selectExpr(
        f"{SOURCE} as source_id",
        *[f"{sql} as {name}" for name, sql in POSITION.items()],
        "'QueryEvent' as event_type",
        "cast(null as string) as op",
        f"{SESSION_SCHEMA} as schema_name",
        "cast(null as string) as table_name",
        f"{QUERY_TEXT} as query",
        "event_id",
        f"{K} as k",
        "user_id",
    )


# Row and query events mixed: one in five events carries a statement instead.
MIXED_TYPE = (
    "case when event_type = 'error' then 'QueryEvent' "
    "when event_type = 'view' then 'XIDEvent' when event_type = 'signup' then 'WriteRowsEventV2' "
    "else 'UpdateRowsEventV2' end"
)
MIXED_OP = "case event_type when 'signup' then 'insert' when 'click' then 'update' end"


def mixed_log(events_df: DataFrame) -> DataFrame:
    """Rows, query and commit events; purchases are of an unsupported row operation."""
    return events_df.selectExpr(
        f"{SOURCE} as source_id",
        f"{FILE} as file",
        *[f"{sql} as {name}" for name, sql in POSITION.items()],
        f"{SOURCE} as gtid_source",
        "event_id as gtid_seq",
        "case when event_type in ('view', 'error') then '' || cast(event_id as string) end as gtid_set",
        "cast(ts as timestamp) as event_ts",
        f"{MIXED_TYPE} as event_type",
        f"{MIXED_OP} as op",
        f"{SCHEMA} as schema_name",
        f"case when {K} = 7 then '' else {TABLE} end as table_name",
        f"case when event_type = 'error' then {QUERY_TEXT} end as query",
        "event_id",
        "value",
        f"{K} as k",
    )


def audit_log(events_df: DataFrame) -> DataFrame:
    """The mixed log with read times, durations, errors and checkpoint results."""
    from changetables.functions.events import classify

    extra = {
        "ts": "event_ts + make_dt_interval(0, 0, 0, value - 50)",
        "seconds": "value / 100",
        "error_stage": "case when event_type = 'XIDEvent' and k in (1, 2) then null when k = 1 then 'exec' when k = 2 then 'bind' "
        "when k = 3 then 'state' when k = 4 then 'read' end",
        "error": "case when k in (1, 2) then 'failed' end",
        "checkpoint_result": "case when k = 5 then 'fail' when k between 6 and 9 then 'success' end",
        "up": "case when k = 10 then 1 when k = 11 then 0 end",
    }
    mixed = classify(mixed_log(events_df))
    return mixed.selectExpr("*", *[f"{sql} as {name}" for name, sql in extra.items()])


def packed_events(orders: DataFrame) -> DataFrame:
    """Orders as captured row events: positional text values, skipped columns.

    Status O is an insert, P a delete, F an update of two row pairs. Priority 5 leaves
    column 2 out of the second image; priority 3 lacks column names; priority 4 has a
    wrong column count; deletes of priority 1 come without a table.
    """
    price = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    higher = (F.col("o_totalprice").cast("decimal(12,2)") + F.lit(1).cast("decimal(12,2)")).cast("decimal(12,2)").cast("string")
    key, status = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    row = F.array(key, status, price)
    other = F.array(key, F.lit("U"), higher)
    none = F.array().cast("array<int>")
    skipped = F.when(
        F.col("o_orderpriority") == "5-LOW", F.array(none, F.array(F.lit(2)))
    ).otherwise(F.array(none))
    names = F.array(F.lit("id"), F.lit("status"), F.lit("price"))
    return orders.select(
        F.lit("src").alias("source_id"),
        F.col("o_custkey").alias("file_seq"),
        F.col("o_orderkey").alias("pos"),
        F.lit("rows").alias("kind"),
        F.when(status == "O", "insert").when(status == "P", "delete").otherwise("update").alias("op"),
        F.when((status == "P") & (F.col("o_orderpriority") == "1-URGENT"), None)
        .otherwise(F.lit("shop"))
        .alias("schema_name"),
        F.when((status == "P") & (F.col("o_orderpriority") == "1-URGENT"), None)
        .otherwise(F.concat(F.lit("orders_"), F.lower("o_orderstatus")))
        .alias("table_name"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", 4).otherwise(3).alias("column_count"),
        F.when(F.col("o_orderpriority") == "3-MEDIUM", F.array(F.lit("id"), F.lit(""), F.lit("price")))
        .otherwise(names)
        .alias("columns"),
        F.when(status == "F", F.array(row, other, other, row)).when(status == "P", F.array(row)).otherwise(F.array(row, other)).alias("rows"),
        skipped.alias("skipped"),
        F.when(F.col("o_orderpriority") == "2-HIGH", F.array(F.array(F.lit(1)))).otherwise(F.array(none)).alias("json_diffs"),
    )
