"""Queries on event labels, statement texts and the table filter."""

from __future__ import annotations

from pyspark.sql import functions as F

from changetables.functions import ddl, events
from changetables.functions.text import label_or_unknown, trim_space
from changetables.operators.filters import TableFilter
from changetables.operators.metrics import is_filtered
from workloads import logs
from workloads.registry import query

_T = f"({logs.K}) % 20"
_S, _TAB, _U = f"({logs.SCHEMA})", f"({logs.TABLE})", "cast(user_id as varchar)"

# what each statement form names, written down by form rather than read from the text
NAMED = f"""case {_T}
 when 0 then '.' || {_TAB} when 1 then {_S} || '.' || {_TAB} when 2 then '.tmp_' || {_U} || '(id'
 when 3 then {_S} || '.' || {_TAB} when 4 then '.' || {_TAB} || ',' || {_S} || '.t' || {_U}
 when 5 then {_S} || '.' || {_TAB} when 6 then '.' || {_TAB}
 when 7 then '.' || {_TAB} || ',' || {_S} || '.old_' || {_TAB} || ',.a,.b' else '' end"""
DATABASE = f"""case {_T} when 8 then {_S} when 9 then {_S} || '_x' when 10 then 'tmp_' || {_U} end"""


def _mixed(spark, sf):
    return events.classify(logs.mixed_log(logs.events(spark, sf)))


def _queries(spark, sf):
    return ddl.with_ddl(logs.query_log(logs.events(spark, sf)))


def _names(column: str):
    return F.concat_ws(
        ",", F.transform(column, lambda t: F.concat(t["schema"], F.lit("."), t["table"]))
    )


@query("select event_id from events where event_type <> 'click'")
def drop_null_events(spark, sf):
    log = logs.events(spark, sf).withColumn("event_type", F.expr("nullif(event_type, 'click')"))
    return events.drop_null_events(log).select("event_id")


_KIND = "case event_type when 'error' then 'query' when 'view' then 'xid' else 'rows' end"
_LABEL = """case event_type when 'error' then 'query' when 'signup' then 'rows_insert'
 when 'click' then 'rows_update' when 'purchase' then 'rows_unknown' end"""


@query(f"select {_KIND} as kind, {_LABEL} as label, count(*) as events from events group by 1, 2")
def classify_events(spark, sf):
    return _mixed(spark, sf).groupBy("kind", "label").agg(F.count(F.lit(1)).alias("events"))


@query(
    f"""select coalesce(nullif(lower({logs.MIXED_TYPE}), 'xidevent'), 'unknown') as event_type,
 count(*) as events from events group by 1"""
)
def event_type_labels(spark, sf):
    log = logs.mixed_log(logs.events(spark, sf)).withColumn(
        "event_type", F.expr("nullif(event_type, 'XIDEvent')")
    )
    return log.groupBy(events.event_type_label(F.col("event_type")).alias("event_type")).agg(
        F.count(F.lit(1)).alias("events")
    )


@query(
    """select event_id, case event_type when 'signup' then 'rows_insert' when 'click' then 'rows_update'
 else 'rows_unknown' end as label from events"""
)
def rows_labels(spark, sf):
    return logs.mixed_log(logs.events(spark, sf)).select(
        "event_id", events.rows_label(F.col("op")).alias("label")
    )


@query("select doc_id, case when lang = 'en' then 'unknown' else lang end as label from documents")
def label_or_unknown_docs(spark, sf):
    lang = F.when(F.col("lang") != "en", F.col("lang")).otherwise("")
    return logs.table(spark, sf, "documents").select(
        "doc_id", label_or_unknown(lang).alias("label")
    )


@query(f"select event_id, cast(event_type = 'click' or event_type = 'signup' as int) as applies from events")
def supported_row_events(spark, sf):
    return _mixed(spark, sf).select(
        "event_id", F.coalesce(F.col("op").isin(*events.ROW_OPS), F.lit(False)).cast("int").alias("applies")
    )


@query(
    f"""select event_id, cast({_T} in (12, 13, 14) as int) as is_control,
 cast({_T} in (12, 13, 14, 15) as int) as is_skipped from events"""
)
def txn_control(spark, sf):
    text = F.col("query")
    return logs.query_log(logs.events(spark, sf)).select(
        "event_id",
        events.is_txn_control(text).cast("int").alias("is_control"),
        events.is_skipped_query(text).cast("int").alias("is_skipped"),
    )


@query(
    """select event_id, case when user_id = 0 then null else greatest(0, round(value - 50
 + (epoch_us(ts) % 1000000) / 1000000.0, 3)) end as lag from events"""
)
def event_lag(spark, sf):
    log = logs.account_log(logs.events(spark, sf))
    read = F.expr("event_ts + make_dt_interval(0, 0, 0, value - 50)")
    stamped = F.when(F.col("user_id") == 0, F.lit("1970-01-01").cast("timestamp")).otherwise(F.col("event_ts"))
    return log.select(
        "event_id", F.round(events.lag_seconds(read, stamped), 3).alias("lag")
    )


@query(
    r"""select doc_id, length(regexp_replace(regexp_replace(text, '^[\s\p{Z}]+', ''), '[\s\p{Z}]+$', '')) as chars
 from documents"""
)
def trimmed_text(spark, sf):
    padded = F.concat(F.lit(" \t\n"), F.col("text"), F.lit("\n  "))
    return logs.table(spark, sf, "documents").select(
        "doc_id", F.length(trim_space(padded)).cast("long").alias("chars")
    )


# -- statement texts -----------------------------------------------------------------


@query(
    r"""with w as (select doc_id, list_filter(regexp_split_to_array(text, '[\s\p{Z}]+'), lambda x: x <> '') as t
 from documents) select doc_id, len(t) as words, t[1] as first_word, t[-1] as last_word from w"""
)
def statement_words(spark, sf):
    commented = F.concat(
        F.lit("-- "), "source", F.lit("\n/* "), "lang", F.lit(" */ --\n"), "text", F.lit("\n")
    )
    tokens = ddl.ddl_tokens(commented)
    docs = logs.table(spark, sf, "documents").select("doc_id", tokens.alias("t"))
    return docs.select(
        "doc_id",
        F.size("t").cast("long").alias("words"),
        F.get("t", F.lit(0)).alias("first_word"),
        F.element_at("t", -1).alias("last_word"),
    )


@query("select doc_id, '' as rest from documents union all select doc_id, 'x' || lang from documents")
def strip_comments(spark, sf):
    docs = logs.table(spark, sf, "documents")
    clean = F.regexp_replace("text", r"\*/", "")
    open_comment = docs.select(
        "doc_id", ddl.strip_comments(F.concat(F.lit("/* a */ /* "), clean)).alias("rest")
    )
    closed = docs.select(
        "doc_id",
        ddl.strip_comments(
            F.concat(F.lit("--\n/* "), clean, F.lit("*/ -- x\n\n x"), F.col("lang"), F.lit("\n"))
        ).alias("rest"),
    )
    return open_comment.unionByName(closed)


@query(
    f"""select event_id, {NAMED} as tables, {DATABASE} as db,
 cast({_T} = 8 as int) as creates_db from events"""
)
def ddl_classify(spark, sf):
    return _queries(spark, sf).select(
        "event_id",
        _names("ddl_tables").alias("tables"),
        F.col("ddl_database").alias("db"),
        F.col("is_create_database").cast("int").alias("creates_db"),
    )


@query(
    f"""select coalesce({DATABASE}, '') as db, count(*) as statements from events group by 1"""
)
def ddl_databases(spark, sf):
    return _queries(spark, sf).groupBy(
        F.coalesce("ddl_database", F.lit("")).alias("db")
    ).agg(F.count(F.lit(1)).alias("statements"))


_TARGETS = f"""list_transform(list_filter(string_split({NAMED}, ','), lambda x: x <> ''),
 lambda x: case when x like '.%' then ({logs.SESSION_SCHEMA}) || x else x end)"""


@query(f"select event_id, array_to_string({_TARGETS}, ',') as targets from events")
def ddl_targets(spark, sf):
    return _queries(spark, sf).select("event_id", _names("targets").alias("targets"))


@query(
    f"""select event_id, cast(({logs.SESSION_SCHEMA}) <> '' and {_T} <> 8 as int) as enters from events"""
)
def enters_schema(spark, sf):
    return _queries(spark, sf).select(
        "event_id",
        ddl.enters_schema(F.col("schema_name"), F.col("tokens")).cast("int").alias("enters"),
    )


@query(
    """select doc_id, lang || '.' || source as cleaned, lang as schema_name, source as table_name
 from documents"""
)
def clean_identifiers(spark, sf):
    token = F.concat(F.lit(",`"), "lang", F.lit("`.`"), "source", F.lit("`),;"))
    docs = logs.table(spark, sf, "documents").select("doc_id", "lang", "source", token.alias("token"))
    table = ddl.parse_table(F.col("token"))
    return docs.select(
        "doc_id",
        ddl.clean_identifier(F.col("token")).alias("cleaned"),
        table["schema"].alias("schema_name"),
        table["table"].alias("table_name"),
    )


@query(
    f"""with d as (select event_id, unnest({_TARGETS}) as name from events)
 select string_split(name, '.')[1] as schema_name, count(*) as statements from d
 where string_split(name, '.')[1] <> '' group by 1"""
)
def cross_database_ddl(spark, sf):
    named = _queries(spark, sf).select(F.explode("targets").alias("t"))
    return (
        named.filter("t.schema <> ''")
        .groupBy(F.col("t.schema").alias("schema_name"))
        .agg(F.count(F.lit(1)).alias("statements"))
    )


# -- the table filter ----------------------------------------------------------------

LISTS = dict(
    whitelist_dbs=["shop ", ""],
    whitelist_tables=["acct_2", "ops.acct_0"],
    blacklist_dbs=[],
    blacklist_tables=["shop.acct_1", "acct_3"],
)
_BLACK = "(t = 'acct_3' or (s = 'shop' and t = 'acct_1'))"
_WHITE = "(s = 'shop' or t = 'acct_2' or (s = 'ops' and t = 'acct_0'))"
_ROWS = f"select event_id, {logs.SCHEMA} as s, {logs.TABLE} as t from events"
_PASSING = f"select event_id, s as schema_name, t as table_name from ({_ROWS}) where {_WHITE} and not {_BLACK}"


def _accounts(spark, sf):
    return logs.account_log(logs.events(spark, sf))


@query(_PASSING)
def table_filter(spark, sf):
    return TableFilter(**LISTS).rows(_accounts(spark, sf)).select("event_id", "schema_name", "table_name")


@query(_PASSING)
def table_filter_pushed(spark, sf):
    kept = TableFilter(**LISTS, clean_names=True).rows(_accounts(spark, sf))
    return kept.select("event_id", "schema_name", "table_name")


@query(_PASSING)
def table_filter_long_lists(spark, sf):
    kept = TableFilter(**LISTS).rows(_accounts(spark, sf), large=0)
    return kept.select("event_id", "schema_name", "table_name")


@query("select event_id from events")
def empty_filter(spark, sf):
    return TableFilter(["  "], [""]).rows(_accounts(spark, sf)).select("event_id")


@query(f"select event_id, cast(not (s = 'crm' or t = 'acct_1') as int) as allowed from ({_ROWS})")
def blacklist_filter(spark, sf):
    deny = TableFilter(blacklist_dbs=["crm"], blacklist_tables=["acct_1"])
    allowed = deny.allow(F.col("schema_name"), F.col("table_name"))
    return _accounts(spark, sf).select("event_id", allowed.cast("int").alias("allowed"))


# the session schema and the database alone must pass too; a bare schema matches only
# database entries, and a target without schema only bare table entries
_OK = "case when x like '.%' then {bare} else {full} end"
_ALLOW = f"""with q as (select event_id, ({logs.SESSION_SCHEMA}) as s, {DATABASE} as db, {_TARGETS} as targets
 from events) select event_id, cast((s = '' or s = 'shop') and (db is null or db = 'shop')
 and len(list_filter(targets, lambda x: not (
   (string_split(x, '.')[1] = 'shop' or string_split(x, '.')[2] = 'acct_2' or x = 'ops.acct_0')
   and not (string_split(x, '.')[2] = 'acct_3' or x = 'shop.acct_1')))) = 0 as int) as allowed from q"""


@query(_ALLOW)
def ddl_filter(spark, sf):
    allowed = TableFilter(**LISTS).allow_query(
        F.col("schema_name"), F.col("ddl_database"), F.col("ddl_tables")
    )
    return _queries(spark, sf).select("event_id", allowed.cast("int").alias("allowed"))


@query(
    f"""with m as (select {_KIND} as kind, {logs.SCHEMA} as s, case when {logs.K} = 7 then '' else {logs.TABLE} end as t,
 {_T} as form from events)
 select kind, cast(count(*) as bigint) as events from m where
 (kind = 'rows' and t <> '' and not ({_WHITE} and not {_BLACK}))
 or (kind = 'query' and form not in (12, 13, 14, 15) and s <> 'shop') group by kind"""
)
def filtered_events(spark, sf):
    allow = TableFilter(**LISTS)
    rows_ok = allow.allow(F.col("schema_name"), F.col("table_name"))
    session_ok = allow.allow(F.col("schema_name"), F.lit(""))
    allowed = F.when(F.col("kind") == "rows", rows_ok).otherwise(session_ok)
    return (
        _mixed(spark, sf)
        .filter(is_filtered(allowed))
        .groupBy("kind")
        .agg(F.count(F.lit(1)).alias("events"))
    )
