import pytest
from pyspark.sql import functions as F

import changetables as ct
from changetables.functions import ddl, events
from changetables.functions.text import label_or_unknown, trim_space
from changetables.operators.filters import TableFilter
from helpers import rows

# One statement of our own for each rule of the statement grammar.
CREATES_DATABASE = {
    "create Database ledger_2021": True,  # key words in any case
    "\tcreate\n database\t ledger": True,  # any white space, also in front
    "/* moved */ -- by hand\n create database ledger": True,  # comments of both forms before it
    "# shell style\ncreate database ledger": False,  # not a comment form here
    "/*!50000 kept */ create database ledger": True,
    "create or replace database ledger": False,  # the second word decides
    "create schema ledger": False,
    "create user ledger": False,
    "show create database ledger": False,
    "create": False,
    "-- create database ledger": False,
    "/* never closed create database ledger": False,
    "\n": False,
}

DATABASES = {
    "create database ledger": "ledger",
    "Create Schema `Ledger-2`": "Ledger-2",  # quotes go, case stays
    "drop schema if exists ledger": "ledger",
    "create database if not exists ledger;": "ledger",
    "drop database": None,
    "create schema if not exists": None,
    "drop view ledger": None,
    "use ledger": None,
}

TABLES = {
    # create
    "create table accounts (no int)": [("", "accounts")],
    "create table if not exists accounts": [("", "accounts")],
    "create temporary table `work`.`sums` as select 2": [("work", "sums")],
    "create table accounts(no int)": [("", "accounts(no")],  # cut at white space only
    "create table ledger.": [],
    "create table": [],
    "create index i on accounts (no)": [],
    # alter and truncate take the next word
    "alter table ledger.accounts drop column no": [("ledger", "accounts")],
    "alter table if exists accounts": [("", "if")],
    "truncate ledger.accounts;": [("ledger", "accounts")],
    "truncate table accounts": [("", "accounts")],
    "truncate table if exists accounts": [("", "if")],
    "truncate": [],
    "truncate table": [],
    # drop takes a list, up to its option
    "drop table ledger.accounts ,entries,`old`.`sums`": [("ledger", "accounts"), ("", "entries"), ("old", "sums")],
    "drop table if exists accounts cascade entries": [("", "accounts")],
    "drop temporary table one.two.three": [("one", "two.three")],  # the first dot splits
    "drop schema ledger": [],
    "drop": [],
    # rename takes pairs
    "rename table accounts to ledger.accounts , entries to postings": [
        ("", "accounts"), ("ledger", "accounts"), ("", "entries"), ("", "postings"),
    ],
    "rename table accounts to entries to postings": [("", "accounts"), ("", "entries")],
    "rename table old accounts to entries": [("", "accounts"), ("", "entries")],
    "rename table to to entries": [("", "to"), ("", "entries")],
    "rename table accounts to": [],
}


def _column(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, q string")
    return [r[0] for r in df.withColumn("t", ddl.ddl_tokens(F.col("q"))).orderBy("i").select(expression).collect()]


def test_create_database(spark):
    got = _column(spark, CREATES_DATABASE, ddl.is_create_database(F.col("t")))
    assert dict(zip(CREATES_DATABASE, got)) == CREATES_DATABASE


def test_databases(spark):
    got = _column(spark, DATABASES, ddl.ddl_database(F.col("t")))
    assert dict(zip(DATABASES, got)) == DATABASES


def test_tables(spark):
    got = _column(spark, TABLES, ddl.ddl_tables(F.col("t")))
    assert {q: [tuple(t) for t in v] for q, v in zip(TABLES, got)} == TABLES


def test_identifier_cleaning(spark):
    cases = {"`a`": "a", ",a;": "a", "a(": "a", "a)(": "a", "`a``b`": "ab", "(a": "(a", ",;": ""}
    df = spark.createDataFrame([(k,) for k in cases], "q string")
    assert dict(df.select("q", ddl.clean_identifier(F.col("q"))).collect()) == cases


def test_transaction_words_and_labels(spark):
    cases = {
        "BEGIN": True, " begin\n": True, "Commit": True, "rollback": True,
        "BEGIN;": False, "SAVEPOINT x": False, "XA START 'x'": False, "": False,
    }
    df = spark.createDataFrame([(k,) for k in cases], "q string")
    assert dict(df.select("q", events.is_txn_control(F.col("q"))).collect()) == cases
    names = spark.createDataFrame([("WriteRowsEventV2",), ("",), (None,)], "t string")
    assert rows(names.select(events.event_type_label(F.col("t")))) == [("unknown",), ("unknown",), ("writerowseventv2",)]
    assert rows(names.select(label_or_unknown(F.col("t")))) == [("WriteRowsEventV2",), ("unknown",), ("unknown",)]
    kinds = {
        "WriteRowsEventV2": "rows", "update_rows": "rows", "RowsQueryEvent": "other", "QueryEvent": "query",
        "XIDEvent": "xid", "RotateEvent": "other", "TableMapEvent": "other",
    }
    df = spark.createDataFrame([(k,) for k in kinds], "t string")
    assert dict(df.select("t", events.event_kind(F.col("t"))).collect()) == kinds


def test_unicode_trim(spark):
    df = spark.createDataFrame([(" \t x y \n",)], "q string")
    assert df.select(trim_space(F.col("q"))).first()[0] == "x y"


# (lists, schema, table, allowed): one case of our own for each rule.
FILTERS = [
    ({}, "ledger", "entries", True),  # without lists all pass
    (dict(whitelist_dbs=["ledger", "hr"]), "hr", "people", True),
    (dict(whitelist_dbs=["ledger", "hr"]), "web", "clicks", False),
    (dict(whitelist_tables=["people"]), "anywhere", "people", True),  # a bare name is a table of any schema
    (dict(whitelist_tables=["hr.people"]), "web", "people", False),
    (dict(whitelist_tables=["hr.people"]), "hr", "people", True),
    (dict(whitelist_dbs=["web"], whitelist_tables=["people"]), "web", "clicks", True),  # allow lists widen each other
    (dict(whitelist_dbs=["web"], whitelist_tables=["people"]), "hr", "people", True),
    (dict(blacklist_dbs=["web"]), "web", "clicks", False),
    (dict(blacklist_tables=["web.clicks"]), "hr", "clicks", True),
    (dict(blacklist_tables=["clicks"]), "hr", "clicks", False),
    (dict(whitelist_dbs=["web"], blacklist_dbs=["web"]), "web", "clicks", False),  # deny lists win
    (dict(whitelist_tables=["web.clicks"], blacklist_tables=["clicks"]), "web", "clicks", False),
    (dict(whitelist_dbs=["Web"]), "web", "clicks", False),  # case counts
    (dict(whitelist_tables=["clicks"]), "web", "", False),
    (dict(whitelist_tables=["x.y.z"]), "x", "y.z", True),  # an entry's dot may be anywhere
    (dict(whitelist_tables=["x.y.z"]), "x.y", "z", True),
    (dict(blacklist_dbs=["web"]), None, "clicks", True),
    (dict(whitelist_dbs=["web"]), None, "clicks", False),
    (dict(whitelist_dbs=["\tweb "]), " web", "clicks", True),  # white space around names does not count
    (dict(blacklist_dbs=["web"], clean_names=True), "web", "clicks", False),
]


@pytest.mark.parametrize("lists,schema,table,allowed", FILTERS)
def test_filter(spark, lists, schema, table, allowed):
    df = spark.createDataFrame([(schema, table)], "schema_name string, table_name string")
    flt = TableFilter(**lists)
    assert df.select(flt.allow(F.col("schema_name"), F.col("table_name"))).first()[0] is allowed
    assert flt.rows(df).count() == allowed
    assert flt.rows(df, large=0).count() == allowed


@pytest.mark.parametrize("clean", [False, True])
def test_long_and_short_lists_agree_on_padded_names(spark, clean):
    """Names that are declared clean are compared as they are, by both forms."""
    df = spark.createDataFrame([(" web", "clicks"), ("web", "clicks "), ("web", "clicks")], "schema_name string, table_name string")
    for lists in (dict(whitelist_dbs=["web"]), dict(blacklist_tables=["web.clicks"])):
        flt = TableFilter(**lists, clean_names=clean)
        assert rows(flt.rows(df)) == rows(flt.rows(df, large=0))


QUERY_FILTERS = [
    # a bare table entry does not let the session's schema pass
    (dict(whitelist_tables=["people"]), "hr", "truncate people", False),
    (dict(whitelist_tables=["people"]), "", "truncate people", True),
    # without a schema and without a table nothing is named that a list could stop
    (dict(whitelist_dbs=["hr"]), "", "create view v as select 2", True),
    # a database or a table of another schema has to pass too
    (dict(whitelist_dbs=["hr"]), "", "drop database web", False),
    (dict(whitelist_dbs=["hr"]), "hr", "drop table people, web.clicks", False),
    (dict(whitelist_dbs=["hr"]), "hr", "drop table people, teams", True),
    (dict(blacklist_tables=["hr.teams"]), "hr", "rename table people to teams", False),
    ({}, "hr", "create schema web", True),
]


@pytest.mark.parametrize("lists,schema,text,allowed", QUERY_FILTERS)
def test_query_filter(spark, lists, schema, text, allowed):
    df = ddl.with_ddl(spark.createDataFrame([(schema, text)], "schema_name string, query string"))
    check = TableFilter(**lists).allow_query(
        F.col("schema_name"), F.col("ddl_database"), F.col("ddl_tables")
    )
    assert df.select(check).first()[0] is allowed


def test_clean_names_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.createDataFrame([("shop", "t1"), ("crm", "t2")], "schema_name string, table_name string").write.parquet(path)
    flt = TableFilter(["shop"], blacklist_tables=["shop.t9"], clean_names=True)
    plan = flt.rows(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [", 1)[1].split("]", 1)[0]
    assert "schema_name" in pushed and "table_name" in pushed


def test_gtid_sets(spark):
    log = spark.createDataFrame([("u", i) for i in range(1, 13)] + [(None, None)], "gtid_source string, gtid_seq long")
    for small in (1000, 0):
        kept = ct.after_gtid_set(log, "U:1-3:5:7-9, v:1-99", small=small)
        assert sorted(r.gtid_seq for r in kept.collect() if r.gtid_seq) == [4, 6, 10, 11, 12]
        assert kept.filter("gtid_source is null").count() == 1
    assert ct.after_gtid_set(log, "").count() == 13
    with pytest.raises(ValueError, match="invalid flavor"):
        ct.after_gtid_set(log, "u:1", "oracle")
    total = ct.gtid_set_total(log.filter("gtid_seq not in (4, 6)"), bucket=4)
    assert rows(ct.gtid_set_text(total)) == [("u", "u:1-3:5:7-12")]


def test_ddl_without_effect_and_late_renames(spark):
    texts = {
        "drop temporary table if exists clicks": [],
        "drop table clicks": [("erase", "clicks", None)],
        "alter table clicks add c int, rename to visits": [("rename", "clicks", "visits")],
        "alter table clicks rename as visits": [("rename", "clicks", "visits")],
        "alter table clicks rename column a to b, rename to visits": [("rename", "clicks", "visits")],
        "alter table clicks rename index i to j": [],
        "alter table clicks add rename int": [],
    }
    df = spark.createDataFrame([(1, i, "web", t) for i, t in enumerate(texts)], "file_seq long, pos long, schema_name string, query string")
    got = {}
    for r in ct.ddl_effects(ddl.with_ddl(df)).collect():
        got.setdefault(r.pos, []).append((r.action, r.table_name, r.to_table))
    assert {t: got.get(i, []) for i, t in enumerate(texts)} == texts


def test_image_evolution_in_many_steps(spark):
    steps = [dict(action="rename", column=f"c{k}", to=f"c{k + 1}", at=(1, 10 + k)) for k in range(200)]
    steps += [dict(action="add", column="z", type="int", default=5, at=(1, 400)), dict(action="modify", column="c200", type="int", at=(1, 401))]
    df = spark.createDataFrame([({"c0": "1.5"}, 1, 5), ({"c0": "7"}, 1, 1000)], "image map<string,string>, f long, p long")
    evolved = df.select(ct.evolve_images(F.col("image"), F.struct("f", "p"), steps).alias("m")).collect()
    assert [r.m for r in evolved] == [{"c200": None, "z": "5"}, {"c0": "7"}]
