"""Whole replications of small workloads, from captured events to tables."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import changetables as ct
from changetables.functions.ddl import with_ddl
from helpers import rows

ID = T.StructField("id", T.DecimalType(20, 0))
CREWS = T.StructType([ID, T.StructField("name", T.StringType()), T.StructField("place", T.StringType())])
TALLIES = T.StructType([ID, T.StructField("note", T.StringType())])
EVENT = (
    "file_seq long, pos long, kind string, op string, schema_name string, table_name string, query string, "
    "column_count int, columns array<string>, rows array<array<string>>, skipped array<array<int>>, json_diffs array<array<int>>"
)


class Source:
    """Writes down events the way a capture tool lands them."""

    def __init__(self):
        self.events = []

    def rows(self, schema, table, op, columns, *data):
        self.events.append(
            (1, 4 + 100 * len(self.events), "rows", op, schema, table, None, len(columns), list(columns), [list(r) for r in data], [], [])
        )

    def query(self, schema, text):
        self.events.append((1, 4 + 100 * len(self.events), "query", None, schema, None, text, 0, None, None, [], []))

    def log(self, spark):
        return spark.createDataFrame(self.events, EVENT)


def changes(spark, source, table, fields, flt=None):
    log = source.log(spark).filter("kind = 'rows'")
    kept = (flt or ct.TableFilter()).rows(log)
    ok, bad = ct.split_valid(ct.validate(kept))
    assert bad.isEmpty()
    return ct.typed_changes(ct.decode_rows(ok).filter(F.col("table_name") == table), fields)


COLUMNS = ("id", "name", "place")


def test_basic_changes_and_values(spark):
    s = Source()
    s.rows("yard", "crews", "insert", COLUMNS, ("3", "west", "pier 2"))
    s.rows("yard", "crews", "update", COLUMNS, ("1", "north", "pier 4"), ("1", "north", "pier 5"))
    s.rows("yard", "crews", "delete", COLUMNS, ("2", "south", "pier 9"))
    base = spark.createDataFrame([(Decimal(1), "north", "pier 4"), (Decimal(2), "south", "pier 9")], CREWS)
    df = changes(spark, s, "crews", CREWS)
    want = [(Decimal(1), "north", "pier 5"), (Decimal(3), "west", "pier 2")]
    assert rows(ct.latest_by_key(df, ["id"], base)) == want
    assert rows(ct.replay(df, base).drop("copies")) == want


def test_thousand_rows_in_one_event(spark):
    s = Source()
    s.rows("yard", "tallies", "insert", ("id", "note"), *[(str(i), f"load {i}") for i in range(1, 1001)])
    df = changes(spark, s, "tallies", TALLIES)
    assert ct.latest_by_key(df, ["id"]).count() == 1000
    assert df.select("ordinal").distinct().count() == 1000


def _filter_workload():
    s = Source()
    for table in ("open_ledger", "shut_ledger"):
        s.rows("dock", table, "insert", ("id", "note"), ("1", "x"), ("2", "y"))
    return s


@pytest.mark.parametrize(
    "lists,allowed,denied",
    [
        (dict(whitelist_dbs=["dock"], whitelist_tables=["open_ledger"]), 2, 2),  # the lists widen each other
        (dict(whitelist_tables=["open_ledger"]), 2, 0),
        (dict(whitelist_dbs=["dock"], blacklist_tables=["shut_ledger"]), 2, 0),
        (dict(whitelist_dbs=["dock"], blacklist_dbs=["dock"]), 0, 0),
        ({}, 2, 2),
    ],
)
def test_filters(spark, lists, allowed, denied):
    flt = ct.TableFilter(**lists)
    for table, n in (("open_ledger", allowed), ("shut_ledger", denied)):
        assert changes(spark, _filter_workload(), table, TALLIES, flt).count() == n


def _epochs(spark, s):
    log = s.log(spark)
    effects = ct.ddl_effects(with_ddl(log.filter("kind = 'query'")))
    return ct.apply_ddl_epochs(ct.decode_rows(log.filter("kind = 'rows'")), effects)


def test_ddl_create_alter_drop_leaves_nothing(spark):
    s = Source()
    s.query("yard", "CREATE TABLE berths (id int, note varchar(10))")
    s.rows("yard", "berths", "insert", ("id", "note"), ("1", "x"))
    s.query("yard", "ALTER TABLE berths ADD COLUMN extra int")
    s.rows("yard", "berths", "insert", ("id", "note", "extra"), ("2", "y", "1"))
    s.query("yard", "DROP TABLE berths")
    s.rows("yard", "other", "insert", ("id", "note"), ("1", "kept"))
    assert [r.final_table for r in _epochs(spark, s).collect()] == ["other"]


def test_truncate_rename_and_drop_database(spark):
    s = Source()
    insert = lambda schema, table, i: s.rows(schema, table, "insert", ("id", "note"), (str(i), "x"))
    insert("yard", "a", 1)
    s.query("yard", "TRUNCATE a")
    insert("yard", "a", 2)
    s.query("yard", "RENAME TABLE a TO tmp, b TO a, tmp TO b")
    insert("yard", "a", 3)
    insert("yard", "b", 4)
    insert("pier", "c", 5)
    s.query("", "RENAME TABLE pier.c TO yard.c")
    insert("pier", "d", 6)
    s.query("", "DROP DATABASE pier")
    s.query("yard", "ALTER TABLE c RENAME TO e")
    got = _epochs(spark, s).select(F.col("after")["id"].alias("i"), "final_schema", "final_table")
    assert rows(got) == [("2", "yard", "b"), ("3", "yard", "a"), ("4", "yard", "b"), ("5", "yard", "e")]


def test_many_renames_resolve_by_doubling(spark):
    s = Source()
    s.rows("yard", "t0", "insert", ("id", "note"), ("1", "x"))
    for i in range(40):
        s.query("yard", f"RENAME TABLE t{i} TO t{i + 1}")
    assert [r.final_table for r in _epochs(spark, s).collect()] == ["t40"]


def test_filtered_ddl_never_reaches_the_destination(spark):
    s = Source()
    s.query("dock", "CREATE TABLE tolls (id int)")
    s.query("dock", "ALTER TABLE tolls ADD COLUMN extra int")
    s.query("dock", "DROP TABLE tolls")
    ddl = with_ddl(s.log(spark))
    flt = ct.TableFilter(blacklist_dbs=["dock"])
    assert ddl.filter(flt.allow_query(F.col("schema_name"), F.col("ddl_database"), F.col("ddl_tables"))).isEmpty()


def test_reserved_names(spark):
    s = Source()
    s.rows("mole", "order", "insert", ("id", "note"), ("1", "select"))
    s.rows("mole", "user-log", "insert", ("id", "note"), ("2", "from"))
    for table, want in (("order", (Decimal(1), "select")), ("user-log", (Decimal(2), "from"))):
        assert rows(ct.latest_by_key(changes(spark, s, table, TALLIES), ["id"])) == [want]


def test_write_after_schema_change(spark):
    s = Source()
    s.rows("yard", "crews", "insert", COLUMNS, ("1", "north", "pier 4"))
    s.query("yard", "ALTER TABLE crews ADD COLUMN berth varchar(64)")
    s.rows("yard", "crews", "insert", (*COLUMNS, "berth"), ("4", "east", "pier 7", "B12"))
    steps = [{"at": (1, 104), "action": "add", "column": "berth", "type": "string"}]
    log = ct.decode_rows(s.log(spark).filter("kind = 'rows'"))
    evolved = log.withColumn("after", ct.evolve_images(F.col("after"), F.struct("file_seq", "pos"), steps))
    fields = T.StructType([*CREWS.fields, T.StructField("berth", T.StringType())])
    got = ct.latest_by_key(ct.typed_changes(evolved, fields), ["id"])
    assert rows(got) == [(Decimal(1), "north", "pier 4", None), (Decimal(4), "east", "pier 7", "B12")]


def test_cross_database_ddl_is_seen_with_its_own_schema(spark):
    s = Source()
    s.query("yard", "CREATE DATABASE quay")
    s.query("yard", "CREATE TABLE quay.cranes (id int, note varchar(10))")
    s.rows("quay", "cranes", "insert", ("id", "note"), ("1", "x"))
    targets = with_ddl(s.log(spark)).selectExpr("explode(targets) as t").select("t.*")
    assert rows(targets) == [("quay", "cranes")]
    assert changes(spark, s, "cranes", TALLIES, ct.TableFilter(["quay"])).count() == 1


def test_transactions_do_not_change_the_result(spark):
    s = Source()
    s.query("yard", "BEGIN")
    s.rows("yard", "tallies", "insert", ("id", "note"), ("1", "a"))
    s.rows("yard", "tallies", "update", ("id", "note"), ("1", "a"), ("1", "b"))
    s.query("yard", "COMMIT")
    s.query("yard", " begin ")
    s.rows("yard", "tallies", "insert", ("id", "note"), ("2", "c"))
    s.query("yard", "commit")
    assert rows(ct.latest_by_key(changes(spark, s, "tallies", TALLIES), ["id"])) == [(Decimal(1), "b"), (Decimal(2), "c")]
    log = s.log(spark).withColumn("source_id", F.lit("s"))
    got = ct.with_txn_id(log, segment_bytes=150).orderBy("pos")
    assert [r.txn_id for r in got.collect()] == [1, 1, 1, 1, 2, 2, 2]


def test_replay_after_a_crash_is_idempotent(spark, tmp_path):
    from changetables.operators.keyed import latest_actions
    from changetables.streaming.apply import apply_batch

    s = Source()
    s.rows("yard", "tallies", "insert", ("id", "note"), ("1", "a"), ("2", "b"))
    s.rows("yard", "tallies", "delete", ("id", "note"), ("1", "a"))
    df = changes(spark, s, "tallies", TALLIES)
    target = ct.Target(str(tmp_path / "t"), ("id",), TALLIES)
    for batch_id in (0, 1):
        apply_batch(latest_actions(df, ["id"]), batch_id, target)
    assert rows(ct.read_current(spark, target)) == [(Decimal(2), "b")]
    assert ct.duplicates(ct.read_current(spark, target), ["id"]).isEmpty()
