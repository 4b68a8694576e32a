"""Buckets, upkeep, partial images and DDL in tables kept by a stream."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import changetables as ct
from changetables.streaming import state as st
from changetables.streaming.apply import apply_batch, apply_tables_batch, create, read_state, read_unlisted, target_actions
from helpers import rows
from simulator import CHANGES, IMAGE, PARTIAL, ROW
from test_partial import minimal


def files(spark, target):
    found = spark.read.parquet(f"{target.root}/state").select(F.col("_metadata.file_path")).distinct()
    return {r[0] for r in found.collect()}


def put(spark, target, batch_id, log, schema=CHANGES):
    apply_batch(target_actions(spark.createDataFrame(log, schema), target), batch_id, target)


def test_compaction_rewrites_touched_buckets_only(spark, tmp_path):
    target = ct.Target(str(tmp_path / "t"), ("k",), IMAGE, buckets=8)
    create(target, spark.createDataFrame([(k, "b") for k in range(200)], IMAGE))
    before = files(spark, target)
    put(spark, target, 0, [(1, 5, 0, "update", (7, "b"), (7, "new")), (1, 6, 0, "delete", (9, "b"), None)])
    touched = {r[0] for r in spark.createDataFrame([(7,), (9,)], "k int").select(st.bucket_of(target)).collect()}
    assert ct.compact(spark, target) == 0
    fresh = files(spark, target) - before
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in fresh} == touched
    upto, held = st._last_version(spark, target)
    old = {f.split("version=")[1].split("/")[0] for f in before}
    assert {b for b, v in held.items() if v not in old} == touched and len(held) == 8
    want = sorted([(k, "new" if k == 7 else "b") for k in range(200) if k != 9], key=repr)
    assert rows(ct.read_current(spark, target)) == want
    # nothing fresh: the next record names the same versions
    ct.compact(spark, target)
    assert st._last_version(spark, target)[1] == held
    with pytest.raises(ValueError, match="8 buckets"):
        ct.read_current(spark, ct.Target(target.root, ("k",), IMAGE, buckets=4))


def test_reading_some_keys_reads_their_buckets(spark, tmp_path):
    target = ct.Target(str(tmp_path / "t"), ("k",), IMAGE, buckets=16)
    create(target, spark.createDataFrame([(k, "b") for k in range(400)], IMAGE))
    put(spark, target, 0, [(1, 5, 0, "insert", None, (1000, "n")), (1, 6, 0, "update", (3, "b"), (3, "c"))])
    wanted = spark.createDataFrame([(3,), (1000,), (5555,)], "k int")
    found = ct.read_current(spark, target, wanted)
    assert rows(found) == [(1000, "n"), (3, "c")]
    buckets = {r[0] for r in wanted.select(st.bucket_of(target)).collect()}
    read = {f.split("bucket=")[1].split("/")[0] for f in read_state(spark, target, wanted).inputFiles() if "/state/" in f}
    assert {int(b) for b in read} <= buckets and len(buckets) < 16


def test_clean_deletes_what_no_record_needs(spark, tmp_path):
    target = ct.Target(str(tmp_path / "t"), ("k",), IMAGE, buckets=4)
    assert ct.clean(spark, target) == 0
    create(target, spark.createDataFrame([(k, "b") for k in range(40)], IMAGE))
    spark.createDataFrame([(1, "lost")], IMAGE).write.parquet(f"{target.root}/deltas/attempt=lost")
    for i in range(5):
        put(spark, target, i, [(1, 5 + i, 0, "update", (i, "b"), (i, f"n{i}"))])
        ct.compact(spark, target)
    put(spark, target, 5, [(1, 50, 0, "update", (9, "b"), (9, "fresh"))])
    want = rows(ct.read_current(spark, target))
    assert ct.clean(spark, target) > 5
    assert rows(ct.read_current(spark, target)) == want
    assert len(files(spark, target)) == len(st._last_version(spark, target)[1]) == 4
    assert len(st.list_names(spark, f"{target.root}/deltas")) == 1
    # the folded ledger still knows which batches were applied
    put(spark, target, 3, [(1, 99, 0, "delete", (1, "b"), None)])
    assert rows(ct.read_current(spark, target)) == want
    put(spark, target, 6, [(1, 100, 0, "delete", (9, "fresh"), None)])
    assert ct.compact(spark, target) == 6
    assert rows(ct.read_current(spark, target)) == [r for r in want if r[0] != 9]


@pytest.mark.parametrize("seed", [21, 22])
def test_partial_images_in_any_order(spark, tmp_path, seed):
    base, log, want = minimal(seed, 90, False)
    target = ct.Target(str(tmp_path / "t"), ("k",), ROW, partial=True, defaults={"w": -1}, buckets=4)
    create(target, spark.createDataFrame(base, ROW))
    parts = [log[i::4] for i in range(4)]
    random.Random(seed).shuffle(parts)
    for i, part in enumerate(parts):
        put(spark, target, i, part, PARTIAL)
        if i == 1:
            ct.compact(spark, target)
    assert rows(ct.read_current(spark, target)) == sorted(want, key=repr)
    ct.compact(spark, target, forget_before=(9, 9))
    ct.clean(spark, target)
    assert rows(ct.read_current(spark, target)) == sorted(want, key=repr)


def test_partial_images_that_no_key_decides_raise(spark, tmp_path):
    target = ct.Target(str(tmp_path / "t"), ("k",), ROW, partial=True)
    for change in [
        (1, 5, 0, "update", (1, None, None), (2, None, None), ["k"], ["k"]),
        (1, 5, 0, "delete", (None, "a", None), None, ["v"], None),
    ]:
        with pytest.raises(Exception, match="needs a whole row|lacks the key"):
            put(spark, target, 0, [change], PARTIAL)
    whole = ct.Target(str(tmp_path / "w"), ("k",), ROW)
    with pytest.raises(Exception, match="only some columns"):
        put(spark, whole, 0, [(1, 5, 0, "update", (1, None, None), (None, "x", None), ["k"], ["v"])], PARTIAL)


LOG = (
    "file_seq long, pos long, ordinal int, op string, schema_name string, table_name string, "
    "before map<string,string>, after map<string,string>, query string"
)


def row(pos, op, table, before=None, after=None):
    return (1, pos, 0, op, "s", table, before, after, None)


def statement(pos, query):
    return (1, pos, 0, None, "s", None, None, None, query)


def read(spark, tables, name):
    fields = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])
    return rows(ct.read_current_table(spark, tables, "s", name, fields))


DDL_LOG = [
    row(1, "insert", "a", None, {"k": "1", "v": "one"}),
    row(2, "insert", "a", None, {"k": "2", "v": "two"}),
    row(3, "insert", "b", None, {"k": "1", "v": "b one"}),
    statement(4, "TRUNCATE TABLE b"),
    row(5, "insert", "b", None, {"k": "2", "v": "b two"}),
    statement(6, "RENAME TABLE a TO old"),
    row(7, "insert", "a", None, {"k": "1", "v": "again"}),
    row(8, "update", "old", {"k": "2", "v": "two"}, {"k": "2", "v": "deux"}),
    row(9, "insert", "c", None, {"k": "1", "v": "c"}),
    statement(10, "DROP TABLE c"),
    statement(11, "ALTER TABLE old RENAME TO older"),
    row(12, "delete", "older", {"k": "1", "v": "one"}, None),
]


@pytest.mark.parametrize("cuts", [[12], [6, 3, 3], [1] * 12])
@pytest.mark.parametrize("compacting", [False, True])
def test_statements_act_on_rows_that_are_there(spark, tmp_path, cuts, compacting):
    if compacting and len(cuts) == 12:
        cuts = [4, 4, 4]
    tables = ct.TableSet(str(tmp_path / "t"), {("s", n): ("k",) for n in ("a", "b", "c", "old", "older")}, buckets=2)
    at = 0
    for i, n in enumerate(cuts):
        apply_tables_batch(spark.createDataFrame(DDL_LOG[at : at + n], LOG), i, tables)
        apply_tables_batch(spark.createDataFrame(DDL_LOG[at : at + n], LOG), i, tables)  # a repeated batch
        at += n
        if compacting:
            ct.compact(spark, tables)
            ct.clean(spark, tables)
    assert read(spark, tables, "a") == [(1, "again")]
    assert read(spark, tables, "b") == [(2, "b two")]
    assert read(spark, tables, "c") == read(spark, tables, "old") == []
    assert read(spark, tables, "older") == [(2, "deux")]


def test_truncate_may_come_late_a_rename_may_not(spark, tmp_path):
    tables = ct.TableSet(str(tmp_path / "t"), {("s", "b"): ("k",)}, buckets=2)
    late = [r for r in DDL_LOG if r[1] == 4]
    apply_tables_batch(spark.createDataFrame([r for r in DDL_LOG if r[1] in (3, 5)], LOG), 0, tables)
    assert read(spark, tables, "b") == [(1, "b one"), (2, "b two")]
    apply_tables_batch(spark.createDataFrame(late, LOG), 1, tables)
    assert read(spark, tables, "b") == [(2, "b two")]
    with pytest.raises(ValueError, match="RENAME"):
        apply_tables_batch(spark.createDataFrame([statement(4, "RENAME TABLE b TO d")], LOG), 2, tables)


def test_partial_maps_in_a_set_of_tables(spark, tmp_path):
    tables = ct.TableSet(str(tmp_path / "t"), {("s", "a"): ("k",)}, partial=True, buckets=2)
    log = [
        row(1, "insert", "a", None, {"k": "1", "v": "one"}),
        row(2, "update", "a", {"k": "1"}, {"v": "uno"}),
        row(3, "insert", "a", None, {"k": "2"}),
        row(4, "update", "a", {"k": "2"}, {"v": None}),
        row(5, "update", "a", {"k": "1", "v": "uno"}, {"k": "5", "v": "uno"}),
        row(6, "insert", "other", None, {"k": "2"}),
    ]
    for i, part in enumerate((log[3:], log[:3])):
        apply_tables_batch(spark.createDataFrame(part, LOG), i, tables)
    assert read(spark, tables, "a") == [(2, None), (5, "uno")]
    ct.compact(spark, tables)
    assert read(spark, tables, "a") == [(2, None), (5, "uno")]
    assert read_unlisted(spark, tables, spark.createDataFrame([], LOG).schema).count() == 1
    whole = ct.TableSet(str(tmp_path / "w"), {("s", "a"): ("k",)})
    with pytest.raises(Exception, match="partial set"):
        apply_tables_batch(spark.createDataFrame([row(2, "update", "a", {"k": "1", "v": "x"}, {"v": "uno"})][:1], LOG), 0, whole) or (
            apply_tables_batch(spark.createDataFrame([row(3, "update", "a", {"k": "1", "w": "x"}, {"v": "uno"})], LOG), 1, whole)
        )


COMMITS = "source_id string, event_type string, file_seq long, pos long, ordinal int, op string, before struct<k:int,v:string>, after struct<k:int,v:string>"


@pytest.mark.parametrize("upkeep", [False, True])
def test_readers_see_whole_transactions(spark, tmp_path, upkeep):
    """Two sources, transactions cut anywhere between files, the last one left open."""
    rnd = random.Random(8)
    log, want, states = [], {}, []
    for txn in range(12):
        source = rnd.choice("ab")
        for i in range(rnd.randint(1, 4)):
            log.append((source, "WriteRowsEventV2", 1, len(log), 0, "insert", None, (100 * (source == "a") + i, f"t{txn}")))
        if txn < 11:
            log.append((source, "XIDEvent", 1, len(log), 0, None, None, None))
    target = ct.Target(str(tmp_path / "t"), ("k",), IMAGE, buckets=2)
    folder, at = str(tmp_path / "log"), 0
    while at < len(log):
        n = rnd.randint(3, 9)
        spark.createDataFrame(log[at : at + n], COMMITS).coalesce(1).write.mode("append").parquet(folder)
        stream = ct.read_changelog(spark, folder, streaming=True, schema=spark.createDataFrame([], COMMITS).schema)
        ct.drain(ct.start_apply(stream, target, str(tmp_path / "c"), commits=True))
        at += n
        want, open_rows = {}, {"a": [], "b": []}
        for source, kind, *_, after in log[:at]:
            if kind == "XIDEvent":
                want.update(open_rows[source])
                open_rows[source] = []
            else:
                open_rows[source].append(after)
        assert rows(ct.read_current(spark, target)) == sorted(want.items(), key=repr)
        if upkeep:
            ct.compact(spark, target)
            ct.clean(spark, target)
    assert any(open_rows.values())
