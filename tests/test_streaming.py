import random

import pytest
from pyspark.sql import types as T

import changetables as ct
from changetables.operators.keyed import latest_actions
from changetables.streaming.apply import apply_batch, create, merge_state, read_state, read_unlisted
from helpers import rows
from simulator import CHANGES, IMAGE, keyed_changes


def _files(spark, log, folder, parts, seed):
    """The log cut into files that arrive in any order."""
    rnd = random.Random(seed)
    for i in rnd.sample(range(parts), parts):
        spark.createDataFrame(log[i::parts], CHANGES).coalesce(1).write.mode("append").parquet(folder)


def _run(spark, folder, target, checkpoint, engine):
    stream = ct.read_changelog(spark, folder, streaming=True, schema=CHANGES, max_files=2)
    ct.drain(ct.start_apply(stream, target, checkpoint, engine=engine))


@pytest.mark.parametrize("engine", ["deltas", "state"])
def test_stream_equals_batch_across_restarts(spark, tmp_path, engine):
    base, log, want = keyed_changes(71, 150)
    target = ct.Target(str(tmp_path / "t"), ("k",), IMAGE)
    create(target, spark.createDataFrame(base, IMAGE))
    folder, checkpoint = str(tmp_path / "log"), str(tmp_path / "c")
    _files(spark, log[::2], folder, 3, 1)
    _run(spark, folder, target, checkpoint, engine)
    _files(spark, log[1::2], folder, 3, 2)
    _run(spark, folder, target, checkpoint, engine)
    assert rows(ct.read_current(spark, target)) == sorted(want, key=repr)
    _run(spark, folder, target, checkpoint, engine)
    assert rows(ct.read_current(spark, target)) == sorted(want, key=repr)


def test_a_batch_run_twice_counts_once_and_unrecorded_batches_are_unseen(spark, tmp_path):
    base, log, want = keyed_changes(72, 80)
    target = ct.Target(str(tmp_path / "t"), ("k",), IMAGE)
    create(target, spark.createDataFrame(base, IMAGE))
    actions = latest_actions(spark.createDataFrame(log, CHANGES), ["k"])
    # a crash after writing and before recording
    actions.limit(2).write.parquet(f"{target.root}/deltas/attempt=crashed")
    assert rows(ct.read_current(spark, target)) == sorted(base, key=repr)
    apply_batch(actions, 0, target)
    seen = ct.read_current(spark, target)
    apply_batch(actions.limit(1), 0, target)  # recorded, so what readers see is not touched
    assert rows(seen) == rows(ct.read_current(spark, target)) == sorted(want, key=repr)


@pytest.mark.parametrize("compacted", [False, True])
def test_a_new_checkpoint_folder_goes_on(spark, tmp_path, compacted):
    target = ct.Target(str(tmp_path / "t"), ("k",), IMAGE)
    for k in (1, 2):
        folder = str(tmp_path / f"log{k}")
        spark.createDataFrame([(1, k, 0, "insert", None, (k, "x"))], CHANGES).write.parquet(folder)
        _run(spark, folder, target, str(tmp_path / f"c{k}"), "deltas")
        if compacted:
            ct.compact(spark, target)
    assert rows(ct.read_current(spark, target)) == [(1, "x"), (2, "x")]


def test_late_older_change_does_not_revive_a_removed_row(spark, tmp_path):
    target = ct.Target(str(tmp_path / "t"), ("k",), IMAGE)
    late = [(1, 5, 0, "insert", None, (1, "old"))]
    early = [(1, 9, 0, "delete", (1, "old"), None), (1, 12, 0, "insert", None, (2, "x"))]
    for batch_id, log in enumerate((early, late)):
        apply_batch(latest_actions(spark.createDataFrame(log, CHANGES), ["k"]), batch_id, target)
        ct.compact(spark, target)
    assert rows(ct.read_current(spark, target)) == [(2, "x")]
    assert read_state(spark, target).count() == 2
    apply_batch(latest_actions(spark.createDataFrame([], CHANGES), ["k"]), 2, target)
    assert ct.compact(spark, target, forget_before=(1, 10)) == 2
    assert read_state(spark, target).count() == 1


def test_unknown_engine(spark):
    with pytest.raises(ValueError, match="engine"):
        ct.start_apply(None, ct.Target("x", ("k",), IMAGE), "c", engine="other")


def test_many_tables_in_one_log(spark, tmp_path):
    columns = "file_seq long, pos long, ordinal int, op string, schema_name string, table_name string, before map<string,string>, after map<string,string>"
    fields = {"a": IMAGE, "b": T.StructType([T.StructField("x", T.LongType()), T.StructField("y", T.LongType())])}
    log = [
        (1, 1, 0, "insert", "s", "a", None, {"k": "1", "v": "one"}),
        (1, 2, 0, "insert", "s", "b", None, {"x": "1", "y": "2"}),
        (1, 3, 0, "insert", "s", "other", None, {"z": "1"}),
        (1, 4, 0, "update", "s", "a", {"k": "1", "v": "one"}, {"k": "2", "v": "two"}),
        (1, 5, 0, "insert", "s", "b", None, {"x": "1", "y": "3"}),
        (1, 6, 0, "delete", "s", "b", {"x": "1", "y": "2"}, None),
        (1, 7, 0, "insert", "s", "a", None, {"k": "3", "v": None}),
    ]
    folder = str(tmp_path / "log")
    for part in (log[4:], log[:4]):
        spark.createDataFrame(part, columns).coalesce(1).write.mode("append").json(folder)
    stream = ct.read_changelog(
        spark, folder, streaming=True, file_format="json", max_files=1, schema=spark.createDataFrame([], columns).schema
    )
    tables = ct.TableSet(str(tmp_path / "t"), {("s", "a"): ("k",), ("s", "b"): ("x", "y")})
    ct.drain(ct.start_apply_tables(stream, tables, str(tmp_path / "c")))
    read = lambda t: rows(ct.read_current_table(spark, tables, "s", t, fields[t]))
    want = {"a": [(2, "two"), (3, None)], "b": [(1, 3)]}
    assert {t: read(t) for t in want} == want
    others = read_unlisted(spark, tables, spark.createDataFrame([], columns).schema)
    assert [(r.table_name, r.after) for r in others.collect()] == [("other", {"z": "1"})]
    ct.compact(spark, tables)
    assert {t: read(t) for t in want} == want


@pytest.mark.parametrize("small", [0, 1000])
def test_the_later_position_wins_on_either_side(spark, small):
    state = "k int, row struct<v:string>, at struct<at:struct<file_seq:bigint,pos:bigint,ordinal:int>,sub:int>"
    at = lambda pos: ((1, pos, 0), 1)
    old = [(1, ("a",), at(5)), (2, ("b",), at(5)), (3, None, at(9)), (4, ("d",), at(1))]
    new = [(2, ("B",), at(6)), (3, ("C",), at(8)), (4, None, at(2)), (5, ("e",), at(1))]
    got = merge_state(spark.createDataFrame(old, state), spark.createDataFrame(new, state), ["k"], small)
    assert rows(got.select("k", "row.v", "at.at.pos")) == [
        (1, "a", 5), (2, "B", 6), (3, None, 9), (4, None, 2), (5, "e", 1)
    ]


def test_versions_of_a_table(spark, tmp_path):
    root = str(tmp_path)
    base, log, want = keyed_changes(73, 60)
    assert ct.write_table(spark.createDataFrame(base, IMAGE), root, "t") == 1
    df = spark.createDataFrame(log, CHANGES)
    for mode, keys in (("latest", ["k"]), ("exact", None), ("one", None)):
        applied = ct.apply_to_table(df, spark.createDataFrame(base, IMAGE), keys, mode)
        assert rows(applied) == sorted(want, key=repr)
    # a plan may read the version it replaces
    table = ct.read_table(spark, root, "t")
    assert ct.write_table(ct.apply_to_table(df, table, ["k"], on_conflict="halt"), root, "t") == 2
    assert rows(ct.read_table(spark, root, "t")) == sorted(want, key=repr)
    # a version that was written but never recorded stays unseen
    spark.createDataFrame([(0, "x")], IMAGE).write.parquet(f"{root}/t/v=3")
    assert rows(ct.read_table(spark, root, "t")) == sorted(want, key=repr)
    with pytest.raises(ValueError, match="keys"):
        ct.apply_to_table(df, table, None, "latest")
