import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import changetables as ct
from changetables.operators.exact import net_copies
from changetables.operators.keyed import key_actions_with_liveness
from helpers import rows
from simulator import CHANGES, IMAGE, bag_changes, keyed_changes, replay_bag


def changes(spark, log, seed=0):
    shuffled = list(log)
    random.Random(seed).shuffle(shuffled)
    return spark.createDataFrame(shuffled, CHANGES)


def bag(df):
    return sorted((tuple(r[:-1]) for r in df.collect() for _ in range(r["copies"])), key=repr)


@pytest.mark.parametrize("seed,segment,hot", [(1, 64, 0), (2, 300, 5), (3, 10**6, 5), (4, 150, 10**6)])
def test_exact_replay_equals_sequential_replay(spark, seed, segment, hot):
    log = bag_changes(seed, 160)
    base = [(1, "hot")] * 3 + [(None, None), (2, "a"), (9, "never")]
    want, unmatched = replay_bag(base, log)
    base_df = spark.createDataFrame(base, IMAGE)
    df = changes(spark, log, seed)
    got = ct.replay(df, base_df, segment_bytes=segment, hot_rows=hot)
    assert bag(got) == want
    missed = ct.unmatched_changes(df, base_df, segment_bytes=segment, hot_rows=hot)
    assert rows(missed.select("file_seq", "pos", "ordinal")) == sorted(unmatched, key=repr)


def test_no_op_update_does_not_consume_itself(spark):
    log = [
        (1, 4, 0, "insert", None, (1, "a")),
        (1, 5, 0, "update", (1, "a"), (1, "a")),
        (1, 6, 0, "update", (1, "a"), (1, "b")),
    ]
    assert bag(ct.replay(changes(spark, log))) == [(1, "b")]


def test_one_delete_removes_every_equal_row(spark):
    log = [(1, 4 + i, 0, "insert", None, (1, "a")) for i in range(5)]
    log.append((1, 99, 0, "delete", (1, "a"), None))
    df = changes(spark, log)
    assert bag(ct.replay(df)) == []
    assert bag(ct.replay(df, match="one")) == [(1, "a")] * 4


@pytest.mark.parametrize("seed", [11, 12])
def test_append_delete_is_the_special_case(spark, seed):
    log = [c for c in bag_changes(seed, 150) if c[3] != "update"]
    df = changes(spark, log)
    assert bag(ct.replay_append_delete(df, segment_bytes=200, hot_rows=5)) == replay_bag([], log)[0]


def test_expand_copies_keeps_counts(spark):
    df = spark.createDataFrame([(1, 7), (None, 1), (2, 10), (3, 0)], "k int, copies long")
    got = Counter(r.k for r in ct.expand_copies(df, chunk=3).collect())
    assert got == {1: 7, None: 1, 2: 10}


def test_negative_net_copies_show_drift(spark):
    df = changes(spark, [(1, 4, 0, "delete", (1, "a"), None)])
    assert rows(net_copies(df)) == [(1, "a", -1)]


@pytest.mark.parametrize("seed", [21, 22, 23])
def test_keyed_replay_on_consistent_logs(spark, seed):
    base, log, want = keyed_changes(seed, 200)
    base_df, df = spark.createDataFrame(base, IMAGE), changes(spark, log, seed)
    assert rows(ct.latest_by_key(df, ["k"], base_df)) == sorted(want, key=repr)
    assert bag(ct.replay(df, base_df, segment_bytes=500, hot_rows=5)) == sorted(want, key=repr)
    assert ct.conflicts(df, ["k"], base_df, segment_bytes=300, hot_rows=5).isEmpty()


def _first_conflict(base, log):
    live = {k for k, _ in base}
    found = []
    for *at, op, before, after in log:
        if op == "delete":
            live.discard(before[0])
        elif op == "update" and before[0] != after[0]:
            if before[0] not in live:
                continue  # no row to move
            live.discard(before[0])
            if after[0] in live:
                found.append(tuple(at))
            live.add(after[0])
        elif op == "insert":
            if after[0] in live:
                found.append(tuple(at))
            live.add(after[0])
    return found


@pytest.mark.parametrize("seed", [31, 32])
def test_conflicts_and_halt(spark, seed):
    log = bag_changes(seed, 120, hot=0.1, domain=30)
    log = [c for c in log if all(i is None or i[0] is not None for i in c[4:])]
    base = [(1, "x"), (5, "y")]
    want = _first_conflict(base, log)
    base_df, df = spark.createDataFrame(base, IMAGE), changes(spark, log, seed)
    found = ct.conflicts(df, ["k"], base_df, segment_bytes=250, hot_rows=5)
    assert rows(found.select("file_seq", "pos", "ordinal")) == sorted(want, key=repr)
    kept = ct.halt_at_first_conflict(df, ["k"], base_df, segment_bytes=250, hot_rows=5)
    assert kept.count() == sum(tuple(c[:3]) < min(want) for c in log)


def test_a_move_without_a_row_creates_nothing(spark):
    """Also when that hangs on other moves, in a chain."""
    log = [(1, 1, 0, "update", (5, "a"), (6, "a"))]
    log += [(1, k, 0, "update", (k + 4, "a"), (k + 5, "a")) for k in range(2, 7)]
    log += [(1, 7 + k, 0, "insert", None, (k, "b")) for k in range(6, 12)] + [(1, 99, 0, "insert", None, (11, "c"))]
    df = changes(spark, log)
    assert rows(ct.conflicts(df, ["k"]).select("pos")) == [(99,)]
    assert ct.halt_at_first_conflict(df, ["k"]).count() == len(log) - 1


@pytest.mark.parametrize("first", ["insert", "delete"])
def test_a_chain_of_a_thousand_moves(spark, monkeypatch, first):
    """Settled in a logarithmic number of rounds, whether its row exists or not."""
    from changetables.plans import chase

    rounds = []
    monkeypatch.setattr(chase, "materialise", lambda df, label, f=chase.materialise: (rounds.append(label), f(df, label))[1])
    row = (0, "a")
    log = [(1, 1, 0, first, None if first == "insert" else row, row if first == "insert" else None)]
    log += [(1, k + 2, 0, "update", (k, "a"), (k + 1, "a")) for k in range(1000)]
    log += [(1, 2000, 0, "insert", None, (1000, "b")), (1, 2001, 0, "insert", None, (500, "b"))]
    found = ct.conflicts(changes(spark, log), ["k"])
    assert rows(found.select("pos")) == ([(2000,)] if first == "insert" else [])
    assert rounds.count("jump") <= 12


def test_no_conflict_keeps_the_whole_log(spark):
    base, log, _ = keyed_changes(41, 60)
    df = changes(spark, log)
    assert ct.halt_at_first_conflict(df, ["k"], spark.createDataFrame(base, IMAGE)).count() == len(log)


def test_liveness_sees_deletes(spark):
    log = [
        (1, 1, 0, "insert", None, (1, "a")),
        (1, 2, 0, "delete", (1, "a"), None),
        (1, 3, 0, "insert", None, (1, "b")),
    ]
    got = key_actions_with_liveness(changes(spark, log), ["k"], segment_bytes=1, hot_rows=5)
    assert rows(got.select("at.pos", "was_live")) == [(1, False), (2, True), (3, False)]


PARTIAL = (
    "file_seq long, pos long, ordinal int, op string, before struct<k:int,a:string,b:string>, "
    "after struct<k:int,a:string,b:string>, after_present array<string>"
)


@pytest.mark.parametrize("seed", [51, 52])
def test_partial_images(spark, seed):
    rnd = random.Random(seed)
    table = {k: [f"a{k}", None if k % 2 else f"b{k}"] for k in range(6)}
    base = [(k, *v) for k, v in table.items()]
    log = []
    for i in range(120):
        k, op = rnd.randint(0, 9), rnd.choice(["insert", "update", "update", "update", "delete", "move"])
        if op == "insert" and k not in table:
            given = rnd.random() < 0.5
            table[k] = [f"i{i}", f"j{i}" if given else "dflt"]
            present = ["k", "a"] + (["b"] if given else [])
            log.append((1, i, 0, "insert", None, (k, f"i{i}", f"j{i}" if given else None), present))
        elif op == "update":
            present = rnd.choice([["a"], ["b"], ["a", "b"]])
            new = [rnd.choice([None, f"u{i}"]) if c in present else None for c in "ab"]
            log.append((1, i, 0, "update", (k, None, None), (k, *new), present))
            if k in table:
                table[k] = [n if c in present else o for c, n, o in zip("ab", new, table[k])]
        elif op == "delete":
            log.append((1, i, 0, "delete", (k, None, None), None, None))
            table.pop(k, None)
        elif op == "move" and k in table and 20 + i not in table:
            table.pop(k)
            table[20 + i] = [f"m{i}", None]
            log.append((1, i, 0, "update", (k, None, None), (20 + i, f"m{i}", None), ["k", "a", "b"]))
    rnd.shuffle(log)
    got = ct.fold_partial(
        spark.createDataFrame(log, PARTIAL),
        spark.createDataFrame(base, "k int, a string, b string"),
        ["k"],
        {"b": F.lit("dflt")},
    )
    assert rows(got) == sorted(((k, *v) for k, v in table.items()), key=repr)


def test_partial_key_move_is_refused(spark):
    log = [(1, 1, 0, "update", (1, None, None), (2, "x", None), ["k", "a"])]
    base = spark.createDataFrame([(1, "a", "b")], "k int, a string, b string")
    with pytest.raises(Exception, match="needs a whole row"):
        ct.fold_partial(spark.createDataFrame(log, PARTIAL), base, ["k"]).collect()


def test_history_versions_do_not_overlap(spark):
    base, log, want = keyed_changes(61, 150, moves=0.3)
    df = changes(spark, log)
    versions = ct.history(df, ["k"], segment_bytes=200, hot_rows=5)
    current = versions.filter("valid_to is null").select("k", "v")
    touched = {c[4][0] for c in log if c[4]} | {c[5][0] for c in log if c[5]}
    assert rows(current) == sorted(((k, v) for k, v in want if k in touched), key=repr)
    assert versions.filter("valid_to < valid_from").isEmpty()


def test_one_hot_key_holding_most_of_the_log(spark):
    n = 20_000
    log = spark.range(n).selectExpr(
        "cast(floor(id / 1000) + 1 as bigint) as file_seq",
        "cast(id % 1000 * 100 as bigint) as pos",
        "0 as ordinal",
        "case when id = 0 then 'insert' else 'update' end as op",
        "case when id > 0 then named_struct('k', 1, 'v', cast(id - 1 as string)) end as before",
        "named_struct('k', 1, 'v', cast(id as string)) as after",
    )
    assert bag(ct.replay(log, segment_bytes=20_000, hot_rows=1_000)) == [(1, str(n - 1))]
    assert rows(ct.latest_by_key(log, ["k"])) == [(1, str(n - 1))]
    assert ct.history(log, ["k"], segment_bytes=20_000, hot_rows=1_000).filter("valid_to is null").count() == 1
