"""Row images that carry only some columns."""

import random

import pytest
from pyspark.sql import functions as F

import changetables as ct
from helpers import rows
from simulator import PARTIAL, ROW, partial_changes, replay_partial_bag

KEY, WHOLE, REST = ("k",), ("k", "v", "w"), ("v", "w")
BASE = [(0, "a", 7), (0, "a", 7), (None, None, 8), (1, None, 7)]


def changes(spark, log, seed=0):
    shuffled = list(log)
    random.Random(seed).shuffle(shuffled)
    return spark.createDataFrame(shuffled, PARTIAL)


def bag(df):
    return sorted((tuple(r[:-1]) for r in df.collect() for _ in range(r["copies"])), key=repr)


@pytest.mark.parametrize(
    "seed,patterns,segment,hot",
    [
        (1, [KEY], 64, 10**6),
        (2, [WHOLE], 300, 5),
        (3, [KEY, WHOLE], 10**6, 5),
        (4, [KEY, REST, WHOLE, ("w",)], 150, 10**6),
        (5, [REST], 100, 0),
    ],
)
def test_replay_equals_sequential_replay(spark, seed, patterns, segment, hot):
    log = partial_changes(seed, 120, patterns)
    want = replay_partial_bag(BASE, log, {"w": 9})
    got = ct.replay(
        changes(spark, log, seed), spark.createDataFrame(BASE, ROW), segment_bytes=segment, hot_rows=hot,
        defaults={"w": F.lit(9)},
    )
    assert bag(got) == want


def test_long_chain_of_open_links(spark):
    """A whole before image after an update that leaves columns alone is looked up again."""
    log = [(1, 4, 0, "insert", None, (0, "a", 1), None, list(WHOLE))]
    for i in range(12):
        if i % 2:
            log.append((1, 10 + i, 0, "update", (0, "a", i), (None, None, i + 1), list(WHOLE), ["w"]))
        else:
            log.append((1, 10 + i, 0, "update", (0, None, None), (None, None, i + 1), ["k"], ["w"]))
    assert bag(ct.replay(changes(spark, log))) == replay_partial_bag([], log, {}) == [(0, "a", 12)]


def test_null_differs_from_absent(spark):
    log = [
        (1, 4, 0, "insert", None, (0, "a", 1), None, list(WHOLE)),
        (1, 5, 0, "update", (0, None, None), (None, None, None), ["k"], ["v"]),
        (1, 6, 0, "delete", (None, None, None), None, ["k"], None),
    ]
    assert bag(ct.replay(changes(spark, log))) == [(0, None, 1)]


def test_missing_lists_stand_for_all_columns(spark):
    log = [
        (1, 4, 0, "insert", None, (0, "a", 1), None, None),
        (1, 5, 0, "update", (0, "a", 1), (0, "b", 1), None, None),
        (1, 6, 0, "delete", (0, "a", None), None, ["k", "v"], None),
    ]
    assert bag(ct.replay(changes(spark, log))) == [(0, "b", 1)]
    with pytest.raises(ValueError):
        ct.replay(changes(spark, log), match="one")


def test_an_image_without_columns_raises(spark):
    log = [(1, 5, 0, "delete", (None, None, None), None, [], None)]
    with pytest.raises(Exception, match="carries no column"):
        ct.replay(changes(spark, log)).collect()


def test_no_changes_and_no_base(spark):
    assert bag(ct.replay(changes(spark, []))) == []
    log = [(1, 4, 0, "insert", None, (0, None, None), None, ["k"])]
    assert bag(ct.replay(changes(spark, log), defaults={"v": F.lit("d")})) == [(0, "d", None)]


def minimal(seed, n, moves):
    """A consistent keyed log: before images carry the key, after images what changed."""
    rnd, table, log = random.Random(seed), {}, []
    base = {k: (k, "b", k) for k in range(0, 10, 2)}
    table.update({k: list(v) for k, v in base.items()})
    for i in range(n):
        free = [k for k in range(10) if k not in table]
        op, at = rnd.choice(["insert", "update", "update", "update", "delete"]), (1, 4 + i, 0)
        if op == "insert" and free:
            k = rnd.choice(free)
            present = rnd.choice([["k"], ["k", "v"], ["k", "v", "w"]])
            row = [k, f"v{i}" if "v" in present else None, i if "w" in present else None]
            table[k] = [k, row[1], i if "w" in present else -1]
            log.append((*at, op, None, tuple(row), None, present))
        elif op == "update" and table:
            k = rnd.choice(sorted(table))
            new, row = {}, table.pop(k)
            if free and moves and rnd.random() < 0.3:
                new["k"] = rnd.choice(free)
            new[rnd.choice(["v", "w"])] = None if rnd.random() < 0.3 else i if "w" in new else None
            if "v" in new and rnd.random() < 0.7:
                new["v"] = f"v{i}"
            row = [new.get(c, x) for c, x in zip("kvw", row)]
            table[row[0]] = row
            log.append((*at, op, (k, None, None), tuple(new.get(c) for c in "kvw"), ["k"], sorted(new)))
        elif op == "delete" and table:
            k = rnd.choice(sorted(table))
            del table[k]
            log.append((*at, op, (k, None, None), None, ["k"], None))
    return list(base.values()), log, sorted(tuple(r) for r in table.values())


@pytest.mark.parametrize("seed,moves", [(1, False), (2, True), (3, True)])
def test_latest_by_key(spark, seed, moves):
    base, log, want = minimal(seed, 80, moves)
    got = ct.latest_by_key(changes(spark, log), ["k"], spark.createDataFrame(base, ROW), {"w": F.lit(-1)})
    assert rows(got) == sorted(want, key=repr)


def test_update_without_its_key(spark):
    log = [
        (1, 4, 0, "insert", None, (1, "a", 1), None, list(WHOLE)),
        (1, 5, 0, "update", (1, "a", 1), (None, "b", None), list(WHOLE), ["v"]),
    ]
    df = changes(spark, log)
    assert rows(ct.latest_by_key(df, ["k"])) == [(1, "b", 1)]
    keys = ct.split_key_updates(df, ["k"], rows=False)
    assert rows(keys.select("k", "sub")) == [(1, 1), (1, 1)]
    with pytest.raises(Exception, match="only some columns"):
        ct.history(df, ["k"]).collect()
    assert rows(ct.conflicts(df, ["k"])) == []
    rows_after, found = ct.apply_to_table(df, spark.createDataFrame([(1, "x", 0)], ROW), ["k"], on_conflict="report")
    assert rows(rows_after) == [(1, "b", 1)]
    assert [(r["k"], r["pos"]) for r in found.collect()] == [(1, 4)]
