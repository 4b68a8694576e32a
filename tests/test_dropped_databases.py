"""Databases that are dropped between changes, truncations and renames."""

import random

import pytest

import changetables as ct
from changetables.operators import ddl_effects
from changetables.plans import asof

CHANGES = "schema_name string, table_name string, file_seq long, pos long, ordinal int, n int"
EFFECTS = "file_seq long, pos long, ordinal int, action string, schema_name string, table_name string, to_schema string, to_table string"


def _log(seed, n):
    rnd = random.Random(seed)
    name = lambda: (rnd.choice(["a", "b", None]), rnd.choice(["t", "u", "v", None]))
    changes, effects = [], []
    for pos in range(n):
        kind = rnd.random()
        if kind < 0.6:
            changes.append((*name(), 1 + pos // 40, pos, 0, pos))
        elif kind < 0.75:
            effects.append((1 + pos // 40, pos, 0, "erase_database", name()[0], None, None, None))
        elif kind < 0.85:
            effects.append((1 + pos // 40, pos, 0, "erase", *name(), None, None))
        else:
            effects.append((1 + pos // 40, pos, 0, "rename", rnd.choice("ab"), rnd.choice("tuv"), rnd.choice("ab"), rnd.choice("tuv")))
    return changes, effects


def _brute(changes, effects):
    kept = []
    for s, t, _, pos, _, n in changes:
        for _, at, _, action, es, et, to_s, to_t in effects:
            if at <= pos:
                continue
            if action == "erase_database" and s is not None and es == s or action == "erase" and (es, et) == (s, t):
                break
            if action == "rename" and (es, et) == (s, t):
                s, t = to_s, to_t
        else:
            kept.append((n, s, t))
    return sorted(kept)


@pytest.mark.parametrize("small", [0, 1_000])
def test_drops_between_other_steps(spark, small):
    for seed in range(2):
        changes, effects = _log(seed, 120)
        kept = ct.apply_ddl_epochs(
            spark.createDataFrame(changes, CHANGES), spark.createDataFrame(effects, EFFECTS), 1_000, small
        )
        assert sorted(tuple(r) for r in kept.select("n", "final_schema", "final_table").collect()) == _brute(changes, effects)


def test_a_drop_stays_one_row_however_many_tables_it_erases(spark, monkeypatch):
    sizes = []

    def counted(left, right, *rest):
        sizes.append(right.count())
        return asof.asof_lookup(left, right, *rest)

    monkeypatch.setattr(ddl_effects, "asof_lookup", counted)
    changes = [("a", f"t{i}", 1, 100 * i, 0, i) for i in range(50)]
    effects = [(1, 100 * i + 50, 0, "erase_database", "a", None, None, None) for i in range(20)]
    kept = ct.apply_ddl_epochs(spark.createDataFrame(changes, CHANGES), spark.createDataFrame(effects, EFFECTS))
    assert sorted(r.n for r in kept.collect()) == list(range(20, 50))
    assert max(sizes) == 20  # not one row for each of the 50 tables
