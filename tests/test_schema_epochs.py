"""Schema changes kept as a table, applied to the images of many tables."""

import random

import pytest
from pyspark.sql import functions as F

import changetables as ct
from changetables.operators.ddl_effects import STEP_FIELDS

IMAGES = "schema_name string, table_name string, file_seq long, pos long, ordinal int, after map<string,string>"


def _walked(rnd, columns, n):
    """Random schema changes at every second position, and images logged between them."""
    names, steps, images = list(columns), [], []
    for k in range(n):
        row = {c: rnd.choice([None, "7", "1.5", "x"]) for c in names}
        images.append((2 * k, row))
        action = rnd.choice(["add", "drop", "rename", "modify"]) if names else "add"
        at, new = 2 * k + 1, f"n{k}"
        if action == "add":
            steps.append((at, "add", new, None, "string", rnd.choice([None, "3", "y"])))
            names.append(new)
            continue
        # a dropped or renamed name may come back, so that names are used twice
        column = rnd.choice(names)
        if action == "drop":
            steps.append((at, "drop", column, None, None, None))
            names.remove(column)
            if rnd.random() < 0.5:
                steps.append((at + 0.5, "add", column, None, "string", "again"))
                names.append(column)
        elif action == "rename":
            steps.append((at, "rename", column, new, None, None))
            names[names.index(column)] = new
        else:
            steps.append((at, "modify", column, None, rnd.choice(["INT", " double", "string"]), None))
    images.append((2 * n, {c: "end" for c in names}))
    return [(int(2 * at), *rest) for at, *rest in steps], [(2 * at, row) for at, row in images]


def _brute(row, at, steps):
    def cast(value, kind):
        if value is None:
            return None
        kind = kind.strip().lower()
        try:
            return {"int": lambda: str(int(value)), "double": lambda: str(float(value)), "string": lambda: value}[kind]()
        except ValueError:
            return None

    row = dict(row)
    for when, action, column, to, kind, default in steps:
        if when <= at:
            continue
        if action == "add":
            row[column] = default
        elif column in row:
            value = row.pop(column)
            if action == "rename":
                row[to] = value
            elif action == "modify":
                row[column] = cast(value, kind)
    return row


@pytest.mark.parametrize("small", [1000, 0])
def test_every_table_follows_its_own_steps(spark, small):
    rnd = random.Random(5)
    steps, images, want = [], [], {}
    for table, columns in (("a", ["p", "q"]), ("b", ["p"]), (None, ["q"]), ("still", ["p"])):
        own, logged = _walked(rnd, columns, 12)
        own = [] if table == "still" else own
        steps += [("s", table, 1, at, 0, *rest) for at, *rest in own]
        for at, row in logged:
            images.append(("s", table, 1, at, 0, row))
            want[table, at] = _brute(row, at, own)
    log = spark.createDataFrame(images, IMAGES)
    got = ct.evolve_by_log(log, spark.createDataFrame(steps, STEP_FIELDS), ["after"], small)
    assert got.columns == log.columns
    assert {(r.table_name, r.pos): r.after for r in got.collect()} == want


def test_partial_and_null_images(spark):
    steps = spark.createDataFrame(
        [
            ("s", "t", 1, 10, 0, "rename", "a", "b", None, None),
            ("s", "t", 1, 10, 1, "add", "a", None, "int", "1"),
            ("s", "t", 1, 20, 0, "drop", "c", None, None, None),
            ("s", "t", 1, 30, 0, "modify", "b", None, "int", None),
        ],
        STEP_FIELDS,
    )
    data = [
        (1, {"a": "5", "c": "z"}, None),
        (2, {"a": "5", "c": "z"}, ["a", "c"]),
        (3, None, None),
        (4, {}, []),
        (15, {"b": "w"}, ["b"]),
        (40, {"b": "w"}, ["b"]),
    ]
    log = spark.createDataFrame([("s", "t", 1, p, 0, a, h) for p, a, h in data], IMAGES + ", after_present array<string>")
    got = {r.pos: (r.after, r.after_present) for r in ct.evolve_by_log(log, steps, ["after"]).collect()}
    assert got == {
        1: ({"b": "5", "a": "1"}, None),
        2: ({"b": "5"}, ["b"]),
        3: (None, None),
        4: ({}, []),
        15: ({"b": None}, ["b"]),
        40: ({"b": "w"}, ["b"]),
    }
    assert ct.evolve_by_log(log, steps.limit(0), ["after"]).count() == 6
    assert ct.evolve_by_log(log.limit(0), steps, ["after"]).count() == 0


def test_unknown_steps_and_plan(spark):
    log = spark.createDataFrame([("s", "t", 1, 1, 0, {"a": "1"})], IMAGES)
    bad = spark.createDataFrame([("s", "t", 1, 9, 0, "twist", "a", None, None, None)], STEP_FIELDS)
    with pytest.raises(Exception, match="unknown schema change twist"):
        ct.evolve_by_log(log, bad, ["after"]).collect()
    good = bad.withColumn("action", F.lit("drop"))
    plan = ct.evolve_by_log(log, good, ["after"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan
