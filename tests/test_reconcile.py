import random
from collections import Counter

import changetables as ct
from changetables.operators import reconcile
from helpers import rows


def test_diff_with_nulls_duplicates_and_changes(spark):
    schema = "k int, a string, b int"
    src = [(1, "x", 1), (2, None, 2), (3, "y", 3), (None, "n", 0), (5, "d", 1), (5, "d", 1), (6, "e", 1)]
    dst = [(1, "x", 1), (2, None, None), (4, "z", 4), (None, "n", 0), (5, "d", 1), (6, "f", 1), (6, "g", 1)]
    found = ct.diff_tables(spark.createDataFrame(src, schema), spark.createDataFrame(dst, schema), ["k"])
    got = rows(found.select("k", "kind", "copies", "changed_columns", "source_row.a", "target_row.a"))
    assert got == sorted(
        [
            (2, "changed", 1, "b", None, None),
            (3, "missing", 1, "", "y", None),
            (4, "extra", 1, "", None, "z"),
            (5, "missing", 1, "", "d", None),
            (6, "extra", 1, "", None, "f"),
            (6, "extra", 1, "", None, "g"),
            (6, "missing", 1, "", "e", None),
        ],
        key=repr,
    )


def test_keyless_diff_is_the_bag_difference(spark):
    rnd = random.Random(2)
    make = lambda: [(rnd.choice([None, 1, 2]), rnd.choice("ab")) for _ in range(60)]
    src, dst = make(), make()
    found = ct.diff_tables(spark.createDataFrame(src, "k int, v string"), spark.createDataFrame(dst, "k int, v string"))
    got = {("missing" == r.kind, tuple(r.source_row or r.target_row)): r.copies for r in found.collect()}
    s, d = Counter(src), Counter(dst)
    assert got == {(True, k): n for k, n in (s - d).items()} | {(False, k): n for k, n in (d - s).items()}


def test_counts_tables_columns_and_duplicates(spark):
    a, b = spark.range(3).toDF("id"), spark.range(2).toDF("id").selectExpr("id", "id as extra")
    got = ct.compare_counts({"t": a, "u": a}, {"t": b, "u": a})
    assert rows(got) == [("t", 3, 2, "MISMATCH"), ("u", 3, 3, "OK")]
    source, target = reconcile.schema_columns(spark, {"t": b, "u": a}), reconcile.schema_columns(spark, {"t": a})
    assert rows(ct.missing_tables(source, target)) == [("u",)]
    assert rows(ct.missing_columns(source, target)) == [("t", "extra"), ("u", "id")]
    dup = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "id int")
    assert rows(ct.duplicates(dup, ["id"])) == [(1, 2), (None, 2)]
