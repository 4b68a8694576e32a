import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from changetables.plans import scan
from changetables.plans.asof import asof_lookup
from changetables.plans.chase import reachable, resolve_roots
from changetables.plans.scan import Scan, hot_keys, keyed_scan, segmented_scan
from changetables.session import materialise
from helpers import rows


def _frame(spark, n=400, seed=1):
    rnd = random.Random(seed)
    data = [
        (
            rnd.choice([None, "a", "a", "a", "b", f"k{i % 37}"]),
            i,
            i // 17,
            rnd.choice([None, None, rnd.randint(0, 9)]),
            rnd.randint(0, 3),
        )
        for i in range(n)
    ]
    rnd.shuffle(data)
    return spark.createDataFrame(data, "key string, at int, seg int, v int, w int")


def _scans():
    return [
        Scan("l", "last", F.col("v")),
        Scan("b", "last_before", F.col("v")),
        Scan("n", "next_after", F.col("v")),
        Scan("s", "sum", F.col("w")),
        Scan("t", "sum_before", F.col("w")),
        Scan("m", "max", F.col("v")),
    ]


@pytest.mark.parametrize("limits", [None, (0, 1000), (30, 1000), (10**6, 1000), (5, 1)])
def test_scans_equal_plain_windows(spark, limits):
    df = _frame(spark)
    if limits is None:
        got = segmented_scan(df, ["key"], ["at"], "seg", _scans())
    else:
        got = keyed_scan(df, ["key"], ["at"], "seg", _scans(), *limits).drop("seg")
        df = df.drop("seg")
    w = Window.partitionBy("key").orderBy("at")
    past, upto = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, 0)
    ahead = w.rowsBetween(1, Window.unboundedFollowing)
    want = df.select(
        "*",
        F.last("v", ignorenulls=True).over(upto).alias("l"),
        F.last("v", ignorenulls=True).over(past).alias("b"),
        F.first("v", ignorenulls=True).over(ahead).alias("n"),
        F.sum("w").over(upto).alias("s"),
        F.sum("w").over(past).alias("t"),
        F.max("v").over(upto).alias("m"),
    )
    assert rows(got) == rows(want)


@pytest.mark.parametrize("buckets", [1, 4, 1 << 16])
def test_no_hot_key_is_missed(spark, buckets):
    rnd = random.Random(buckets)
    data = [(rnd.choice(["a", None]), min(int(rnd.expovariate(0.2)), 30)) for _ in range(600)]
    counts = Counter(data)
    df = spark.createDataFrame(data, "k string, n int")
    for limit in (0, 3, 20, 50):
        got = hot_keys(df, ["k", "n"], limit, buckets)
        want = [key for key, n in counts.items() if n > limit]
        assert rows(got) == sorted(want, key=repr) if want else got is None
    assert hot_keys(df, ["k", "n"], 600) is None
    assert hot_keys(df.limit(0), ["k", "n"], 1) is None


def test_keys_are_not_shuffled_to_find_that_none_is_hot(spark, monkeypatch):
    written = []

    def watch(df, label):
        written.append(df._jdf.queryExecution().executedPlan().toString())
        return materialise(df, label)

    monkeypatch.setattr(scan, "materialise", watch)
    assert hot_keys(spark.range(10_000).selectExpr("id", "'x' as other"), ["id", "other"], 100) is None
    (plan,) = written
    assert plan.count("Exchange") == 1 and "partial_count" in plan
    assert "hashpartitioning(pmod(xxhash64" in plan or "hashpartitioning(_groupingexpression" in plan


def test_heavy_window_is_split_by_segment(spark):
    df = _frame(spark)
    plan = segmented_scan(df, ["key"], ["at"], "seg", [Scan("l", "last", F.col("v"))])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(key" in text and "seg" in text
    assert "Join" not in text and "Cartesian" not in text


@pytest.mark.parametrize("direction", ["last", "next"])
def test_both_asof_strategies_agree_with_brute_force(spark, direction):
    rnd = random.Random(3)
    left = [(rnd.choice(["a", "a", "b", None]), i, i // 9) for i in range(200)]
    right = [(k, at, at // 9, f"{k}{at}") for k, at in {(rnd.choice(["a", "b", None]), rnd.randint(0, 199)) for _ in range(60)}]
    l_df = spark.createDataFrame(left, "key string, at int, seg int")
    r_df = spark.createDataFrame(right, "key string, at int, seg int, v string").withColumn("v", F.struct("v"))

    def found(key, at):
        hits = [(a, v) for k, a, _, v in right if k == key and (a <= at if direction == "last" else a > at)]
        return (max(hits) if direction == "last" else min(hits))[1] if hits else None

    want = sorted(((k, at, found(k, at)) for k, at, _ in left), key=repr)
    for small in (1000, 0):
        got = asof_lookup(l_df, r_df, ["key"], "at", "seg", "v", direction, small)
        assert rows(got.select("key", "at", "v.v")) == want


def test_chains_end_where_a_walk_ends(spark):
    rnd = random.Random(5)
    n = 200
    links = {i: (rnd.choice([None, i + 1, rnd.randint(i + 1, n)]) if i < n - 1 else None) for i in range(n)}
    links = {i: j if j is None or j < n else None for i, j in links.items()}
    erased = set(rnd.sample(range(n), 20))
    data = [(i, j, j in erased) for i, j in links.items() if i not in erased]

    def root(i):
        while links[i] is not None:
            i = links[i]
            if i in erased:
                return None
        return i

    df = spark.createDataFrame(data, "id int, next int, next_erases boolean")
    assert rows(resolve_roots(df)) == sorted(((i, root(i)) for i, _, _ in data), key=repr)

    starts = rnd.sample(range(n), 7)
    seen, todo = set(), list(starts)
    while todo:
        i = todo.pop()
        if i is None or i in seen:
            continue
        seen.add(i)
        if i not in erased:
            todo.append(links[i])
    got = reachable(df.select("id", "next"), spark.createDataFrame([(i,) for i in starts], "id int"))
    assert {r.id for r in got.collect()} == seen


def test_hot_link_target_is_split(spark):
    """Most links share one target; adaptive execution splits its partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    n = 60_000
    links = spark.range(0, n + 2, 1, 8).selectExpr(
        f"id", f"case when id < {n} then {n} when id = {n} then {n + 1} end as next", "false as next_erases"
    )
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        pending = links.filter("next is not null").select("id", F.col("next").alias("target"))
        known = links.select(F.col("id").alias("target"), F.col("next").alias("further"))
        step = pending.join(known, "target").select("id", "further")
        step.collect()
        assert "skew=true" in step._jdf.queryExecution().executedPlan().toString()
        got = resolve_roots(links).groupBy("root").count()
        assert rows(got) == [(n + 1, n + 2)]
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
