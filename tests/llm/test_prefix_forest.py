"""Hash-prefix forest: recall against brute force, exact scores, copies and odd vectors."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from changetables.llm import prefix_forest, queries

SF = "/root/testdata/sf0.1"


def brute(ids, x, queries_, k=20):
    out = {}
    for q in queries_:
        at = int(np.flatnonzero(ids == q)[0])
        scores = x @ x[at]
        others = np.flatnonzero(ids != q)
        best = others[np.lexsort((ids[others], -scores[others]))][:k]
        out[q] = [(int(ids[b]), float(scores[b])) for b in best]
    return out


def found(df):
    by = defaultdict(list)
    for r in df.collect():
        by[r.query_id].append((r.rank, r.vec_id, r.score))
    return {q: [(i, s) for _, i, s in sorted(v)] for q, v in by.items()}


def recall(got, want):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in w}) / len(w) for q, w in want.items()])


@pytest.mark.parametrize("block", [4096, 300])
def test_recall_on_given_vectors(spark, block):
    rows = queries.table(spark, SF, "embeddings")
    table = rows.toPandas()
    ids, x = table["vec_id"].to_numpy(), np.array(table["embedding"].tolist(), float)
    got = found(prefix_forest.search(rows, F.pmod("vec_id", F.lit(20)) == 0, how=prefix_forest.Forest(block=block)))
    want = brute(ids, x, [i for i in ids if i % 20 == 0])
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.9
    true = {(q, i): s for q in want for i, s in zip(ids, x @ x[np.flatnonzero(ids == q)[0]])}
    for q, list_ in got.items():
        assert all(abs(true[q, i] - s) < 1e-12 for i, s in list_)
        assert list_ == sorted(list_, key=lambda v: (-v[1], v[0])) and q not in {i for i, _ in list_}


def test_lengths_copies_and_odd_vectors(spark):
    """Vectors of all lengths, one with a third of the rows, crowded blocks, and some that take no part."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((1500, 12)) * rng.uniform(0.2, 3, (1500, 1))
    x[::3] = x[0]
    x[1::6] = x[1] + 1e-3 * rng.standard_normal((250, 12))
    data = [(i, v.tolist(), "e") for i, v in enumerate(x)]
    odd = [None, [], [0.0] * 12, [float("nan")] * 12, [float("inf")] + [1.0] * 11, [None] + [1.0] * 11, [1.0] * 5]
    data += [(10_000 + 20 * i, v, "e") for i, v in enumerate(odd)] + [(None, [1.0] * 12, "e")]
    rows = spark.createDataFrame(data, "vec_id long, embedding array<double>, rep string").repartition(6)
    how = prefix_forest.Forest(block=100, crowd=2)
    got = found(prefix_forest.search(rows, F.pmod("vec_id", F.lit(20)) == 0, how=how))
    want = brute(np.arange(1500), x, range(0, 1500, 20))
    assert got.keys() == want.keys()
    assert recall(got, want) >= 0.9
    assert [i for i, _ in got[0]] == [i for i, _ in want[0]]


def test_few_rows(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.0, 1.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = found(prefix_forest.search(rows, F.pmod("vec_id", F.lit(20)) == 0))
    assert got == {0: [(3, 1.0), (20, 0.0)], 20: [(3, 1.0), (0, 0.0)]}
    assert prefix_forest.search(rows.limit(0), F.pmod("vec_id", F.lit(20)) == 0).count() == 0


def clustered(n, seed):
    """Unit vectors: 200 clusters, and 2 % that lie alone."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((200, 64))[rng.integers(0, 200, n)] + 0.15 * rng.standard_normal((n, 64))
    alone = rng.random(n) < 0.02
    x[alone] = rng.standard_normal((alone.sum(), 64))
    return x / np.linalg.norm(x, axis=1, keepdims=True), alone


def test_lonely_queries_ascend(spark):
    """One depth fits the clusters; vectors alone need shorter prefixes."""
    x, alone = clustered(6000, 3)
    asked = np.flatnonzero(alone | (np.arange(6000) % 100 == 0))
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>").repartition(6)
    got = found(prefix_forest.search(rows, F.col("vec_id").isin([int(q) for q in asked])))
    want = brute(np.arange(6000), x, asked)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert recall(got, {q: w for q, w in want.items() if alone[q]}) >= 0.9
    assert recall(got, want) >= 0.9


def test_recall_in_crowded_blocks(spark):
    """With a common component blocks are uneven; those that are cut hold fewer neighbours."""
    x = np.random.default_rng(5).standard_normal((6000, 64)) / 8
    x[:, 0] += 1.2
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>").repartition(6)
    got = found(prefix_forest.search(rows, F.pmod("vec_id", F.lit(100)) == 0, how=prefix_forest.Forest(block=300, crowd=2)))
    want = brute(np.arange(6000), x, range(0, 6000, 100))
    assert got.keys() == want.keys() and recall(got, want) >= 0.9


def test_parts_of_large_blocks(spark):
    """No group has many more than ``block`` vectors or queries, and the parts' best are the block's."""
    x = np.random.default_rng(6).standard_normal((1000, 8))
    rows = spark.createDataFrame([(i, v.astype("<f8").tobytes()) for i, v in enumerate(x)], "rep long, v binary")
    how = prefix_forest.Forest(block=100)
    hasher = prefix_forest.Hasher(8, 1, np.linalg.norm(x, axis=1).max(), how)
    everything = prefix_forest.Round(1, 0, {})
    parts = [prefix_forest._parts(rows, hasher, everything, query, how) for query in (False, True)]
    assert parts == [{(0, 0): 10}] * 2
    schema = "block string, query boolean, ids binary, v binary"
    for query in (False, True):
        placed = rows.mapInArrow(prefix_forest._blocks(hasher, everything, query, None, parts, how), schema)
        sizes = placed.groupBy("block").agg(F.sum(F.length("ids") / 8).alias("n")).collect()
        assert len(sizes) == 100 and max(r.n for r in sizes) < 150 and sum(r.n for r in sizes) == 10_000
    got = prefix_forest._best(rows, rows, hasher, everything, 5, how).collect()
    want = np.sort(x @ x.T, axis=1)[:, :-7:-1]
    assert len(got) == 1000 and all(np.allclose([-b.s for b in r.best], want[r.q]) for r in got)


def test_forest_at_every_size():
    """Few vectors go through trees too."""
    cosines = np.full(640, 0.4)
    assert all(prefix_forest.fit(cosines, n, prefix_forest.Forest())[1] > 0 for n in (100, 500, 2000, 5000))
