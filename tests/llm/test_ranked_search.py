"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import check
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from changetables.llm import queries
from changetables.llm.ranked_search import Query, Search, Shard, build_index, search, terms
from changetables.session import materialise

SF = "/root/testdata/sf0.01"
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, best):
    held = [(k, Counter(t)) for k, x in docs if (t := plain_terms(x))]
    n, length = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for item, text in items:
        scores = []
        for key, counts in held:
            m = 75 + 25 * counts.total() * n // length
            s = sum(weight[t] * (10**9 * counts[t] // (1000 * counts[t] + 12 * m)) for t in plain_terms(text) if t in counts)
            if s > 0:
                scores.append((-s, key is None, key or 0, key))
        out += [(item, r + 1, key, -s) for r, (s, _, _, key) in enumerate(sorted(scores, key=lambda x: x[:3])[:best])]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def run(spark, docs, items, how=Search()):
    index = materialise(build_index(spark.createDataFrame(docs, DOCS).repartition(3), how), "index")
    return got(search(index, spark.createDataFrame(items, ITEMS), how))


EDGE = [
    (1, None),
    (2, ""),
    (3, "  .,;:!?()[]{} "),
    (4, "Hello hello WORLD"),
    (5, "hello world"),
    (6, "hello world"),
    (6, "hello world"),
    (7, "Ärger ÄRGER ärger 字, x1 1x"),
    (8, "common " * 50_000 + "rare"),
    (9, "common rare hello"),
    (None, "hello world"),
]
ASKED = [(1, "hello, hello World"), (1, "hello, hello World"), (2, None), (3, "unknown"), (4, "common RARE rare"), (None, "Ärger")]


@pytest.mark.parametrize("how", [Search(), Search(best=2, shard_postings=3), Search(best=3, block_bytes=30)])
def test_edge_texts(spark, how):
    assert run(spark, EDGE, ASKED, how) == plain_search(EDGE, ASKED, how.best)


def test_terms():
    text = "aB9_-Zz[é]É\x7f 字"
    assert [t.decode() for t in terms(text)] == plain_terms(text)
    assert terms(None) == []


def test_empty_tables_and_names(spark):
    docs, items = spark.createDataFrame(EDGE, DOCS), spark.createDataFrame(ASKED, ITEMS)
    extra = docs.withColumns({"key": F.lit(1), "term": F.lit("x"), "shard": F.lit(2)})
    index = materialise(build_index(extra), "index")
    with_extra = items.withColumns({"query": F.lit(1), "item": F.lit(2), "repeats": F.lit(3)})
    assert got(search(index, with_extra)) == plain_search(EDGE, ASKED, 20)
    empty = search(materialise(build_index(docs.limit(0)), "index"), items)
    assert empty.collect() == [] and empty.columns == ["item_id", "rank", "doc_id", "score"]
    assert search(index, items.limit(0)).collect() == []
    with pytest.raises(ValueError):
        search(index, items, key="rank")


def test_text_keys(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y"), ("c", "z")], "name string, body string")
    items = spark.createDataFrame([("q", "x")], "item string, body string")
    index = materialise(build_index(docs, key="name", text="body"), "index")
    found = search(index, items, item="item", text="body", key="name").orderBy("rank").collect()
    assert [r["name"] for r in found] == ["a", "b", None]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_texts_in_many_shards(spark, seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    text = lambda n: " ".join(rnd.choices(words, weights, k=n))
    docs = [(i, text(rnd.randint(1, 40))) for i in range(400)]
    docs += [(1000 + i, docs[i % 7][1]) for i in range(60)]
    items = [(i, text(rnd.randint(1, 12))) for i in range(15)]
    how = Search(best=5, shard_postings=300)
    assert run(spark, docs, items, how) == plain_search(docs, items, 5)


def shard_of(rows, weights):
    """A shard whose postings and pair lists were made of (term, docs, counts)."""
    size = 1 + max(max(d) for _, d, _ in rows)
    frame = pd.DataFrame(
        [("s", None, None, None, [10] * size)] + [("s", t, np.array(d), np.array(c), None) for t, d, c in rows],
        columns=["shard", "term", "docs", "counts", "lengths"],
    ).assign(other=None, top=None)
    shard = Shard(frame, weights, size, 10 * size)
    for a, b in zip(sorted(weights, key=lambda t: (-weights[t], t)), sorted(weights, key=lambda t: (-weights[t], t))[1:]):
        docs, joint = shard.join(a, b)
        if len(docs):
            shard.pairs[a, b] = (docs, int(joint.max()))
    return shard


def test_pair_bounds_are_tighter_and_hold():
    rnd = random.Random(4)
    weights = {f"t{i}": 900 - i for i in range(8)}
    rows = []
    for t in weights:
        docs = sorted(rnd.sample(range(300), 8))
        rows.append((t, docs, [rnd.randint(1, 5) for _ in docs]))
    shard = shard_of(rows, weights)
    query = Query(0, {t: rnd.randint(1, 3) for t in weights}, weights)
    units = shard.units(query)
    alone = sum(query.repeats[t] * shard.lists[t][2] for t in query.terms)
    assert sum(u[0] for u in units) < 0.8 * alone
    assert sorted(t for u in units for t in u[2]) == sorted(query.terms)
    for bound, apart, names in units:
        total = np.zeros(300, np.int64)
        for t in names:
            total[shard.lists[t][0]] += query.repeats[t] * shard.lists[t][1]
        assert total.max() <= bound
        inside = shard.pairs[names][0] if names in shard.pairs else []
        assert np.delete(total, inside).max() <= apart or len(names) == 1
    docs, score = shard.search(query, 0, 5)
    total = np.zeros(300, np.int64)
    for t in query.terms:
        total[shard.lists[t][0]] += query.repeats[t] * shard.lists[t][1]
    assert sorted(score.tolist())[-5:] == sorted(total.tolist())[-5:]
    assert (total[docs] == score).all()


def test_query_equals_sql(spark):
    got = queries.QUERIES["op11_pair_maxscore"](spark, SF).toPandas()
    want = check.tables(SF).execute(queries.ORACLES["op11_pair_maxscore"]).df()
    assert check.compare(got, want) == ""
