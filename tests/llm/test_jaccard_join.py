"""N-gram Jaccard join against comparison of all pairs."""

import random
import re

import check
import numpy as np
import pytest

from changetables.llm import jaccard_join as j
from changetables.llm import queries
from changetables.llm.components import components

SF = "/root/testdata/sf0.01"


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))) if words else frozenset()


def brute(rows):
    """{key: (n_shingles, component)} by comparing all pairs."""
    sets = [(k, shingles(t)) for k, t in rows]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, x) in enumerate(sets):
        for k in range(i):
            y = sets[k][1]
            common = len(x & y)
            if x and y and 100 * common >= 80 * (len(x) + len(y) - common):
                parent[root(i)] = root(k)
    least = {}
    for i, (k, _) in enumerate(sets):
        least.setdefault(root(i), []).append(k)
    return [(k, len(s), min(least[root(i)])) for i, (k, s) in enumerate(sets)]


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        at = rng.randrange(len(words))
        if rng.random() < 0.5:
            words[at] = f"e{rng.randrange(10**6)}"
        elif rng.random() < 0.5:
            del words[at : at + rng.randrange(1, 3)]
        else:
            words[at:at] = [f"i{rng.randrange(10**6)}"]
    return words


def corpus(seed, families=60):
    """Families around the limit of similarity, of all sizes, with common passages."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for _ in range(families):
        size = rng.choice([3, 5, 6, 7, 9, 12, 15, 20, 30, 45, 60, 100, 200, 400])
        words = [f"w{rng.randrange(5000)}" for _ in range(size)]
        if rng.random() < 0.5:
            words[size // 2 : size // 2] = passage[: rng.randrange(5, 60)]
        for _ in range(rng.choice([1, 2, 3, 12])):
            rows.append(" ".join(edited(rng, words, rng.randrange(0, 2 + len(words) // 40))))
    rows += [" ".join(passage)] * 3 + [" ".join(passage[k:]) for k in range(30)]
    rows += [None, "", " \n", "One two", "one TWO", "one two three", "a b c d e", "a b c d e a b c d e"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("direct,block", [(2, 2048), (2, 7), (8, 2048)])
def test_equals_all_pairs(spark, direct, block):
    rows = corpus(direct + block)
    docs = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, set int, label string")
    got = [tuple(r) for r in j.classes(docs.repartition(5), j.Join(direct=direct, block=block, flush=4000)).collect()]
    assert sorted(got) == sorted(brute(rows))


def test_signatures_meet_for_all_linked_pairs():
    """The pigeonhole holds at the very limit, for every size."""
    rng = np.random.default_rng(3)
    bands = j.Bands(j.Join())
    for _ in range(3000):
        p = int(np.exp(rng.uniform(np.log(3), np.log(3000))))
        q = int(rng.integers(p, bands.largest(p) + 1))
        common = -(-80 * (p + q) // 180)
        if common == q:  # equal sets are one set
            continue
        pool = rng.integers(0, 2**63, p + q - common, dtype=np.uint64)
        x, y = np.sort(pool[:p]), np.sort(pool[p - common :])
        assert 100 * common >= 80 * (p + q - common) and len(y) == q
        assert np.intersect1d(j.signatures(x, bands), j.signatures(y, bands)).size, (p, q)


def test_sketches_never_part_linked_pairs():
    rng = np.random.default_rng(5)
    bands = j.Bands(j.Join())
    sets = []
    for _ in range(400):
        p = int(np.exp(rng.uniform(np.log(4), np.log(1500))))
        q = int(rng.integers(p, bands.largest(p) + 1))
        common = -(-80 * (p + q) // 180)
        pool = rng.integers(0, 2**63, p + q - common, dtype=np.uint64)
        sets += [np.sort(pool[:p]), np.sort(pool[p - common :])]
    sizes, sketches = np.array([len(s) for s in sets]), [j.sketch(s) for s in sets]
    linked = np.arange(len(sets)).reshape(-1, 2)
    assert j.may_be_linked(linked, sizes, sketches, bands).all()
    others = np.stack([np.arange(len(sets)), rng.permutation(len(sets))], axis=1)
    others = others[others[:, 0] // 2 != others[:, 1] // 2]
    assert j.may_be_linked(others, sizes, sketches, bands).mean() < 0.02


def test_sql(spark):
    got = queries.QUERIES["op10_partition_join"](spark, SF).toPandas()
    assert check.compare(got, check.tables(SF).execute(queries.ORACLES["op10_partition_join"]).df()) == ""


def test_null_repeated_and_empty(spark):
    text = " ".join(f"w{i}" for i in range(30))
    data = [(None, text), (5, text), (5, text), (7, text + " end"), (8, None), (None, None), (9, "x " * 100_000)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = sorted(map(repr, (tuple(r) for r in j.classes(docs).collect())))
    want = [(None, 26, 5), (5, 26, 5), (5, 26, 5), (7, 27, 5), (8, 0, 8), (None, 0, None), (9, 1, 9)]
    assert got == sorted(map(repr, want))
    kept = j.keep_first(docs).collect()
    assert sorted(map(repr, (r.doc_id for r in kept))) == sorted(map(repr, [None, None, 5, 8, 9]))
    assert j.classes(docs.limit(0)).count() == j.keep_first(docs.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 1 for i in range(1, 41)}, **{k: 100 for k in range(100, 160)}, 200: 200, 201: 200}


def test_shingles_are_mixed_once(monkeypatch):
    calls = []
    mixed = j._mixed
    monkeypatch.setattr(j, "_mixed", lambda x: calls.append(len(x)) or mixed(x))
    shingles = j.Shingles(5)
    calls.clear()
    found = shingles.of("a b c d e f g a b c d e b a c d e e d c b a")
    assert calls == [18] and found.dtype == np.uint64 and np.all(found[1:] > found[:-1])
    # windows in another order of words are other shingles; a repeated one counts once
    words = "a b c d e f g a b c d e b a c d e e d c b a".split()
    assert len(found) == len({tuple(words[i : i + 5]) for i in range(18)})
