"""Near words, forms and roots, against comparing all words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from changetables.llm import queries
from changetables.llm.spelling_variants import Codes, Variants, count_words, follow, group, near_words, one_edit

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"
SMALL = dict(held_bytes=60, asking_bytes=100)


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_counts(rows, drop_one_in=None, least=3):
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if drop_one_in and h % drop_one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= least}


def plain_groups(n):
    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    near = {w: [v for k in (-1, 0, 1) for v in by_length.get(len(w) + k, ()) if is_near(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 2 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_one_edit():
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choice("abä") for _ in range(rnd.randint(1, 6)))
    a, b = ([word() for _ in range(3000)] for _ in range(2))
    a.append("x" * 100_000)
    b.append("x" * 50_000 + "y" + "x" * 50_000)
    i = np.arange(len(a))
    assert one_edit(Codes(a), i, Codes(b), i).tolist() == [is_near(x, y) for x, y in zip(a, b)]


@pytest.mark.parametrize("how", [Variants(), Variants(letter_groups=4, levels=2, **SMALL), Variants(levels=1, **SMALL)])
def test_near_words(spark, how):
    rnd = random.Random(7)
    words = {"".join(rnd.choice("abcdefé") for _ in range(rnd.randint(3, 6))) for _ in range(700)}
    words |= {"aaaaa", "aaaaaa", "aaaaaaa", "b" * 3000, "b" * 3001, "b" * 2999 + "c"}
    df = spark.createDataFrame([(w, len(w)) for w in words], "word string, n long")
    found = [tuple(r) for r in near_words(df, how).collect()]
    assert all(n == len(w) for a, n_a, b, n_b in found for w, n in ((a, n_a), (b, n_b)))
    pairs = [tuple(sorted((a, b))) for a, _, b, _ in found]
    assert len(pairs) == len(set(pairs))
    ordered = sorted(words)
    assert set(pairs) == {(a, b) for i, a in enumerate(ordered) for b in ordered[i + 1 :] if is_near(a, b)}


ROWS = [
    (1, None),
    (2, ""),
    (3, "Wörter wörter WÖRTER Wörtar wörtar wörtar"),
    (4, "hello Hello HELLO hello hello hello helo helo helo hallo hallo hallo"),
    (4, "hello Hello HELLO hello hello hello helo helo helo hallo hallo hallo"),
    (5, "字字字字字 hello字hello1hello_hello ābcdef ×××××  ÷÷÷÷÷÷ ×××××"),
    (6, "z" * 70_000 + " " + "z" * 70_000),
    (7, "z" * 70_000 + " tiesa tiesa tiesa tiesb tiesb tiesb " + "ties " * 9),
    (None, "hello hello"),
]


@pytest.mark.parametrize("drop", [None, 3])
def test_edge_texts(spark, drop):
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumns({"word": F.lit("x"), "n": F.lit(1), "subtree": F.lit(2), "k": F.lit(1)})
    how = Variants(drop_one_in=drop)
    counts = count_words(docs, how)
    n = plain_counts(ROWS, drop)
    assert dict(got(counts)) == n
    assert got(group(counts, how)) == plain_groups(n)
    assert group(count_words(docs.limit(0), how), how).collect() == []


def test_small_tables_in_between(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    assert dict(got(count_words(docs, Variants(table_bytes=10)))) == plain_counts(ROWS)


def test_follow(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(20)] + [("x", "w3"), ("y", "z")]
    want = [(w, "z" if w == "y" else "w20") for w, _ in chain]
    assert got(follow(spark.createDataFrame(chain, "word string, form string"))) == sorted(want)
    assert follow(spark.createDataFrame([], "word string, form string")).collect() == []


def test_query(spark):
    docs = [tuple(r) for r in queries.table(spark, SF, "documents").select("doc_id", "text").collect()]
    found = queries.QUERIES["op13_count_trie"](spark, SF)
    assert got(found.select("word", "form", "root", "n", "n_near", "form_n")) == plain_groups(plain_counts(docs, 97))
