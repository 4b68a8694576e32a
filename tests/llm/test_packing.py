"""Packing: every token once, in order, in near the least number of sequences."""

import json
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from changetables.llm import packing, queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(queries.vocabulary())
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check(rows, limit):
    """Gapless offsets and no sequence above the limit; the number of sequences."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= limit
    return len(by)


def test_whole_table(spark, reference):
    docs = {r.doc_id: r.text for r in queries.table(spark, SF, "documents").collect()}
    rows = queries.QUERIES["op8_genetic_packing"](spark, SF).collect()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    assert set(by_doc) == set(docs)
    total = 0
    for doc_id, pieces in by_doc.items():
        ids, at = reference(docs[doc_id]), 0
        total += len(ids)
        for k, r in enumerate(sorted(pieces, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at)
            assert r.length == 1024 or k == 0
            assert r.ids_crc32 == crc(ids[at : at + r.length])
            at += r.length
        assert at == len(ids)
    least = max(-(-total // 1024), sum(2 * r.length > 1024 for r in rows))
    assert check(rows, 1024) <= 1.005 * least + 1


def test_edge_texts(spark, reference):
    texts = [None, "", " ", "a b", "a  b\n\n c\t d", "<|endoftext|> x", "'s it's é 😀\x1c y", "x" * 5000, " " * 3000 + "y", "ab " * 3000]
    data = [(i, t, 7) for i, t in enumerate(texts)] + [(0, None, 7), (3, "a b", 7)]
    docs = spark.createDataFrame(data, "doc_id int, text string, piece int")
    pieces = packing.tokenised_pieces(docs, queries.vocabulary(), 100, 2, keep_ids=True)
    rows = packing.pack(pieces, 100).collect()
    check(rows, 100)
    found = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.start):
        found[r.doc_id] += r.ids
    for i, text in enumerate(texts):
        assert sorted(found[i]) == sorted(reference(text) * (2 if i in (0, 3) else 1))
        assert i in (0, 3) or found[i] == reference(text)


def test_levels_and_islands(spark):
    """Several small blocks lose little against one."""
    rng = np.random.default_rng(4)
    data = [(i, int(n)) for i, n in enumerate(rng.integers(1, 1025, 3000))]
    pieces = spark.createDataFrame(data, "doc_id int, length long").selectExpr("*", "1 as uid", "2 as block", "'x' as offset")
    how = packing.Evolution(block=300, islands=3, rounds=3)
    rows = packing.pack(pieces, 1024, how).collect()
    assert sorted((r.doc_id, r.length) for r in rows) == data
    least = max(-(-sum(n for _, n in data) // 1024), sum(2 * n > 1024 for _, n in data))
    assert check(rows, 1024) <= 1.03 * least


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.tokenised_pieces(docs, queries.vocabulary(), 10, 2), 10).count() == 0


def test_crossover_beats_its_parents():
    """From poor parents the search gets to fewer bins, and each packing stays valid."""
    rng = np.random.default_rng(9)
    lengths = np.sort(rng.integers(30, 400, 600))[::-1].copy()
    seeds = []
    for _ in range(4):
        bins = np.zeros(600, np.int64)
        loads = []
        for i in rng.permutation(600):
            if not loads or loads[-1] + lengths[i] > 1000:
                loads.append(0)
            loads[-1] += lengths[i]
            bins[i] = len(loads) - 1
        seeds.append(bins)
    best = packing.evolve(lengths, 1000, seeds, packing.Evolution(), rng)[0]
    assert np.bincount(best, weights=lengths).max() <= 1000
    assert packing.fitness(best, lengths) < min(packing.fitness(s, lengths) for s in seeds)


@pytest.mark.parametrize("special", [True, False])
def test_special_strings(special):
    definition = open(queries.vocabulary()).read()
    plain = Tokenizer.from_str(definition)
    plain.encode_special_tokens = not special
    names = [t["content"] for t in json.loads(definition)["added_tokens"]]
    engine = packing.ByteBpe(definition, special)
    for text in ["", *names, *(f"a{n}b {n}{n} c" for n in names), names[0][:-1], "a" * 3000 + names[0]]:
        assert engine.encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids
    assert (len(engine.encode(f"a{names[0]}b")) == 3) == special
