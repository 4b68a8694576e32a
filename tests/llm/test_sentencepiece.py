"""Unigram segmentation against the public library, and exact round trips."""

import struct

import numpy as np
import pytest
import sentencepiece

from changetables.llm import queries
from changetables.llm import sentencepiece_unigram as s

SF = "/root/testdata/sf0.01"
MODEL = queries.vocabulary("piece_bpe_32k.model")


def framed(number, data):
    size, out = len(data), b""
    while True:
        out += bytes([size & 127 | (128 if size > 127 else 0)])
        size >>= 7
        if not size:
            return bytes([number << 3 | 2]) + out + data


@pytest.fixture(scope="module")
def encoder():
    return s.Encoder(s.read_vocabulary(MODEL))


@pytest.fixture(scope="module")
def library():
    """The same pieces and scores as a unigram model of the library."""
    scores = iter(s.read_vocabulary(MODEL).scores)
    out = b""
    for number, value in s.fields(open(MODEL, "rb").read()):
        if number == 1:
            value += b"\x15" + struct.pack("<f", next(scores))
        if number == 2:
            value += b"\x18\x01"
        out += framed(number, value)
    return sentencepiece.SentencePieceProcessor(model_proto=out)


EDGES = [
    "", " ", "a", "  two  blanks ", "tab\tline\n\nend\n", "naïve café Straße ñandú", "日本語 テキスト 😀🏳️‍🌈 \u0000\u0001",
    "x" * 300, "ab" * 200 + " " + "é" * 100, " " * 60 + "y", "Internationalization, tokenization!", "  z",
]


def ids(encoder, texts):
    return [np.frombuffer(d, "<i4").tolist() for d in encoder.encode(texts)]


def test_equals_library(encoder, library, spark):
    docs = [r.text for r in queries.table(spark, SF, "documents").collect()]
    texts = EDGES + [t for t in docs if len(t) < 8000][:400]
    for text, got in zip(texts, ids(encoder, texts)):
        assert got == library.encode(text), text[:80]
        assert encoder.decode(got) == library.decode(got) == text


def test_unused_pieces(tmp_path, spark):
    """Every seventh ASCII piece is unused; the library gives the same ids."""
    known = s.read_vocabulary(MODEL)
    unused = {i for i, p in enumerate(known.pieces) if i > 300 and i % 7 == 0 and s.MARK not in p and p.isascii()}
    out, i = b"", 0
    for number, value in s.fields(open(MODEL, "rb").read()):
        if number == 1:
            value += b"\x15" + struct.pack("<f", known.scores[i]) + (b"\x18" + bytes([s.UNUSED]) if i in unused else b"")
            i += 1
        if number == 2:
            value += b"\x18\x01"
        out += framed(number, value)
    (tmp_path / "model").write_bytes(out)
    library = sentencepiece.SentencePieceProcessor(model_proto=out)
    encoder = s.Encoder(s.read_vocabulary(str(tmp_path / "model")))
    docs = [r.text for r in queries.table(spark, SF, "documents").collect()]
    texts = EDGES + [known.pieces[k] for k in sorted(unused)[:500]] + [t for t in docs if len(t) < 3000][:80]
    got = ids(encoder, texts)
    assert got == [library.encode(t) for t in texts]
    assert not unused & {k for x in got for k in x}


def test_one_and_many_agree(encoder, spark):
    words = {w.encode() for r in queries.table(spark, SF, "documents").limit(50).collect() for w in encoder.words(r.text)}
    words = sorted(w for w in words if len(w) <= s.SHORT)
    assert encoder._many(words) == [encoder._one(w) for w in words]


def test_double_array():
    keys = [b"a", b"ab", b"abc", b"b", b"\xe2\x96\x81", b"\xff\x00", b"ba"]
    trie = s.DoubleArray([(k, i) for i, k in enumerate(keys)])

    def find(word):
        state = 0
        for b in word:
            step = trie.base[state] + b + 1
            if trie.check[step] != state:
                return -1
            state = step
        return trie.value[state]

    assert [find(k) for k in keys] == list(range(len(keys)))
    assert {find(k) for k in (b"", b"c", b"abcd", b"\xe2", b"\x00", b"bb")} == {-1}


def test_forgetting_changes_nothing(encoder, monkeypatch):
    texts = ["one two three", "two three four", "five six one"]
    monkeypatch.setattr(s, "REMEMBERED", 3)
    fresh = s.Encoder(s.read_vocabulary(MODEL))
    assert [ids(fresh, [t])[0] for t in texts] == ids(encoder, texts)


def test_whole_table_and_decode(spark):
    docs = queries.table(spark, SF, "documents")
    out = queries.QUERIES["op1_sentencepiece"](spark, SF).cache()
    rows = out.collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect())
    assert all(r.restored and r.n_tokens == len(r.ids) for r in rows)
    back = s.decode(out, MODEL).join(docs.withColumnRenamed("text", "old"), "doc_id")
    assert back.where("text = old").count() == len(rows)


def test_odd_rows(spark):
    data = [(None, None, 1), (1, "", 1), (1, "", 1), (2, "a▁b", 1), (3, "word " * 50_000, 1)]
    docs = spark.createDataFrame(data, "doc_id int, text string, ids int")
    got = {r.doc_id: r for r in s.encode(docs, MODEL).collect()}
    assert got[None].ids == got[1].ids == [] and got[1].restored
    assert not got[2].restored and got[3].restored
    assert s.encode(docs, MODEL).count() == 5
    assert s.encode(docs.limit(0), MODEL).count() == 0
