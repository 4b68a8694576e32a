"""Feistel pseudonyms: formats hold, equal values stay linked, the key restores the originals."""

import datetime
import random
import re

import pytest

from changetables.llm import pseudonyms as p
from changetables.llm import queries

SF = "/root/testdata/sf0.01"


def luhn_ok(text):
    digits = [int(c) for c in re.sub(r"\D", "", text)][::-1]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0


def card(rng, n=16):
    body = "4" + "".join(rng.choice("0123456789") for _ in range(n - 2))
    return next(body + str(c) for c in range(10) if luhn_ok(body + str(c)))


def run(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    out = p.pseudonymise(docs, "k", **options).orderBy("doc_id").collect()
    return [r.text for r in out], [r.replaced for r in out]


RNG = random.Random(3)
VALUES = (
    [card(RNG, n) for n in (13, 15, 16, 16, 19)]
    + ["4111 1111 1111 1111", "3782-822463-10005", "+1 (988) 555-2485", "212-555-0199", "(212) 555-0199", "+1.212.555.0199", "+1 (152) 555-8590", "(099) 155-8590"]
    + ["2000-02-29", "31.12.1999", "12/31/1999", "1800-01-01", "2199-12-31", "078-05-1120", "899-99-9999"]
    + ["+49 30 1234567", "DE89370400440532013000", "GB82WEST12345698765432"]
    + ["42.144.35.254", "0.0.0.0", "ann.lee@b.co", "bosbt.42@mail8.example.com", "A.b-C+9@x-y.example.org"]
)


def test_round_trip_keeps_format_and_surroundings(spark):
    texts = [f"Ünd {v}, then {v}. é" for v in VALUES]
    new, kinds = run(spark, texts)
    for old, value, text, kind in zip(texts, VALUES, new, kinds):
        assert text != old and len(kind) == 2, value
        first, second = re.fullmatch(r"Ünd (.+), then (.+)\. é", text).groups()
        assert first == second
        assert re.fullmatch(p.PATTERNS[kind[0]].replace("{1,256}+", "{1,256}").replace("{1,63}+", "{1,63}"), first)
        if kind[0] == "card":
            assert luhn_ok(first) and re.sub(r"\d", "0", first) == re.sub(r"\d", "0", value)
    back, _ = run(spark, new, restore=True)
    assert back == texts


def test_invalid_values_and_clean_texts_stay(spark):
    texts = [
        None, "", "no numbers here", "4111 1111 1111 1112", "31.02.2000", "2001-02-29", "1.2.3.999", "666-12-3456",
        "x@y", "1234", "2024-01-01" + "0" * 40, "9" * 5000, "a" * 200_000, "DE00370400440532013000", "1799-12-31",
    ]
    new, kinds = run(spark, texts)
    assert new == texts and not any(kinds)


def test_dates_are_permuted(spark):
    """All days of a few years go to different days."""
    days = [datetime.date(1999, 1, 1) + datetime.timedelta(k) for k in range(1200)]
    new, _ = run(spark, [str(d) for d in days])
    assert len(set(new)) == 1200
    assert all(datetime.date(1800, 1, 1) <= datetime.date.fromisoformat(d) <= datetime.date(2199, 12, 31) for d in new)


def test_small_domain_is_a_permutation(spark):
    texts = [f"10.0.{a}.{b}" for a in range(0, 256, 16) for b in range(256)]
    new, _ = run(spark, texts)
    assert len(set(new)) == len(texts)


def test_keys_differ(spark):
    docs = spark.createDataFrame([(1, "42.144.35.254", [1])], "doc_id int, text string, replaced array<int>")
    one, two = (p.pseudonymise(docs, k).first().text for k in "ab")
    assert one != two


@pytest.fixture(scope="module")
def whole(spark):
    return {r.doc_id: r for r in queries.QUERIES["op3_feistel_pseudonyms"](spark, SF).collect()}


def test_whole_table(spark, whole):
    docs = {r.doc_id: r.text for r in queries.table(spark, SF, "documents").collect()}
    assert set(docs) == set(whole)
    python = re.compile("|".join(p.PATTERNS[k] for k in ("ip", "phone")))
    changed = 0
    for doc_id, text in docs.items():
        row = whole[doc_id]
        values = [m[0] for m in python.finditer(text or "")]
        assert row.n_ip + row.n_phone == len(values)
        assert all(v not in row.text for v in values)
        assert "@" not in (text or "") or row.n_email > 0
        changed += row.text != text
    assert 0 < changed < len(docs) / 5
