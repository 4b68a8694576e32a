"""Secret scans: fixed patterns, and strings that look random to a character model.

Two Markov models of neighbouring characters, one of random strings and one of ordinary
identifiers, are counted on labelled samples: what the fixed patterns match is random,
other long tokens of the same documents are ordinary. A token is reported when the
log-likelihood ratio of the two models is high enough.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changetables.functions.text import let
from changetables.llm.common import matches

# The patterns of the result's contract, in the order of its kinds.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
#: A token starts and ends where its run of characters does, so runs of any length are read once.
TOKEN = r"[A-Za-z0-9+/_=-]{%d,}"
_SIDE = 128


@dataclass(frozen=True)
class Training:
    """Bounds and thresholds of the models.

    About ``max_docs`` documents, chosen by hash, give the random strings and about
    ``max_ordinary_docs`` of them the ordinary tokens. A token of at least ``min_chars``
    characters is a secret at ``min_nats`` or more in all and ``min_nats_per_char`` or
    more on average.
    """

    max_docs: int = 20_000
    max_ordinary_docs: int = 2_500
    min_chars: int = 16
    min_nats: float = 15.0
    min_nats_per_char: float = 0.75
    smoothing: float = 0.5


def _spans(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """Spans (start, kind, end) of the matches that ``keep`` (matched string, index) accepts."""

    def located(found: Column, between: Column) -> Column:
        steps = F.transform(
            between, lambda b, j: F.length(b) + F.when(j > 0, F.length(F.get(found, j - 1))).otherwise(F.lit(0))
        )
        chosen = F.filter(
            F.transform(found, lambda m, i: F.struct(m.alias("m"), i.alias("i"))),
            lambda x: F.lit(True) if keep is None else keep(x["m"], x["i"]),
        )

        def span(x: Column, lengths: Column) -> Column:
            start = F.aggregate(F.slice(lengths, 1, x["i"] + 1), F.lit(0), lambda a, b: a + b)
            return let(
                start,
                lambda s: F.struct(s.alias("start"), F.lit(kind).alias("kind"), (s + F.length(x["m"])).alias("end")),
            )

        return let(steps, lambda lengths: F.transform(chosen, lambda x: span(x, lengths)))

    return matches(text, pattern, located)


def base_spans(text: Column) -> Column:
    """Spans of the three fixed kinds, by start and kind."""
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(1))
    assign = let(values, lambda v: _spans(text, ASSIGN, 0, lambda _, i: F.length(F.get(v, i)) >= 6))
    return F.sort_array(F.concat(assign, _spans(text, ACCESS, 1), _spans(text, HEX, 2)))


def _pairs(tokens: Column) -> Column:
    """Numbers of all neighbouring characters of each token."""
    return F.flatten(
        F.transform(
            tokens,
            lambda t: let(
                F.split(t, ""),
                lambda c: F.transform(
                    F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0))),
                    lambda x, i: F.ascii(F.get(c, i)) * _SIDE + F.ascii(x),
                ),
            ),
        )
    )


def train(docs: DataFrame, how: Training = Training(), text: str = "text") -> list[int]:
    """Log-likelihood ratios, random over ordinary, of every pair of characters, in 1/1000 nats.

    The sample is bounded in expectation; counts combine before the shuffle and at most
    two rows for each pair of characters reach the driver. Without samples of one kind
    its model is uniform.
    """
    total = docs.count()
    place = F.pmod(F.xxhash64(F.lit("train"), text), F.lit(1 << 20))

    def within(bound: int) -> Column:
        return place < int(min(1.0, bound / max(total, 1)) * (1 << 20))

    whole = F.col(text)
    known = F.concat(
        F.regexp_extract_all(whole, F.lit(ASSIGN), F.lit(1)),
        F.regexp_extract_all(whole, F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all(whole, F.lit(HEX), F.lit(0)),
    )
    rest = F.regexp_replace(whole, f"{ASSIGN}|{ACCESS}|{HEX}", " ")
    other = F.when(within(how.max_ordinary_docs), F.regexp_extract_all(rest, F.lit(TOKEN % 8), F.lit(0)))
    labelled = docs.where(F.col(text).isNotNull() & within(how.max_docs)).select(
        F.explode(
            F.array(
                F.struct(F.lit(1).alias("random"), F.filter(known, lambda t: F.length(t) >= 6).alias("tokens")),
                F.struct(F.lit(0).alias("random"), other.alias("tokens")),
            )
        ).alias("x")
    )
    counts = (
        labelled.select("x.random", F.explode(_pairs(F.col("x.tokens"))).alias("pair"))
        .groupBy("random", "pair")
        .count()
        .collect()
    )
    codes = [ord(c) for c in ALPHABET]
    seen = {(row["random"], row["pair"]): row["count"] for row in counts}

    def log_p(kind: int) -> dict[int, float]:
        out = {}
        for a in codes:
            row = [seen.get((kind, a * _SIDE + b), 0) + how.smoothing for b in codes]
            out.update({a * _SIDE + b: math.log(n / sum(row)) for b, n in zip(codes, row)})
        return out

    random, ordinary = log_p(1), log_p(0)
    return [round(1000 * (random[k] - ordinary[k])) if k in random else 0 for k in range(_SIDE * _SIDE)]


def find(docs: DataFrame, model: list[int], how: Training = Training(), text: str = "text") -> DataFrame:
    """``docs`` with ``spans``: array of (start, kind, end) by start and kind.

    ``kind`` is a place in ``KINDS``; start and end count code points, the end is
    exclusive. All spans of the fixed patterns are there; a random-looking token is added
    if it overlaps none of them. A null text is an empty one. Every input row comes back.
    A column of the name ``spans`` is replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    ratios = F.split(F.lit(",".join(map(str, model))), ",").cast("array<int>")

    def looks_random(token: Column, _: Column) -> Column:
        score = F.aggregate(_pairs(F.array(token)), F.lit(0), lambda a, p: a + F.get(ratios, p))
        least = F.greatest(F.lit(how.min_nats), how.min_nats_per_char * F.length(token))
        return score >= 1000 * least

    found = docs.withColumn("spans", base_spans(whole)).withColumn(
        "__random", _spans(whole, TOKEN % how.min_chars, 3, looks_random)
    )
    extra = F.filter(
        "__random",
        lambda r: ~F.exists("spans", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])),
    )
    return found.withColumn("spans", F.sort_array(F.concat("spans", extra))).drop("__random")


def span_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )
