"""Quality classifier: what a document's text says, combined with what its site is like.

A logistic model of a few text measures and a learnt lexicon gives each document's
evidence. Sites are rated by grouped counts over all documents, a label counting where
there is one and the classifier's probability elsewhere: paths are shrunk towards their
host and hosts towards all documents, by beta-binomial priors. The posterior odds of a
bad document are the odds of its path times its evidence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changetables.llm.common import broadcast_if_small, shrunk
from changetables.session import materialise


@dataclass(frozen=True)
class Learning:
    """Bounds of the training sample and of the model.

    About ``max_rows`` labelled documents, chosen by a hash of their number, train the
    model: one half its lexicon, the other its weights. A lexicon entry is a word or the
    first ``stem`` letters of longer words; it is in at least ``min_docs`` bad documents
    and its log odds are at least ``min_log_odds``. Sites count over all documents.
    """

    max_rows: int = 20_000
    max_entries: int = 2_000
    min_docs: int = 6
    min_log_odds: float = 2.5
    stem: int = 5
    threshold: float = 0.5
    least_weight: float = 2.0
    most_weight: float = 1000.0


@dataclass(frozen=True)
class Model:
    """Lexicon, standardised weights and the training sample's log odds of a bad document."""

    lexicon: dict[str, float]
    stem: int
    mean: np.ndarray = field(default_factory=lambda: np.zeros(10))
    scale: np.ndarray = field(default_factory=lambda: np.ones(10))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(11))
    base: float = 0.0


_WORD = re.compile(r"\w+")
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)


def entries(text: str, stem: int) -> set[str]:
    """Distinct words of a text in lower case, and ``~`` with the first letters of longer ones."""
    found = set(_WORD.findall(text.lower()))
    return found | {"~" + w[:stem] for w in found if len(w) > stem}


def measures(text: str, lexicon: dict[str, float], stem: int) -> list[float]:
    """Ten measures of a text; all are finite, also for an empty one."""
    words = text.split()
    n = max(len(words), 1)
    distinct = len(set(words))
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    size = max(int(raw.sum()), 1)
    lines = text.split("\n")
    again = sum(a == b for a, b in zip(words, words[1:]))
    known = entries(text, stem) & lexicon.keys()
    return [
        float(np.log1p(len(words))),
        min(size / n, 40.0),
        raw[_SYMBOLS].sum() / size,
        raw[65:91].sum() / size,
        raw[33] / size,
        raw[48:58].sum() / size,
        distinct / n,
        again / n,
        len(set(lines)) / len(lines),
        min(sum(lexicon[w] for w in known), 20.0),
    ]


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic model, the constant first, by Newton's method."""
    x = np.hstack([np.ones((len(x), 1)), x])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _outcomes(labels: DataFrame) -> DataFrame:
    """One row per labelled document; bad if any of its rows says so."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    return (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("__id"))
        .agg(F.max(F.coalesce(bad, F.lit(False)).cast("int")).alias("__bad"))
    )


def train(docs: DataFrame, labels: DataFrame, how: Learning = Learning(), key: str = "doc_id", text: str = "text") -> Model:
    """Fit the model on a bounded sample of the labelled documents.

    Without labelled documents of both kinds all evidence is 0. The sampled labels, at
    most ``max_rows`` in expectation, are broadcast; only their measures reach the driver.
    """
    outcomes = _outcomes(labels)
    total = outcomes.count()
    share = int(min(1.0, how.max_rows / max(total, 1)) * (1 << 20))
    chosen = outcomes.where(F.pmod(F.xxhash64(F.lit("sample"), "__id"), F.lit(1 << 20)) < share)
    half = F.pmod(F.xxhash64(F.lit("half"), key), F.lit(2)).alias("half")
    sample = (
        docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .join(F.broadcast(chosen), F.col(key) == F.col("__id"))
        .select(half, "text", "__bad")
    )
    sample = materialise(sample, "labelled-sample")
    stem = how.stem

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [sorted(entries(t, stem)) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "entry": [w for f in found for w in f],
                    "bad": np.repeat(batch["__bad"].to_numpy(), [len(f) for f in found]),
                }
            )

    first = sample.where("half = 0")
    sizes = first.agg(F.sum("__bad"), F.sum(1 - F.col("__bad"))).first()
    n_bad, n_good = sizes[0] or 0, sizes[1] or 0
    if not n_bad or not n_good:
        return Model({}, stem)
    odds = F.log((F.col("bad") + 0.5) / (n_bad + 1.0)) - F.log((F.col("n") - F.col("bad") + 0.5) / (n_good + 1.0))
    lexicon = (
        first.mapInPandas(spread, "entry string, bad int")
        .groupBy("entry")
        .agg(F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("n"))
        .where(F.col("bad") >= how.min_docs)
        .withColumn("odds", odds)
        .where(F.col("odds") >= how.min_log_odds)
        .orderBy(F.desc("odds"), "entry")
        .limit(how.max_entries)
    )
    known = {r["entry"]: float(r["odds"]) for r in lexicon.collect()}

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"x": [measures(t, known, stem) for t in batch["text"]], "bad": batch["__bad"]})

    rows = sample.where("half = 1").mapInPandas(measured, "x array<double>, bad int").toPandas()
    y = rows["bad"].to_numpy(float)
    if not 0 < y.sum() < len(y):
        return Model({}, stem)
    x = np.array(rows["x"].tolist())
    order = np.lexsort((*x.T, y))  # the same fit whatever the order of rows
    x, y = x[order], y[order]
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    weights = _fit(np.clip((x - mean) / scale, -8, 8), y)
    return Model(known, stem, mean, scale, weights, float(np.log(y.mean() / (1 - y.mean()))))


def evidence(text: Column, model: Model) -> Column:
    """Log of how much likelier a bad document has such a text than a good one; 0 without words."""
    lexicon, stem, mean, scale, weights, base = (
        model.lexicon, model.stem, model.mean, model.scale, model.weights, model.base,
    )

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        bare = texts.fillna("")
        x = np.array([measures(t, lexicon, stem) for t in bare]).reshape(-1, len(mean))
        z = weights[0] + np.clip((x - mean) / scale, -8, 8) @ weights[1:] - base
        return pd.Series(np.where([bool(t) and not t.isspace() for t in bare], np.clip(z, -30, 30), 0.0))

    return score(text)


def site_rates(
    docs: DataFrame, labels: DataFrame, model: Model, host: Column, path: Column, how: Learning, key: str, text: str
) -> DataFrame:
    """One row per path (host, path): n, rate and its host's rate, over all documents."""
    base = model.base
    outcomes = _outcomes(labels)
    scored = docs.select(
        F.col(key).alias("__id"),
        host.alias("host"),
        path.alias("path"),
        evidence(F.col(text), model).alias("e"),
    )
    probability = 1 / (1 + F.exp(-(F.col("e") + base)))
    paths = (
        scored.join(outcomes, "__id", "left")
        .groupBy("host", "path")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.col("__bad").cast("double"), probability)).alias("bad"))
    )
    paths = materialise(paths, "path-outcomes")
    total = paths.agg(F.sum("n"), F.sum("bad")).first()
    above = F.lit(((total[1] or 0.0) + 0.5) / ((total[0] or 0) + 1.0))
    bounds = (how.least_weight, how.most_weight)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).withColumn("above", above)
    hosts = shrunk(hosts, *bounds).select("host", F.col("rate").alias("above"))
    rated = shrunk(paths.join(hosts, "host"), *bounds)
    return rated.select("host", "path", "n", "rate", F.col("above").alias("host_rate"))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    host: Column | None = None,
    path: Column | None = None,
    how: Learning = Learning(),
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``docs`` with a struct ``classified``: evidence, host_rate, path_rate, p_bad, kept.

    ``labels`` has (doc_id, quality, toxic): bad is quality 0 or toxic 1. By default the
    host is the column source and the path its lang; null ones are the empty name. A
    text without words has no evidence: its site decides. Every input row comes back. A
    column of the name ``classified`` is replaced.
    """
    host = F.coalesce((F.col("source") if host is None else host).cast("string"), F.lit(""))
    path = F.coalesce((F.col("lang") if path is None else path).cast("string"), F.lit(""))
    model = train(docs, labels, how, key, text)
    sites = materialise(site_rates(docs, labels, model, host, path, how, key, text), "site-rates")
    sites = sites.select(F.struct("host", "path").alias("__site"), F.struct("host_rate", "rate").alias("__rates"))
    joined = (
        docs.withColumn("__site", F.struct(host.alias("host"), path.alias("path")))
        .withColumn("__e", evidence(F.col(text), model))
        .join(broadcast_if_small(sites, 400), "__site", "left")
    )
    rate = F.col("__rates.rate")
    p_bad = 1 / (1 + F.exp(-(F.col("__e") + F.log(rate / (1 - rate)))))
    return joined.withColumn(
        "classified",
        F.struct(
            F.col("__e").alias("evidence"),
            F.col("__rates.host_rate").alias("host_rate"),
            rate.alias("path_rate"),
            p_bad.alias("p_bad"),
            (p_bad < how.threshold).alias("kept"),
        ),
    ).drop("__site", "__e", "__rates")


def keep_good(docs: DataFrame, labels: DataFrame, how: Learning = Learning()) -> DataFrame:
    """Documents that are more likely good than bad, with their own columns."""
    return classify(docs, labels, how=how).where("classified.kept").select(*docs.columns)
