"""Quantiles of lags are values that occur, at any number of rows."""

import random

import pytest
from pyspark.sql import functions as F

from changetables.operators import metrics


def _expected(lags):
    ordered = sorted(lags)
    rank = lambda percent: ordered[-(-percent * len(ordered) // 100) - 1]
    return ordered[-1], rank(50), rank(95)


def _found(spark, days, first=1):
    """``days``: the lags of each day in whole milliseconds, from day ``first`` of 1970."""
    rnd = random.Random(3)
    data = [(d * 86_400, ms) for d, lags in enumerate(days, first) for ms in lags]
    rnd.shuffle(data)
    log = spark.createDataFrame(data, "s long, ms long").repartition(8).select(
        F.timestamp_seconds("s").alias("event_ts"), F.timestamp_micros(F.col("s") * 1_000_000 + F.col("ms") * 1000).alias("read_ts")
    )
    found = metrics.lag_quantiles(log, "1 day").orderBy("start").collect()
    return [tuple(None if x is None else round(x * 1000) for x in r[1:]) for r in found]


@pytest.mark.parametrize("wrong_sketch", [False, True])
def test_many_values_few_values_and_copies(spark, monkeypatch, wrong_sketch):
    if wrong_sketch:
        monkeypatch.setattr(metrics.F, "percentile_approx", lambda *_: F.max(F.array(*[F.lit(0.0)] * 4)))
    rnd = random.Random(5)
    days = [
        rnd.sample(range(10_000_000), 60_000),
        [rnd.choice([5, 70, 900]) for _ in range(25_000)],
        list(range(1, 21)),
        [7],
    ]
    assert _found(spark, days) == [_expected(lags) for lags in days]


def test_days_without_lags_and_no_days(spark):
    # header times before 1970 are none, so their events have no lag
    assert _found(spark, [[3, 4], [3, None]], first=-1) == [(None, None, None)] * 2
    assert _found(spark, []) == []
