"""Time replay with and without one key that holds more than half of the log.

The line items of BENCH_SF_DIR become updates, once spread over their order keys and
once with all items of low tax moved to one key.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

import changetables as ct
from changetables.session import local_session


def log(spark, sf_dir: str, hot: bool):
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    key = F.when(F.col("l_tax") < 0.05, -1).otherwise(F.col("l_orderkey")) if hot else F.col("l_orderkey")
    keyed = items.withColumn("k", key.cast("long"))
    image = lambda v: F.struct(F.col("k"), v.alias("v"))
    return keyed.select(
        (F.year("l_shipdate") * 100 + F.month("l_shipdate")).cast("long").alias("file_seq"),
        (F.dayofmonth("l_shipdate") * 10_000_000 + F.col("l_partkey") * 100 + F.col("l_suppkey") % 100).alias("pos"),
        F.hash("l_orderkey", "l_linenumber", "l_extendedprice").alias("ordinal"),
        F.when(F.col("l_linenumber") == 1, "insert").otherwise("update").alias("op"),
        F.when(F.col("l_linenumber") > 1, image(F.col("l_linenumber") - 1)).alias("before"),
        image(F.col("l_linenumber")).alias("after"),
    )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "*"), "bench-skew")
    limits = dict(segment_bytes=64 * 1024 * 1024, hot_rows=20_000)
    runs = {
        "latest_by_key": lambda df: ct.latest_by_key(df, ["k"]),
        "history": lambda df: ct.history(df, ["k"], **limits),
        "replay": lambda df: ct.replay(df, **limits),
    }
    seconds = {}
    for name, run in runs.items():
        for hot in (False, True, False, True):
            start = time.perf_counter()
            run(log(spark, sf_dir, hot)).write.format("noop").mode("overwrite").save()
            seconds[f"{name}_{'hot' if hot else 'even'}"] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "skew check", "unit": "sec", "queries": seconds}))


if __name__ == "__main__":
    main()
