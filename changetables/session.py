"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: str | int = "*", name: str = "changetables", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine.

    On a cluster the session comes from spark-submit; the library itself only
    needs UTC as the session time zone and adaptive execution left on.
    """
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Only a session whose tasks run inside the driver (``local[...]``) may fall back to a
    temporary folder; a local cluster's executors are processes of their own.
    """
    configured = spark.conf.get(_CHECKPOINT_DIR, None)
    if configured:
        return configured
    if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is None:
        raise ValueError(f"set {_CHECKPOINT_DIR} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="changetables-")
    spark.conf.set(_CHECKPOINT_DIR, folder)
    return folder


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the scratch folder and read it back.

    Cuts the lineage of iterative plans. The copy lives on shared storage, so a
    lost executor costs only its running tasks, and the reader knows its size,
    which lets adaptive execution choose the next join by measured bytes. The copy is
    deleted when the driver ends.
    """
    spark = df.sparkSession
    path = os.path.join(scratch_root(spark), "changetables", f"{label}-{uuid.uuid4().hex}")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of the library's own."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def fits(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows, stopping at one more."""
    return df.limit(max_rows + 1).count() <= max_rows
