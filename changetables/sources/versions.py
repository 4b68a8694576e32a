"""Tables published as whole versions: written beside the old one, then recorded.

A version becomes visible with its record, so a reader sees the old or the new table
and a plan may read the version it replaces.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def record(spark: SparkSession, path: str, column: str, value: int) -> None:
    """Append one number to a record folder."""
    row = spark.createDataFrame([(value,)], f"{column} long").coalesce(1)
    row.write.mode("append").json(path)


def last_recorded(spark: SparkSession, path: str, column: str, default: int = -1) -> int:
    """The largest recorded number, ``default`` if there is none."""
    try:
        found = spark.read.schema(f"{column} long").json(path).agg(F.max(column)).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = None
    return default if found is None else found


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet table at ``path``, empty if nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_table(rows: DataFrame, root: str, name: str) -> int:
    """Publish ``rows`` as the next version of a table; returns its number."""
    folder = os.path.join(root, name)
    version = last_recorded(rows.sparkSession, f"{folder}/_versions", "version", 0) + 1
    rows.write.mode("overwrite").parquet(f"{folder}/v={version}")
    record(rows.sparkSession, f"{folder}/_versions", "version", version)
    return version


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A destination table: its last published version, or plain Parquet files."""
    folder = os.path.join(root, name)
    version = last_recorded(spark, f"{folder}/_versions", "version", 0)
    return spark.read.parquet(f"{folder}/v={version}" if version else folder)
