"""The progress ledger: saved positions, one per source."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changetables.functions.text import blank_to_null
from changetables.schema import LEDGER_SCHEMA

#: Written with each stored record: how many writes came before it.
_SEQUENCE = "sequence"
_STORED = T.StructType([*LEDGER_SCHEMA.fields, T.StructField(_SEQUENCE, T.LongType())])


def load_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Last written record of every source; an absent ledger is an empty one.

    A record that is not whole fails the read: a source that silently starts anew would
    apply its log twice. The zero time reads as none.
    """
    try:
        saved = spark.read.schema(_STORED).option("mode", "FAILFAST").json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)
    saved = saved.fillna({"gtid_set": "", "binlog_file": "", "binlog_pos": 0, "server_id": 0, _SEQUENCE: 0})
    saved = saved.withColumn("updated_at", F.when(F.year("updated_at") > 1, F.col("updated_at")))
    last = F.max_by(F.struct(*LEDGER_SCHEMA.names), F.struct(_SEQUENCE, "version"))
    return saved.groupBy("source_id").agg(last.alias("r")).select("r.*")


def load_checkpoint(spark: SparkSession, path: str, source_id: str) -> DataFrame:
    """The saved record of one source, no row if there is none."""
    return load_ledger(spark, path).filter(F.col("source_id") == source_id)


def latest_records(records: DataFrame) -> DataFrame:
    """The record with the highest version of every source."""
    return (
        records.groupBy("source_id")
        .agg(F.max_by(F.struct(*records.columns), "version").alias("r"))
        .select("r.*")
    )


def save_checkpoint(ledger: DataFrame, updates: DataFrame) -> DataFrame:
    """The ledger after an upsert: an update replaces its source's whole record."""
    rows = ledger.withColumn("__new", F.lit(0)).unionByName(updates.withColumn("__new", F.lit(1)))
    return (
        rows.groupBy("source_id")
        .agg(F.max_by(F.struct(*ledger.columns), F.struct("__new", "version")).alias("r"))
        .select("r.*")
    )


def write_checkpoints(updates: DataFrame, path: str) -> None:
    """Append records to the ledger folder; readers take each source's last write.

    Appending never rewrites a saved record, and Spark's commit publishes a whole
    write or nothing. Writes are numbered, so a source that starts again from version 0
    replaces what an earlier run saved. A ledger has one writer at a time.
    """
    spark = updates.sparkSession
    try:
        before = spark.read.schema(f"{_SEQUENCE} long").json(path).agg(F.max(_SEQUENCE)).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        before = None
    body = F.regexp_replace("json", r"\}\z", f',"{_SEQUENCE}":{(before or 0) + 1}' + "}")
    checkpoints_to_json(updates).select(body.alias("json")).write.mode("append").text(path)


def checkpoints_to_json(records: DataFrame) -> DataFrame:
    """(source_id, json): empty set, file, position and server id are left out."""
    fields = F.struct(
        F.coalesce("source_id", F.lit("")).alias("source_id"),
        F.coalesce("flavor", F.lit("")).alias("flavor"),
        F.coalesce("mode", F.lit("")).alias("mode"),
        blank_to_null(F.col("gtid_set")).alias("gtid_set"),
        blank_to_null(F.col("binlog_file")).alias("binlog_file"),
        F.nullif(F.col("binlog_pos"), F.lit(0)).alias("binlog_pos"),
        F.nullif(F.col("server_id"), F.lit(0)).alias("server_id"),
        F.coalesce(
            F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("0001-01-01T00:00:00Z")
        ).alias("updated_at"),
        F.coalesce("version", F.lit(0)).cast("long").alias("version"),
    )
    return records.select("source_id", F.to_json(fields, {"ignoreNullFields": "true"}).alias("json"))
