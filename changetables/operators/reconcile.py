"""Comparing replicated tables with their source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def side_by_side_counts(
    source: Mapping[str, DataFrame], target: Mapping[str, DataFrame]
) -> DataFrame:
    """Row counts per table on both sides; null where a side lacks the table."""
    parts = []
    for side, tables in (("source_rows", source), ("target_rows", target)):
        for name, df in tables.items():
            parts.append(
                df.agg(F.count(F.lit(1)).alias("n")).select(
                    F.lit(name).alias("table_name"), F.lit(side).alias("side"), "n"
                )
            )
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    pick = lambda side: F.sum(F.when(F.col("side") == side, F.col("n"))).alias(side)
    return rows.groupBy("table_name").agg(pick("source_rows"), pick("target_rows"))


def compare_counts(source: Mapping[str, DataFrame], target: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts per table with the verdict OK or MISMATCH."""
    same = F.col("source_rows").eqNullSafe(F.col("target_rows"))
    return side_by_side_counts(source, target).withColumn(
        "verdict", F.when(same, "OK").otherwise("MISMATCH")
    )


def missing_tables(source: DataFrame, target: DataFrame, keys: Sequence[str] = ("table_name",)) -> DataFrame:
    """Tables listed in ``source`` but not in ``target``."""
    return source.select(*keys).distinct().join(target.select(*keys).distinct(), list(keys), "left_anti")


def schema_columns(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, data_type) of the given tables."""
    rows = [
        (name, f.name, f.dataType.simpleString()) for name, df in tables.items() for f in df.schema
    ]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")


def missing_columns(source: DataFrame, target: DataFrame) -> DataFrame:
    """Columns listed in ``source`` (table_name, column_name) but not in ``target``."""
    return missing_tables(source, target, ("table_name", "column_name"))


def diff_tables(
    source: DataFrame, target: DataFrame, keys: Sequence[str] | None = None
) -> DataFrame:
    """Rows that differ between two tables.

    Both tables are counted as one signed bag, where equal rows cancel out before
    anything else happens; NULL equals NULL. Without keys each leftover row is
    ``missing`` from or ``extra`` in the target, with its number of ``copies``. With
    keys, one leftover row on either side of the same key is one ``changed`` row that
    names its differing columns; duplicate keys stay missing and extra rows. Returns
    kind, copies, the key columns, changed_columns, source_row and target_row.
    """
    columns = source.columns
    signed = source.withColumn("__n", F.lit(1).cast("long")).unionByName(
        target.withColumn("__n", F.lit(-1).cast("long"))
    )
    leftover = signed.groupBy(*columns).agg(F.sum("__n").alias("n")).filter("n <> 0")
    row = F.struct(*columns)
    in_source = F.col("n") > 0
    lone = leftover.select(
        *(keys or ()),
        F.when(in_source, "missing").otherwise("extra").alias("kind"),
        F.abs("n").alias("copies"),
        F.lit("").alias("changed_columns"),
        F.when(in_source, row).alias("source_row"),
        F.when(~in_source, row).alias("target_row"),
    )
    if not keys:
        return lone
    # one missing and one extra row under a key are two versions of one row
    sides = lone.groupBy(*keys).agg(
        F.sum(F.when(F.col("source_row").isNotNull(), F.col("copies")).otherwise(0)).alias("missing"),
        F.sum(F.when(F.col("target_row").isNotNull(), F.col("copies")).otherwise(0)).alias("extra"),
        F.min("source_row").alias("source_row"),
        F.min("target_row").alias("target_row"),
    )
    is_pair = (F.col("missing") == 1) & (F.col("extra") == 1)
    is_single = (F.col("missing") + F.col("extra")) == 1
    others = [c for c in columns if c not in keys]
    settled = sides.filter(is_pair | is_single).select(
        *keys,
        F.when(is_pair, "changed").when(F.col("missing") == 1, "missing").otherwise("extra").alias("kind"),
        F.lit(1).cast("long").alias("copies"),
        F.when(is_pair, _differing(others)).otherwise("").alias("changed_columns"),
        "source_row",
        "target_row",
    )
    crowded = sides.filter(~(is_pair | is_single)).select(*[F.col(k).alias(f"__{k}") for k in keys])
    same_key = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    )
    several = lone.join(crowded, same_key, "left_semi")
    return settled.unionByName(several.select(*settled.columns))


def _differing(columns: Sequence[str]) -> Column:
    changed = [
        F.when(~F.col(f"source_row.{c}").eqNullSafe(F.col(f"target_row.{c}")), F.lit(c)) for c in columns
    ]
    return F.concat_ws(",", *changed)


def duplicates(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
