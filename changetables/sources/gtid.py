"""Sets of executed transactions gathered from a log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changetables.functions.gtid import interval_text, normalise_flavor

#: Transaction numbers per bucket when looking for gaps.
SEQ_BUCKET = 1_000_000


def carried_gtid_set(kind: Column, gtid_set: Column) -> Column:
    """The executed set an event reports: only query and xid events carry one."""
    return F.when(kind.isin("query", "xid"), F.coalesce(gtid_set, F.lit(""))).otherwise("")


def gtid_set_total(
    log: DataFrame, flavor: str | None = "mysql", bucket: int = SEQ_BUCKET
) -> DataFrame:
    """Intervals (gtid_source, lo, hi) of all transaction numbers in ``log``.

    mysql: gaps are looked for inside buckets of the number range. Only runs that
    touch a bucket's border (two per bucket at most) are then merged per source, so
    neither one source nor one huge transaction ends up in one task.
    mariadb: the last number of each domain stands for all before it.
    """
    if normalise_flavor(flavor) == "mariadb":
        return (
            log.filter("gtid_source is not null and gtid_seq is not null")
            .groupBy("gtid_source")
            .agg(F.lit(1).cast("long").alias("lo"), F.max("gtid_seq").alias("hi"))
        )
    numbers = (
        log.filter("gtid_source is not null and gtid_seq is not null")
        .select("gtid_source", "gtid_seq")
        .distinct()
        .withColumn("bucket", F.expr(f"gtid_seq div {int(bucket)}"))
    )
    inside = Window.partitionBy("gtid_source", "bucket").orderBy("gtid_seq")
    runs = (
        numbers.withColumn("run", F.col("gtid_seq") - F.row_number().over(inside))
        .groupBy("gtid_source", "bucket", "run")
        .agg(F.min("gtid_seq").alias("lo"), F.max("gtid_seq").alias("hi"))
    )
    first = F.col("bucket") * F.lit(bucket)
    at_border = (F.col("lo") == first) | (F.col("hi") == first + F.lit(bucket - 1))
    inner = runs.filter(~at_border).select("gtid_source", "lo", "hi")
    along = Window.partitionBy("gtid_source").orderBy("lo")
    joined = (
        runs.filter(at_border)
        .withColumn("starts", F.coalesce(F.lag("hi").over(along) + 1 != F.col("lo"), F.lit(True)))
        .withColumn("run", F.sum(F.col("starts").cast("int")).over(along))
        .groupBy("gtid_source", "run")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .select("gtid_source", "lo", "hi")
    )
    return inner.unionByName(joined)


def gtid_set_asof(
    log: DataFrame, file_seq: int, pos: int, flavor: str | None = "mysql"
) -> DataFrame:
    """The executed set once every event up to a position was applied."""
    upto = (F.col("file_seq") < file_seq) | (
        (F.col("file_seq") == file_seq) & (F.col("pos") <= pos)
    )
    return gtid_set_total(log.filter(upto), flavor)


def gtid_set_text(intervals: DataFrame, server: Column | None = None) -> DataFrame:
    """One text per source, ``source:1-5:7``, the form a restart takes.

    The text of a source is one value by nature; keep the intervals where a source
    may have very many gaps. With ``server`` the mariadb form is written.
    """
    if server is not None:
        text = F.concat_ws("-", "gtid_source", server, "hi")
        return intervals.select("gtid_source", text.alias("gtid_set"))
    runs = F.array_sort(F.collect_list(F.struct("lo", "hi")))
    return intervals.groupBy("gtid_source").agg(runs.alias("runs")).select(
        "gtid_source",
        F.concat_ws(
            ":", "gtid_source", F.transform("runs", lambda r: interval_text(r["lo"], r["hi"]))
        ).alias("gtid_set"),
    )
