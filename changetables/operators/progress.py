"""Saved positions: when they are written and how a run resumes from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changetables.functions.gtid import FLAVORS, flavor_or_default, gtid_intervals
from changetables.functions.text import blank_to_null, trim_space
from changetables.plans.asof import SMALL_LOOKUP
from changetables.plans.scan import Scan, segmented_scan
from changetables.schema import (
    SEGMENT_BYTES,
    before_all,
    event_key,
    segment_before_all,
    segment_key,
)
from changetables.session import fits
from changetables.sources.changelog import outside_by_scan

#: Events per checkpoint, and the largest position a log file can have.
DEFAULT_EVERY = 100
MAX_POSITION = 4294967295


def running_position(
    log: DataFrame, start: DataFrame | None = None, segment_bytes: int = SEGMENT_BYTES
) -> DataFrame:
    """Every event with the position a checkpoint taken after it would save.

    Adds ``n`` (the event's number in its source), ``binlog_file``, ``binlog_pos``,
    ``gtid_set_saved`` and the ``base_*`` fields of the source's ``start`` record. An
    empty field of an event keeps the last value, so does a position of 0. A source
    may hold the whole log; it is numbered and scanned by segments.
    """
    events = log.select(
        "*",
        event_key().alias("__at"),
        segment_key(segment_bytes).alias("__segment"),
        F.lit(1).cast("long").alias("__event"),
        blank_to_null(F.col("gtid_set")).alias("__set"),
        blank_to_null(F.col("file")).alias("__file"),
        F.when(F.col("end_pos") > 0, F.col("end_pos")).alias("__pos"),
    )
    fields = ("flavor", "mode", "server_id", "version")
    if start is not None:
        events = events.unionByName(
            start.select(
                "source_id",
                before_all().alias("__at"),
                segment_before_all().alias("__segment"),
                F.lit(0).cast("long").alias("__event"),
                blank_to_null(F.col("gtid_set")).alias("__set"),
                blank_to_null(F.col("binlog_file")).alias("__file"),
                F.when(F.col("binlog_pos") > 0, F.col("binlog_pos")).alias("__pos"),
                F.struct(*fields).alias("__base"),
            ),
            allowMissingColumns=True,
        )
    else:
        kind = "struct<flavor:string,mode:string,server_id:bigint,version:bigint>"
        events = events.withColumn("__base", F.lit(None).cast(kind))
    moved = F.coalesce("__set", "__file", F.col("__pos").cast("string")).isNotNull()
    scans = [
        Scan("n", "sum", F.col("__event")),
        Scan("gtid_set_saved", "last", F.col("__set")),
        Scan("binlog_file", "last", F.col("__file")),
        Scan("binlog_pos", "last", F.col("__pos")),
        Scan("__start", "last", F.col("__base")),
    ]
    scanned = segmented_scan(events, ["source_id"], ["__at"], "__segment", scans)
    return scanned.filter("__event = 1").select(
        *log.columns,
        "n",
        "binlog_file",
        "binlog_pos",
        "gtid_set_saved",
        moved.alias("moved"),
        *[F.col(f"__start.{f}").alias(f"base_{f}") for f in fields],
    )


def checkpoints(
    log: DataFrame,
    every: int = DEFAULT_EVERY,
    start: DataFrame | None = None,
    final_flush: bool = True,
    saved_at: str = "event_ts",
    segment_bytes: int = SEGMENT_BYTES,
) -> DataFrame:
    """The checkpoint records written while ``log`` is applied.

    One after every ``every`` events of a source, whatever their kind, and a last one
    if the position moved since. Versions count on from the ``start`` record's.
    Returns the ledger fields, ``n`` and ``reason`` (interval or final).
    """
    every = max(every, 1)
    marked = running_position(log, start, segment_bytes)
    regular = marked.filter(F.col("n") % every == 0).withColumn("reason", F.lit("interval"))
    emitted = regular
    if final_flush:
        kept = ("binlog_file", "binlog_pos", "gtid_set_saved", "base_flavor", "base_mode", "base_server_id", "base_version")
        row = F.struct("source_id", "n", saved_at, *kept)
        last = (
            marked.groupBy("source_id")
            .agg(
                F.max_by(row, "n").alias("r"),
                F.max(F.when(F.col("moved"), F.col("n"))).alias("last_moved"),
            )
            .filter(F.col("last_moved") > F.floor(F.col("r.n") / F.lit(every)) * every)
            .select("r.*", F.lit("final").alias("reason"))
        )
        emitted = regular.unionByName(last, allowMissingColumns=True)
    saves = F.ceil(F.col("n") / F.lit(every))
    return emitted.select(
        "source_id",
        F.col("base_flavor").alias("flavor"),
        F.col("base_mode").alias("mode"),
        F.coalesce("gtid_set_saved", F.lit("")).alias("gtid_set"),
        F.coalesce("binlog_file", F.lit("")).alias("binlog_file"),
        F.coalesce("binlog_pos", F.lit(0)).cast("long").alias("binlog_pos"),
        F.col("base_server_id").alias("server_id"),
        F.col(saved_at).alias("updated_at"),
        (F.coalesce("base_version", F.lit(0)) + saves).cast("long").alias("version"),
        "n",
        "reason",
    )


def source_key(host: Column, port: Column, server_id: Column) -> Column:
    """``host:port#server``, with ``unknown`` for a blank host."""
    name = F.coalesce(blank_to_null(trim_space(F.coalesce(host, F.lit("")))), F.lit("unknown"))
    whole = lambda c: F.coalesce(c.cast("long"), F.lit(0))
    return F.format_string("%s:%d#%d", name, whole(port), whole(server_id))


def resume_plan(ledger: DataFrame, configs: DataFrame) -> DataFrame:
    """Where each configured source starts, from its saved record if that is valid.

    ``configs``: source_id (may be blank), host, port, server_id, flavor,
    gtid_enabled, gtid_set, binlog_file, binlog_pos. A valid record overrides the
    configured start; an invalid one is ignored and named in ``warning``. Returns the
    base record of the run (the ledger fields), ``resumed`` and ``warning``.
    """
    explicit = blank_to_null(trim_space(F.coalesce("source_id", F.lit(""))))
    config = configs.select(
        F.coalesce(explicit, source_key(F.col("host"), F.col("port"), F.col("server_id"))).alias("source_id"),
        flavor_or_default(F.col("flavor")).alias("c_flavor"),
        F.when(F.col("gtid_enabled"), "gtid").otherwise("pos").alias("c_mode"),
        F.coalesce("gtid_set", F.lit("")).alias("c_gtid_set"),
        F.coalesce("binlog_file", F.lit("")).alias("c_binlog_file"),
        F.coalesce("binlog_pos", F.lit(0)).cast("long").alias("c_binlog_pos"),
        F.col("server_id").cast("long").alias("c_server_id"),
    )
    saved = ledger.select("source_id", F.struct(*[c for c in ledger.columns if c != "source_id"]).alias("s"))
    plan = config.join(saved, "source_id", "left")
    s = lambda name: F.col(f"s.{name}")
    is_blank = lambda c: trim_space(F.coalesce(c, F.lit(""))) == ""
    mode = F.lower(F.coalesce(s("mode"), F.lit("")))
    pos = F.coalesce(s("binlog_pos"), F.lit(0))
    warning = F.when(
        F.col("s").isNotNull(),
        F.when((mode == "gtid") & is_blank(s("gtid_set")), "gtid_set_empty")
        .when((mode == "pos") & (is_blank(s("binlog_file")) | (pos <= 0)), "position_empty")
        .when((mode == "pos") & (pos > MAX_POSITION), "position_overflow")
        .when(~mode.isin("gtid", "pos"), "mode_invalid"),
    )
    resumed = F.col("s").isNotNull() & warning.isNull()

    def either(name: str, missing: Column) -> Column:
        return F.when(resumed & ~missing, s(name)).otherwise(F.col(f"c_{name}")).alias(name)

    base_mode = F.when(resumed, s("mode")).otherwise(F.col("c_mode"))
    return plan.select(
        "source_id",
        either("flavor", is_blank(s("flavor"))),
        base_mode.alias("mode"),
        F.when(resumed & ((mode != "gtid") | (s("gtid_set") != "")), F.coalesce(s("gtid_set"), F.lit("")))
        .otherwise(F.col("c_gtid_set"))
        .alias("gtid_set"),
        F.when(resumed, F.coalesce(s("binlog_file"), F.lit("")))
        .otherwise(F.col("c_binlog_file"))
        .alias("binlog_file"),
        F.when(resumed, pos).otherwise(F.col("c_binlog_pos")).alias("binlog_pos"),
        either("server_id", F.coalesce(s("server_id"), F.lit(0)) == 0),
        F.when(resumed, s("updated_at")).alias("updated_at"),
        F.when(resumed, F.coalesce(s("version"), F.lit(0))).otherwise(F.lit(0)).cast("long").alias("version"),
        resumed.alias("resumed"),
        warning.alias("warning"),
    )


def resume_log(log: DataFrame, plan: DataFrame) -> DataFrame:
    """Events of every source of the plan that lie after its planned start.

    A source planned by file position is compared with it; one planned by transaction
    set keeps the events outside its own set, found by one segmented scan for all such
    sources. A plan counted to be small is broadcast, so the log is not shuffled by its
    sources. A mode that is neither raises.
    """
    mode = F.lower(trim_space(F.col("mode")))
    known = F.raise_error(F.concat(F.lit("unknown resume mode "), F.coalesce("mode", F.lit("null"))))
    plan = plan.withColumn("__mode", F.when(mode.isin("pos", "gtid"), mode).otherwise(known))
    seq = F.regexp_extract("binlog_file", r"(\d+)\z", 1).try_cast("long")
    starts = plan.select("source_id", "__mode", seq.alias("__seq"), F.col("binlog_pos").alias("__from"))
    if fits(starts, SMALL_LOOKUP):
        starts = F.broadcast(starts)
    joined = log.join(starts, "source_id")
    later = (
        F.col("__seq").isNull()
        | (F.col("file_seq") > F.col("__seq"))
        | ((F.col("file_seq") == F.col("__seq")) & (F.col("end_pos") > F.col("__from")))
    )
    by_position = joined.filter((F.col("__mode") == "pos") & later).select(*log.columns)
    if "gtid_set" not in plan.columns:
        return by_position
    sets = plan.filter("__mode = 'gtid'")
    flavor = flavor_or_default(F.col("flavor")) if "flavor" in plan.columns else F.lit("mysql")
    intervals = [gtid_intervals(sets.filter(flavor == name).select("source_id", "gtid_set"), "gtid_set", name) for name in FLAVORS]
    by_set = joined.filter(F.col("__mode") == "gtid").select(*log.columns)
    rest = outside_by_scan(by_set, intervals[0].unionByName(intervals[1]), ["source_id", "gtid_source"])
    return by_position.unionByName(rest)
