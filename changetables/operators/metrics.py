"""Counters, gauges and histograms over the event log.

All of them are aggregates with few groups, so each task sends a handful of partial
rows. Metric names can be prefixed to fit existing dashboards.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changetables.functions.events import event_type_label, is_skipped_query, lag_seconds
from changetables.functions.rows import explode_present
from changetables.functions.text import label_or_unknown
from changetables.plans.asof import SMALL_LOOKUP
from changetables.session import fits, materialise

# Default bounds of the duration histogram, in seconds.
BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)


def events_read(log: DataFrame) -> DataFrame:
    """Events by header type."""
    return log.groupBy(event_type_label(F.col("event_type")).alias("event_type")).agg(
        F.count(F.lit(1)).alias("events")
    )


def is_filtered(allowed: Column) -> Column:
    """The event reached the table filter and was dropped there.

    Row events without a table fail before the filter; blank queries and transaction
    control are skipped before it.
    """
    named = (F.coalesce("schema_name", F.lit("")) != "") & (F.coalesce("table_name", F.lit("")) != "")
    reaches = F.when(F.col("kind") == "rows", named).when(
        F.col("kind") == "query", ~is_skipped_query(F.col("query"))
    )
    return F.coalesce(reaches & ~allowed, F.lit(False))


def events_filtered(log: DataFrame, allowed: Column) -> DataFrame:
    """Filtered events by kind, ``rows`` or ``query``."""
    return (
        log.filter(is_filtered(allowed))
        .groupBy("kind")
        .agg(F.count(F.lit(1)).alias("events"))
    )


def events_applied(log: DataFrame, allowed: Column | None = None) -> DataFrame:
    """Applied events by label; ``effective`` leaves out those that changed nothing.

    Filtered events, transaction control and unsupported row operations count as
    applied. Events with an ``error`` do not.
    """
    allowed = F.lit(True) if allowed is None else allowed
    idle = (
        is_filtered(allowed)
        | ((F.col("kind") == "query") & is_skipped_query(F.col("query")))
        | ((F.col("kind") == "rows") & (F.col("label") == "rows_unknown"))
    )
    done = log.filter("label is not null and error is null")
    return done.groupBy(F.col("label").alias("event_type")).agg(
        F.count(F.lit(1)).alias("applied"), F.count_if(~idle).alias("effective")
    )


def error_stages(error_stage: Column, kind: Column) -> Column:
    """Stages an apply error is counted under.

    A failing statement counts as ``exec`` and as its event's kind; an error found
    before anything runs counts as the kind only; a failed save as ``state``.
    """
    return (
        F.when(error_stage == "exec", F.array(F.lit("exec"), kind))
        .when(error_stage == "bind", F.array(kind))
        .when(error_stage == "state", F.array(F.lit("state")))
    )


def apply_errors(audit: DataFrame) -> DataFrame:
    """Apply errors by stage: rows, query, exec, state."""
    return (
        audit.select(F.explode(error_stages(F.col("error_stage"), F.col("kind"))).alias("stage"))
        .groupBy("stage")
        .agg(F.count(F.lit(1)).alias("errors"))
    )


def read_errors(audit: DataFrame) -> DataFrame:
    return audit.agg(F.count_if(F.col("error_stage") == "read").alias("errors"))


def pipeline_up(audit: DataFrame) -> DataFrame:
    """1 if the last lifecycle row of a pipeline is a start, 0 if it is a stop."""
    return (
        audit.filter("up is not null")
        .groupBy("source_id")
        .agg(F.max_by(F.col("up").cast("int"), "ts").alias("up"))
    )


def _durations(audit: DataFrame, bounds: Sequence[float]) -> DataFrame:
    """One row per label: how many durations are within each bound, sum and count."""
    seconds = F.col("seconds")
    return (
        audit.filter("label is not null and seconds is not null")
        .groupBy(label_or_unknown(F.col("label")).alias("event_type"))
        .agg(
            *[F.count_if(seconds <= bound).alias(f"le_{i}") for i, bound in enumerate(bounds)],
            F.count(F.lit(1)).alias("count"),
            F.sum(seconds).alias("sum"),
        )
    )


def _buckets(bounds: Sequence[float]) -> list[tuple[str, str]]:
    """(le, column of ``_durations``) of every bucket."""
    return [*((_bound_text(b), f"le_{i}") for i, b in enumerate(bounds)), ("+Inf", "count")]


def duration_histogram(audit: DataFrame, bounds: Sequence[float] = BUCKETS) -> DataFrame:
    """Apply durations by label: cumulative counts per upper bound, sum and count.

    One row per label and bound; the last bound, ``+Inf``, holds the count.
    """
    buckets = [F.struct(F.lit(le).alias("le"), F.col(c).alias("events")) for le, c in _buckets(bounds)]
    return (
        _durations(audit, bounds)
        .select("event_type", "sum", "count", F.explode(F.array(*buckets)).alias("b"))
        .select("event_type", "b.le", "b.events", "sum", "count")
    )


def _bound_text(bound: float) -> str:
    return f"{bound:g}"


def current_lag(log: DataFrame, read_ts: str = "read_ts") -> DataFrame:
    """Lag of the last event that carries a header time."""
    lag = lag_seconds(F.col(read_ts), F.col("event_ts"))
    at = F.when(lag.isNotNull(), F.struct("file_seq", "pos"))
    return log.groupBy("source_id").agg(F.max_by(lag, at).alias("lag_seconds"))


#: Relative rank error of the sketch that finds where a quantile lies.
SKETCH_ERROR = 1e-4


def lag_quantiles(log: DataFrame, window: str = "1 hour", read_ts: str = "read_ts") -> DataFrame:
    """Lag per time window: largest, median and 95th percentile, each a value that occurs.

    A mergeable sketch gives bounds on both sides of each quantile; rows below are counted
    and only values between the bounds are ranked, so no task holds a window's values. A
    window whose sketch was wrong, as the counts tell, has all its values ranked.
    """
    shares = {"lag_p50": Decimal("0.5"), "lag_p95": Decimal("0.95")}
    lags = log.select(
        F.window("event_ts", window).alias("w"), lag_seconds(F.col(read_ts), F.col("event_ts")).alias("lag")
    ).filter("w is not null")
    margin = 2 * SKETCH_ERROR
    places = [min(1.0, max(0.0, float(q) + d)) for q in shares.values() for d in (-margin, margin)]
    sketch = F.percentile_approx("lag", F.array(*map(F.lit, places)), F.lit(int(1 / SKETCH_ERROR)))
    found = lags.groupBy("w").agg(F.max("lag").alias("lag_max"), F.count("lag").alias("__n"), sketch.alias("__q"))
    found = materialise(found, "lags")

    bounds = found.select(F.col("w").alias("__w"), "__n", "__q")
    if fits(bounds, SMALL_LOOKUP):
        bounds = F.broadcast(bounds)
    placed = lags.join(bounds, F.col("w") == F.col("__w"))
    sides = {c: (F.col("__q")[2 * i], F.col("__q")[2 * i + 1]) for i, c in enumerate(shares)}
    below = [F.count(F.when(F.col("lag") < lo, 1)).alias(f"__below_{c}") for c, (lo, _) in sides.items()]
    upto = [F.count(F.when(F.col("lag") <= hi, 1)).alias(f"__upto_{c}") for c, (_, hi) in sides.items()]
    ranks = [F.ceil(F.lit(q) * F.col("__n")).cast("long").alias(f"__rank_{c}") for c, q in shares.items()]
    counts = materialise(placed.groupBy("w").agg(*below, *upto).join(found, "w").select("*", *ranks), "lag_counts")

    known = counts.select(F.col("w").alias("__w"), *[c for c in counts.columns if c.startswith("__")])
    if fits(known, SMALL_LOOKUP):
        known = F.broadcast(known)
    near = lags.filter("lag is not null").join(known, F.col("w") == F.col("__w"))
    parts = []
    for c, (lo, hi) in sides.items():
        rank, first = F.col(f"__rank_{c}"), F.col(f"__below_{c}")
        is_sure = (first < rank) & (rank <= F.col(f"__upto_{c}"))
        inside = near.filter(~is_sure | F.col("lag").between(lo, hi))
        start = F.when(is_sure, first).otherwise(0)
        values = inside.groupBy("w", "lag").agg(F.count(F.lit(1)).alias("__copies"), F.first(rank - start).alias("__left"))
        upto_here = F.sum("__copies").over(Window.partitionBy("w").orderBy("lag"))
        reached = values.withColumn("__upto", upto_here).filter("__upto >= __left")
        parts.append(reached.groupBy("w").agg(F.min("lag").alias(c)))
    out = reduce(lambda a, b: a.join(b, "w", "left"), parts, found.select("w", "lag_max"))
    return out.select("w.start", "lag_max", *shares)


def checkpoint_results(audit: DataFrame) -> DataFrame:
    """Checkpoint attempts by result."""
    return (
        audit.filter("checkpoint_result is not null")
        .groupBy(label_or_unknown(F.col("checkpoint_result")).alias("result"))
        .agg(F.count(F.lit(1)).alias("checkpoints"))
    )


def last_checkpoint(audit: DataFrame) -> DataFrame:
    """Unix time of the last successful checkpoint, null if there was none."""
    done = F.when(F.col("checkpoint_result") == "success", F.col("ts"))
    return audit.groupBy("source_id").agg(
        F.floor(F.unix_micros(F.max(done)) / F.lit(1_000_000)).alias("last_checkpoint")
    )


# The names of the metrics.
EVENTS_READ = "binlog_events_read_total"
READ_ERRORS = "binlog_read_errors_total"
EVENTS_FILTERED = "events_filtered_total"
EVENTS_APPLIED = "events_applied_total"
APPLY_ERRORS = "event_apply_errors_total"
CHECKPOINTS = "state_checkpoint_total"
APPLY_SECONDS = "event_apply_duration_seconds"
WORKER_UP = "worker_up"
LAG_SECONDS = "replication_lag_seconds"
LAST_CHECKPOINT = "state_last_checkpoint_timestamp_seconds"


def _samples(rows: DataFrame, samples: Sequence[tuple[str, Column, str]]) -> DataFrame:
    """(metric, label, value) for each (metric, label, column) of every row; none for null."""
    made = [
        F.struct(F.lit(metric).alias("metric"), label.alias("label"), F.col(column).cast("double").alias("value"))
        for metric, label, column in samples
    ]
    return rows.select(F.explode(F.array(*made)).alias("s")).select("s.*").filter("value is not null")


def metrics_snapshot(
    audit: DataFrame, allowed: Column | None = None, prefix: str = "", bounds: Sequence[float] = BUCKETS
) -> DataFrame:
    """All ten metrics as one long table (metric, label, value).

    ``audit`` is the classified event log plus lifecycle and checkpoint rows (columns
    source_id, ts, file_seq, pos, event_ts, event_type, kind, label, op, schema_name,
    table_name, query, error, error_stage, seconds, checkpoint_result, up). The log is
    read three times: for counters, for gauges by source and for the histogram, whose
    buckets' labels read ``event_type|le``.
    """
    allowed = F.lit(True) if allowed is None else allowed
    none = F.lit("")
    one = lambda when, metric, label: F.when(
        when, F.struct(F.lit(metric).alias("metric"), label.alias("label"))
    )
    is_event = F.col("event_type").isNotNull()
    applied = F.col("label").isNotNull() & F.col("error").isNull() & F.col("error_stage").isNull()
    failed, errors = F.col("error_stage"), APPLY_ERRORS
    hits = [
        one(is_event, EVENTS_READ, event_type_label(F.col("event_type"))),
        one(failed == "read", READ_ERRORS, none),
        one(is_event & is_filtered(allowed), EVENTS_FILTERED, label_or_unknown(F.col("kind"))),
        one(applied, EVENTS_APPLIED, F.col("label")),
        one(failed == "exec", errors, F.lit("exec")),
        one(failed.isin("exec", "bind"), errors, label_or_unknown(F.col("kind"))),
        one(failed == "state", errors, F.lit("state")),
        one(
            F.col("checkpoint_result").isNotNull(),
            CHECKPOINTS,
            label_or_unknown(F.col("checkpoint_result")),
        ),
    ]
    counters = (
        explode_present(audit, [], hits, "h")
        .groupBy("h.metric", "h.label")
        .agg(F.count(F.lit(1)).cast("double").alias("value"))
    )
    lag = lag_seconds(F.col("ts"), F.col("event_ts"))
    done = F.when(F.col("checkpoint_result") == "success", F.col("ts"))
    gauges = audit.groupBy("source_id").agg(
        F.max_by(F.col("up").cast("int"), F.when(F.col("up").isNotNull(), F.col("ts"))).alias("up"),
        F.max_by(lag, F.when(lag.isNotNull(), F.struct("file_seq", "pos"))).alias("lag"),
        F.floor(F.unix_micros(F.max(done)) / F.lit(1_000_000)).alias("done"),
    )
    source, label = F.col("source_id"), F.col("event_type")
    buckets = [(f"{APPLY_SECONDS}_bucket", F.concat_ws("|", label, F.lit(le)), c) for le, c in _buckets(bounds)]
    parts = [
        counters,
        _samples(gauges, [(WORKER_UP, source, "up"), (LAG_SECONDS, source, "lag"), (LAST_CHECKPOINT, source, "done")]),
        _samples(
            _durations(audit, bounds),
            [*buckets, (f"{APPLY_SECONDS}_sum", label, "sum"), (f"{APPLY_SECONDS}_count", label, "count")],
        ),
    ]
    table = reduce(lambda a, b: a.unionByName(b), parts)
    return table.withColumn("metric", F.concat(F.lit(prefix), F.col("metric")))


def alerts(
    audit: DataFrame,
    window: str = "1 hour",
    slo_seconds: float = 60.0,
    read_ts: str = "ts",
) -> DataFrame:
    """Alert flags per source and time window.

    down (the last lifecycle row says stopped), more read or apply errors than in the
    window before, lag above the objective throughout, no successful checkpoint.
    Windows per source are few, so comparing neighbours is cheap.
    """
    lag = lag_seconds(F.col(read_ts), F.col("event_ts"))
    per_window = audit.groupBy("source_id", F.window("ts", window).alias("w")).agg(
        F.max_by("up", F.when(F.col("up").isNotNull(), F.col("ts"))).alias("up"),
        F.count_if(F.col("error_stage") == "read").alias("read_errors"),
        F.count_if(F.col("error_stage").isin("exec", "bind", "state")).alias("apply_errors"),
        F.min(lag).alias("lag_min"),
        F.count_if(F.col("checkpoint_result") == "success").alias("checkpoints"),
    )
    along = Window.partitionBy("source_id").orderBy("w.start")
    rose = lambda c: F.col(c) > F.coalesce(F.lag(c).over(along), F.lit(0))
    return per_window.select(
        "source_id",
        F.col("w.start").alias("window_start"),
        F.coalesce(F.last("up", ignorenulls=True).over(along) == 0, F.lit(False)).alias("down"),
        rose("read_errors").alias("read_errors_rise"),
        rose("apply_errors").alias("apply_errors_rise"),
        F.coalesce(F.col("lag_min") > slo_seconds, F.lit(False)).alias("lag_over_slo"),
        (F.col("checkpoints") == 0).alias("no_checkpoint"),
    )


def observe_events(log: DataFrame, name: str = "events") -> DataFrame:
    """Live counters on a running query, reported with every micro-batch."""
    return log.observe(
        name,
        F.count(F.lit(1)).alias("read"),
        F.count_if(F.col("kind") == "rows").alias("rows"),
        F.count_if(F.col("kind") == "query").alias("query"),
    )
