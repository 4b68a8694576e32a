import pytest
import datetime as dt
import json

from pyspark.sql import functions as F

import changetables as ct
from changetables.functions import times
from changetables.operators import metrics
from changetables.schema import LEDGER_SCHEMA
from changetables.sources import ledger as ledgers
from helpers import rows

LOG = (
    "source_id string, file string, file_seq long, pos long, end_pos long, gtid_set string, event_ts timestamp, "
    "event_type string"
)
T0 = dt.datetime(2024, 1, 1)


def log(spark, entries, source="s"):
    data = [
        (source, file, 1, i, end, gtid, T0 + dt.timedelta(seconds=i), "QueryEvent")
        for i, (file, end, gtid) in enumerate(entries, 1)
    ]
    return spark.createDataFrame(data, LOG)


def test_empty_fields_keep_the_last_value(spark):
    df = log(spark, [("f1", 10, "a"), ("", 0, ""), ("f2", 20, None), (None, 30, "b")])
    got = ct.running_position(df, segment_bytes=2)
    assert rows(got.select("n", "binlog_file", "binlog_pos", "gtid_set_saved")) == [
        (1, "f1", 10, "a"), (2, "f1", 10, "a"), (3, "f2", 20, "a"), (4, "f2", 30, "b"),
    ]


def test_interval_and_final_checkpoint(spark):
    df = log(spark, [("f1", i * 10, None) for i in range(1, 6)])
    got = ct.checkpoints(df, 2, segment_bytes=2).select("n", "version", "binlog_pos", "reason")
    assert rows(got) == [(2, 1, 20, "interval"), (4, 2, 40, "interval"), (5, 3, 50, "final")]
    assert ct.checkpoints(df, 2, final_flush=False).count() == 2
    assert ct.checkpoints(df, -1).count() == 5


def test_final_checkpoint_only_if_something_moved(spark):
    df = log(spark, [("f1", 10, None), ("f1", 20, None), ("", 0, "")])
    assert rows(ct.checkpoints(df, 2).select("n", "reason")) == [(2, "interval")]
    idle = log(spark, [("", 0, "")])
    assert ct.checkpoints(idle, 5).isEmpty()


def test_versions_count_on_from_the_saved_record(spark):
    start = spark.createDataFrame([("s", "mysql", "gtid", "old", "f0", 4, 9, T0, 7)], LEDGER_SCHEMA)
    got = ct.checkpoints(log(spark, [("", 0, ""), ("f1", 5, None)]), 1, start, segment_bytes=1)
    fields = ("version", "mode", "gtid_set", "binlog_file", "binlog_pos", "server_id")
    assert rows(got.select(*fields)) == [(8, "gtid", "old", "f0", 4, 9), (9, "gtid", "old", "f1", 5, 9)]


def test_sources_are_counted_apart(spark):
    df = log(spark, [("f", 1, None)] * 3, "a").unionByName(log(spark, [("f", 1, None)] * 2, "b"))
    got = ct.checkpoints(df, 2, segment_bytes=1)
    assert rows(got.groupBy("source_id").agg(F.max("version"))) == [("a", 2), ("b", 1)]


def test_checkpoint_json_omits_empty_fields(spark):
    records = [("s", "mysql", "pos", "", "f1", 7, 0, T0, 3), ("t", "mysql", "gtid", "x:1", "", 0, 2, None, 1)]
    got = dict(ct.checkpoints_to_json(spark.createDataFrame(records, LEDGER_SCHEMA)).collect())
    assert json.loads(got["s"]) == {
        "source_id": "s", "flavor": "mysql", "mode": "pos", "binlog_file": "f1", "binlog_pos": 7,
        "updated_at": "2024-01-01T00:00:00Z", "version": 3,
    }
    assert json.loads(got["t"]) == {
        "source_id": "t", "flavor": "mysql", "mode": "gtid", "gtid_set": "x:1", "server_id": 2,
        "updated_at": "0001-01-01T00:00:00Z", "version": 1,
    }


def test_ledger_on_disk(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert ct.load_checkpoint(spark, path, "s").isEmpty()
    first = spark.createDataFrame([("s", "mysql", "pos", "", "f1", 7, 0, T0, 1)], LEDGER_SCHEMA)
    ledgers.write_checkpoints(first, path)
    ledgers.write_checkpoints(first.withColumns({"version": F.lit(2).cast("long"), "binlog_pos": F.lit(9).cast("long")}), path)
    assert [tuple(r) for r in ct.load_checkpoint(spark, path, "s").collect()] == [("s", "mysql", "pos", "", "f1", 9, 0, T0, 2)]
    assert ct.load_checkpoint(spark, path, "other").isEmpty()


def test_upsert_replaces_the_whole_record(spark):
    old = spark.createDataFrame([("s", "mysql", "pos", "", "f1", 7, 1, T0, 9), ("t", "mysql", "pos", "", "f", 1, 1, T0, 1)], LEDGER_SCHEMA)
    new = spark.createDataFrame([("s", "mariadb", "gtid", "x", "", 0, 2, T0, 1)], LEDGER_SCHEMA)
    got = {r.source_id: (r.flavor, r.binlog_file, r.version) for r in ct.save_checkpoint(old, new).collect()}
    assert got == {"s": ("mariadb", "", 1), "t": ("mysql", "f", 1)}


def test_resume_rules(spark):
    config = "source_id string, host string, port int, server_id int, flavor string, gtid_enabled boolean, gtid_set string, binlog_file string, binlog_pos long"
    cases = {
        # saved (mode, set, file, pos) -> resumed, warning, mode, position
        "gtid": (("GTID", "x:1", "", 0), True, None, "GTID", 0),
        "blank set": (("gtid", " ", "f", 5), False, "gtid_set_empty", "pos", 4),
        "pos": (("pos", "", "f9", 50), True, None, "pos", 50),
        "no file": (("pos", "", " ", 50), False, "position_empty", "pos", 4),
        "zero": (("pos", "", "f9", 0), False, "position_empty", "pos", 4),
        "largest": (("pos", "", "f9", 4294967295), True, None, "pos", 4294967295),
        "too large": (("pos", "", "f9", 4294967296), False, "position_overflow", "pos", 4),
        "mode": (("file", "x", "f9", 5), False, "mode_invalid", "pos", 4),
        "none": (None, False, None, "pos", 4),
    }
    configs = [(name, "h", 3306, 1, "", False, "cfg", "f1", 4) for name in cases]
    saved = [(n, "", c[0][0], c[0][1], c[0][2], c[0][3], 0, T0, 5) for n, c in cases.items() if c[0]]
    plan = ct.resume_plan(spark.createDataFrame(saved, LEDGER_SCHEMA), spark.createDataFrame(configs, config))
    got = {r.source_id: (r.resumed, r.warning, r.mode, r.binlog_pos) for r in plan.collect()}
    assert got == {n: c[1:] for n, c in cases.items()}
    assert {r.flavor for r in plan.collect()} == {"mysql"} and {r.server_id for r in plan.collect()} == {1}

    blank = spark.createDataFrame([(" ", " ", 3306, 7, None, True, "g", "", 0)], config)
    row = ct.resume_plan(spark.createDataFrame([], LEDGER_SCHEMA), blank).first()
    assert (row.source_id, row.mode, row.gtid_set, row.version) == ("unknown:3306#7", "gtid", "g", 0)


def test_checkpoint_times(spark):
    df = spark.createDataFrame([("2026-03-10T20:55:19.987654321+08:00",), ("2026-03-10 12:55:19",), ("",), ("x",)], "t string")
    got = df.select(times.format_time(times.parse_time(F.col("t"))))
    assert [r[0] for r in got.collect()] == ["2026-03-10 12:55:19", "2026-03-10 12:55:19", "", ""]


def test_resume_is_exactly_the_rest(spark):
    df = log(spark, [("f.000001", i * 10 + 10, None) for i in range(6)])
    assert ct.resume_after(df, "f.000001", 30).count() == 3
    assert ct.from_position(df, "f.000001", 3).count() == 4
    assert ct.from_position(df, "f.999999", 0).isEmpty()


def test_metrics_have_all_ten_names(spark):
    audit = (
        "source_id string, ts timestamp, file_seq long, pos long, event_ts timestamp, event_type string, kind string, "
        "label string, op string, schema_name string, table_name string, query string, error string, "
        "error_stage string, seconds double, checkpoint_result string, up int"
    )
    later = T0 + dt.timedelta(seconds=5)
    data = [
        ("s", T0, 1, 1, T0, "WriteRowsEventV2", "rows", "rows_insert", "insert", "a", "t", None, None, None, 0.02, None, 1),
        ("s", later, 1, 2, T0, "QueryEvent", "query", "query", None, "a", None, "drop table t", "x", "exec", 0.5, "success", None),
        ("s", later, 1, 3, later, "WriteRowsEventV2", "rows", "rows_insert", "insert", "b", "t", None, None, "read", None, "fail", None),
        ("s", T0, None, None, None, None, None, None, None, None, None, None, None, "state", None, None, None),
    ]
    df = spark.createDataFrame(data, audit)
    got = {(r.metric, r.label): r.value for r in ct.metrics_snapshot(df, F.col("schema_name") == "a", "m_").collect()}
    assert {m for m, _ in got} == {
        "m_" + n
        for n in (
            "worker_up", "binlog_events_read_total", "binlog_read_errors_total", "replication_lag_seconds",
            "events_filtered_total", "events_applied_total", "event_apply_errors_total",
            "event_apply_duration_seconds_bucket", "event_apply_duration_seconds_sum",
            "event_apply_duration_seconds_count", "state_checkpoint_total",
            "state_last_checkpoint_timestamp_seconds",
        )
    }
    assert got["m_event_apply_errors_total", "exec"] == got["m_event_apply_errors_total", "query"] == 1
    assert got["m_event_apply_errors_total", "state"] == 1
    assert got["m_events_filtered_total", "rows"] == 1
    assert got["m_event_apply_duration_seconds_bucket", "rows_insert|0.01"] == 0
    assert got["m_event_apply_duration_seconds_bucket", "rows_insert|0.025"] == 1
    assert got["m_replication_lag_seconds", "s"] == 0
    assert got["m_state_last_checkpoint_timestamp_seconds", "s"] == later.replace(tzinfo=dt.timezone.utc).timestamp()


def test_gauges_take_the_last_value(spark):
    df = spark.createDataFrame([("s", T0, 1), ("s", T0 + dt.timedelta(seconds=1), 0)], "source_id string, ts timestamp, up int")
    assert metrics.pipeline_up(df).first().up == 0


def test_the_last_write_wins_and_a_broken_record_fails(spark, tmp_path):
    path = str(tmp_path / "ledger")
    record = lambda pos, version: spark.createDataFrame([("s", "mysql", "pos", "", "f1", pos, 0, None, version)], LEDGER_SCHEMA)
    ledgers.write_checkpoints(record(7, 500), path)
    ledgers.write_checkpoints(record(9, 1), path)
    row = ledgers.load_checkpoint(spark, path, "s").first()
    assert (row.binlog_pos, row.version, row.updated_at) == (9, 1, None)
    spark.createDataFrame([('{"source_id":"s","vers',)], "value string").write.mode("append").text(path)
    with pytest.raises(Exception, match="(?i)malformed"):
        ledgers.load_ledger(spark, path).collect()
