"""Streaming queries over a log that lies in several files."""

import datetime
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import check
from workloads import logs, partials


@pytest.mark.parametrize("name", ["stream_ddl", "stream_commits"])
def test_a_turn_keeps_the_files_its_events_lie_in(spark, tmp_path, monkeypatch, name):
    kinds = ["signup", "view", "click", "error", "purchase"]
    start = datetime.datetime(2024, 1, 1)
    data = [
        (i, start, (i * 7) % 23, "error" if i % 41 == 0 else kinds[i % 3], i / 10, f'{{"k": {i % 17}}}') for i in range(600)
    ]
    events = spark.createDataFrame(data, logs.EVENTS_SCHEMA)
    events.repartition(4, F.col("event_id") % 4).write.parquet(f"{tmp_path}/events.parquet")
    folders = []

    def spied(session, path, **options):
        folders.append(path)
        return read(session, path, **options)

    read = partials.read_changelog
    monkeypatch.setattr(partials, "read_changelog", spied)
    got = contract.queries()[name](spark, str(tmp_path)).toPandas()
    db = duckdb.connect()
    db.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    assert check.compare(got, db.execute(contract.oracle_sql()[name]).df()) == ""
    assert len(set(folders)) == 1 and len(list(Path(folders[0]).glob("part-*.parquet"))) > 3
