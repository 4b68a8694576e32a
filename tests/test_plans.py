"""The plans that the operators must keep as data grows."""

import re

import pytest
from pyspark.sql import functions as F

import changetables as ct
from changetables.functions.events import lag_seconds
from changetables.operators import metrics


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "log")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    spark.range(1000).selectExpr(
        "'s' as source_id",
        "cast(id div 100 as bigint) as file_seq",
        "id % 100 as pos",
        "id % 100 + 1 as end_pos",
        "0 as ordinal",
        "'s' as schema_name",
        "'t' as table_name",
        "'u' as gtid_source",
        "id as gtid_seq",
        "case when id % 3 = 0 then 'insert' when id % 3 = 1 then 'update' else 'delete' end as op",
        "case when id % 3 > 0 then named_struct('k', id div 3, 'v', 'wide', 'w', id) end as before",
        "case when id % 3 < 2 then named_struct('k', id div 3, 'v', 'wide', 'w', id) end as after",
    ).write.parquet(path)
    return spark.read.parquet(path)


def plan(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    return text


def pushed(text):
    return " ".join(re.findall(r"PushedFilters: \[([^\]]*)\]", text))


def read_schema(text):
    return re.findall(r"ReadSchema: (\S+)", text)


def test_start_positions_reach_the_scan(log):
    assert {"file_seq", "pos"} <= set(re.findall(r"file_seq|pos", pushed(plan(ct.from_position(log, "f.000003", 4)))))
    assert "end_pos" in pushed(plan(ct.resume_after(log, "f.000003", 4)))
    assert "gtid_seq" in pushed(plan(ct.after_gtid_set(log, "u:1-5:9")))


def test_keyed_replay_combines_before_it_shuffles(log):
    text = plan(ct.latest_by_key(log, ["k"]))
    assert text.count("Exchange") == 1 and "partial_max_by" in text


def test_only_needed_columns_are_read(log):
    found = ct.conflicts(log, ["k"])
    assert all("w:" not in schema and "v:" not in schema for schema in read_schema(plan(found)))


def test_row_scans_shuffle_once_without_hot_keys(log):
    assert plan(ct.history(log, ["k"])).count("Exchange") == 1


def test_small_lookup_does_not_shuffle_the_log(log, spark):
    names = spark.createDataFrame([("s", "t", ["k"])], "schema_name string, table_name string, columns array<string>")
    text = plan(ct.schema_asof(log, ct.schema_history(names)))
    left = text.split("BroadcastHashJoin", 1)[1].split("BroadcastExchange", 1)[0]
    assert "hashpartitioning" not in left


def test_counters_take_one_pass_with_partial_counts(log):
    text = plan(metrics.events_read(log.withColumn("event_type", F.lit("x"))))
    assert "partial_count" in text and text.count("FileScan") == 1


def test_live_counters(spark, tmp_path, log):
    from changetables.functions.events import classify

    events = log.withColumns({"event_type": F.lit("WriteRowsEventV2"), "query": F.lit(None).cast("string")})
    path = str(tmp_path / "in")
    events.write.parquet(path)
    stream = spark.readStream.schema(events.schema).parquet(path)
    query = (
        metrics.observe_events(classify(stream)).writeStream.format("noop").trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "c")).start()
    )
    query.awaitTermination()
    seen = [p.observedMetrics["events"] for p in query.recentProgress if p.observedMetrics]
    assert sum(m["read"] for m in seen) == sum(m["rows"] for m in seen) == 1000


def test_lag_is_never_negative(spark):
    df = spark.sql("select timestamp'2024-01-01 00:00:01' as r, timestamp'2024-01-01 00:00:05' as e, timestamp'1970-01-01' as z")
    assert list(df.select(lag_seconds(F.col("r"), F.col("e")), lag_seconds(F.col("e"), F.col("r")), lag_seconds(F.col("r"), F.col("z"))).first()) == [0.0, 4.0, None]


def test_scratch_folder_must_be_shared_on_a_cluster(spark, monkeypatch):
    from changetables import session

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="checkpoint.dir"):
        session.scratch_root(Cluster)
    assert session.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
