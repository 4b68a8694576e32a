"""Declared column types and the text forms of their values."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import changetables as ct
from changetables.functions.types import canonical_json, declared_fields, format_interval, parse_interval, source_type
from changetables.operators.images import normalise_rows
from changetables.operators.validate import check_types, split_valid
from helpers import rows


def column(spark, values, body):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [r[0] for r in df.orderBy("i").select(body(F.col("t"))).collect()]


def test_source_types():
    assert source_type("BIGINT UNSIGNED AUTO_INCREMENT") == T.DecimalType(20, 0)
    assert source_type("decimal(10, 2) not null") == T.DecimalType(10, 2)
    assert source_type("numeric") == T.DecimalType(10, 0)
    assert source_type("tinyint(1)") == T.ByteType()
    assert source_type("tinyint unsigned") == T.ShortType()
    assert source_type("LONGBLOB") == T.BinaryType()
    assert source_type("enum('a','b')") == T.StringType()
    with pytest.raises(ValueError):
        source_type("geometry")


def test_canonical_json(spark):
    texts = ['{"b": 1, "a": [1, 2.50, {"y": null, "x": "\\u00e9"}]}', "[ ]", "bad{", None, "1.10", '{"a":1,"a":2}']
    want = ['{"a":[1,2.5,{"x":"é","y":null}],"b":1}', "[]", None, None, "1.1", None]
    assert column(spark, texts, canonical_json) == want


def test_intervals(spark):
    same = ["00:00:00", "-00:00:01", "838:59:59", "-838:59:59.999999", "26:03:04.5", "00:00:00.000001", "-00:59:59.1"]
    assert column(spark, same, lambda t: format_interval(parse_interval(t))) == same
    odd = ["1:2:3", "", None, "839:60:00", "1:00:60", "12:00", "x", "01:00:00.1234567", "1000:00:00"]
    assert column(spark, odd, parse_interval) == [None] * len(odd)
    assert column(spark, ["1:00:00.500"], lambda t: format_interval(parse_interval(t))) == ["01:00:00.5"]


def test_typed_round_trip_and_bad_values(spark):
    fields = declared_fields({"id": "bigint unsigned", "j": "json", "b": "blob", "t": "time", "ts": "datetime"})
    good = {"id": "18446744073709551615", "j": '{"b":1,"a":2}', "b": "AP8=", "t": "-30:00:00", "ts": "2020-01-02 03:04:05"}
    data = [(1, good)] + [(2, {**good, k: v}) for k, v in [("j", "{"), ("b", "*"), ("t", "99"), ("id", "x"), ("ts", "x")]]
    data += [(3, dict.fromkeys(good))]
    log = spark.createDataFrame(data, "n int, after map<string,string>").withColumns(
        {"op": F.lit("insert"), "before": F.lit(None).cast("map<string,string>")}
    )
    checked = check_types(log, fields)
    assert rows(checked.select("n", F.col("error").isNotNull())) == [(1, False)] + [(2, True)] * 5 + [(3, False)]
    typed = ct.typed_changes(checked.filter("error is null"), fields)
    back = normalise_rows(typed.select("n", "after.*"))
    assert rows(back.select("n", F.col("id").cast("string"), "j", "b", "t", "ts")) == [
        (1, good["id"], '{"a":2,"b":1}', "AP8=", "-30:00:00", good["ts"]),
        (3, None, None, None, None, None),
    ]
    # equal documents and intervals are equal values, so rows match on them
    assert typed.select("after").distinct().count() == 2
    with pytest.raises(Exception, match="column (t|b|id|j|ts):"):
        ct.typed_changes(log, fields).collect()


def test_images_are_computed_once_however_many_columns_they_have(spark):
    fields = declared_fields({f"c{i}": "time" for i in range(12)})
    names, values = [F.lit(f.name) for f in fields], [F.concat("t", F.lit(f"0:0{i % 10}")) for i in range(12)]
    log = spark.createDataFrame([("1:0",), ("x",)], "t string").select(
        F.lit("insert").alias("op"),
        F.lit(None).cast("map<string,string>").alias("before"),
        F.map_from_arrays(F.array(*names), F.array(*values)).alias("after"),
    )
    good, bad = split_valid(check_types(log, fields))
    for side in (good, bad):
        plan = side._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("map_from_arrays") <= 2  # in the image's own column, and in the filter
    assert (good.count(), bad.count()) == (1, 1)
