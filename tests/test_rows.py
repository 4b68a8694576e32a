from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import changetables as ct
from changetables.functions import rows as images
from changetables.operators.images import normalise_rows
from changetables.operators.validate import image_error
from helpers import rows

EVENT = (
    "file_seq long, pos long, kind string, op string, schema_name string, table_name string, column_count int, "
    "columns array<string>, rows array<array<string>>, skipped array<array<int>>, json_diffs array<array<int>>"
)


def event(op, data, pos=0, schema="s", table="t", count=None, columns=("a", "b"), skipped=(), diffs=(), kind="rows"):
    columns = None if columns is None else list(columns)
    count = len(columns) if count is None else count
    return (1, pos, kind, op, schema, table, count, columns, data, list(skipped), list(diffs))


CHECKS = [
    (event("insert", [["1", "2"]]), None),
    (event("insert", [["1", "2"]], schema=None, table=None), "missing_table_map"),
    (event("insert", [["1", "2"]], schema=""), "missing_schema_or_table"),
    (event("insert", [["1", "2"]], columns=None, count=2), "column_count_mismatch"),
    (event("update", [["1", "2"]]), "odd_update_rows"),
    (event("insert", [["1", "2"], ["1"]]), "column_value_mismatch"),
    (event("insert", [["1", "2"]], skipped=[[0, 1]]), "insert_zero_columns"),
    (event("delete", [["1", "2"]], skipped=[[1, 0]]), "delete_zero_columns"),
    (event("update", [["1", "2"], ["1", "2"]], skipped=[[], [0, 1]]), "update_zero_set_columns"),
    (event("update", [["1", "2"], ["1", "2"]], skipped=[[0, 1], []]), "update_zero_where_columns"),
    (event("insert", [["1", "2"]], diffs=[[1]]), "json_diff_unsupported"),
    (event("insert", [["1", "2"]], diffs=[[1]], skipped=[[1]]), None),
    (event("insert", [["1", "2"]], skipped=[[5, -1]]), None),
    (event(None, [["1"]]), None),
    (event("update", []), None),
    (event("insert", [["1", "2"]], kind="query", schema=None, table=None), None),
    (event("insert", [["1"], ["1", "2"]], skipped=[[], [0, 1]]), "column_value_mismatch"),
    (event("insert", [["1", "2"], ["1"]], skipped=[[0, 1]]), "insert_zero_columns"),
]


def test_error_codes(spark):
    data = [(*e[:1], i, *e[2:]) for i, (e, _) in enumerate(CHECKS)]
    checked = ct.validate(spark.createDataFrame(data, EVENT))
    got = {r.pos: r.error for r in checked.collect()}
    assert got == {i: want for i, (_, want) in enumerate(CHECKS)}


def test_filtered_events_raise_no_later_error(spark):
    df = spark.createDataFrame([event("update", [["1", "2"]]), event("update", [], 1, schema="")], EVENT)
    checked = ct.validate(df, allowed=F.lit(False))
    assert rows(checked.select("pos", "error")) == [(0, None), (1, "missing_schema_or_table")]


def test_reject_and_halt(spark):
    data = [event("insert", [["1", "2"]], p) for p in (1, 2, 4)] + [event("update", [["1", "2"]], 3)]
    checked = ct.validate(spark.createDataFrame(data, EVENT))
    positions = lambda df: [r.pos for r in df.orderBy("pos").collect()]
    ok, bad = ct.split_valid(checked)
    assert (positions(ok), positions(bad)) == ([1, 2, 4], [3])
    ok, rest = ct.split_valid(checked, "halt")
    assert (positions(ok), positions(rest)) == ([1, 2], [3, 4])
    ok, rest = ct.split_valid(checked.filter("error is null"), "halt")
    assert (positions(ok), positions(rest)) == ([1, 2, 4], [])


def test_halt_keeps_good_rows_of_the_failing_event(spark):
    """Rows before the first bad row are accepted, with what belongs to them; the others are not."""
    data = [
        event("insert", [["1", "2"]], 1),
        event("insert", [["3", "4"], ["5", "6"], ["7"], ["8", "9"]], 2, skipped=[[], [1], [], [0]]),
        event("insert", [["1", "2"]], 3),
    ]
    get = lambda df: rows(df.select("pos", "rows", "skipped", "error"))
    ok, rest = ct.split_valid(ct.validate(spark.createDataFrame(data, EVENT)), "halt")
    assert get(ok.filter("pos > 1")) == [(2, [["3", "4"], ["5", "6"]], [[], [1]], None)]
    assert [r.pos for r in ok.orderBy("pos").collect()] == [1, 2]
    assert [(r.pos, r.rows) for r in rest.orderBy("pos").collect()] == [(2, [["7"], ["8", "9"]]), (3, [["1", "2"]])]
    pairs = [event("update", [["1", "2"], ["1", "3"], ["4", "5"], ["4"]], 1), event("insert", [["1"], ["2", "3"]], 2)]
    ok, rest = ct.split_valid(ct.validate(spark.createDataFrame(pairs, EVENT)), "halt")
    assert [(r.pos, r.rows) for r in ok.collect()] == [(1, [["1", "2"], ["1", "3"]])]
    assert rest.count() == 2
    changes = spark.createDataFrame([(1, 0, None), (1, 1, "x"), (1, 2, None), (0, 5, None)], "pos long, ordinal int, error string")
    ok, rest = ct.split_valid(changes.selectExpr("0 as file_seq", "*"), "halt")
    assert rows(ok.select("pos", "ordinal")) == [(0, 5), (1, 0)] and rest.count() == 2


def test_images_of_every_operation(spark):
    data = [
        event("insert", [["1", None], ["2", "x"]], 1, skipped=[[], [1]]),
        event("delete", [["3", "y"]], 2),
        event("update", [["4", "p"], ["4", "q"], ["5", "r"], ["6", "s"]], 3, skipped=[[1], [0]]),
        event("update", [], 4),
    ]
    got = rows(ct.decode_rows(spark.createDataFrame(data, EVENT)).select("pos", "ordinal", "before", "after"))
    assert got == [
        (1, 0, None, {"a": "1", "b": None}),
        (1, 1, None, {"a": "2"}),
        (2, 0, {"a": "3", "b": "y"}, None),
        (3, 0, {"a": "4"}, {"b": "q"}),
        (3, 1, {"a": "5", "b": "r"}, {"a": "6", "b": "s"}),
    ]


def test_binding_prefers_complete_event_names(spark):
    data = [
        event("insert", [["1", "2"]], 10),
        event("insert", [["1", "2"]], 20, columns=("a", "")),
        event("insert", [["1", "2"]], 30, columns=None, count=2),
        event("insert", [["1", "2", "3"]], 40, columns=None, count=3),
        event("insert", [["1", "2"]], 50, columns=None, count=2),
    ]
    initial = spark.createDataFrame([("s", "t", ["x", "y"])], "schema_name string, table_name string, columns array<string>")
    altered = spark.createDataFrame(
        [("s", "t", 1, 40, ["x", "renamed", "z"])],
        "schema_name string, table_name string, file_seq long, pos long, columns array<string>",
    )
    history = ct.schema_history(initial, altered)
    bound = ct.bind_columns(spark.createDataFrame(data, EVENT), history)
    assert {r.pos: r["columns"] for r in bound.collect()} == {
        10: ["a", "b"], 20: ["x", "y"], 30: ["x", "y"], 40: ["x", "renamed", "z"], 50: None,
    }


def test_skipped_columns_of_rows_out_of_range(spark):
    df = spark.createDataFrame([([[1], []],)], "skipped array<array<int>>")
    names = F.array(F.lit("a"), F.lit("b"))
    picks = [images.present(names, images.skipped_of(F.col("skipped"), F.lit(i))) for i in (0, 1, 2, -1)]
    assert list(df.select(*picks).first()) == [["a"], ["a", "b"], ["a", "b"], ["a", "b"]]


def test_values_keep_their_types(spark):
    fields = T.StructType(
        [
            T.StructField("id", T.DecimalType(20, 0)),
            T.StructField("amount", T.DecimalType(10, 2)),
            T.StructField("at", T.TimestampType()),
            T.StructField("flag", T.ByteType()),
            T.StructField("day", T.DateType()),
        ]
    )
    log = spark.createDataFrame(
        [("insert", None, {"id": "18446744073709551615", "amount": "0.10", "at": "2024-01-15 10:30:00.75", "flag": "1", "day": None})],
        "op string, before map<string,string>, after map<string,string>",
    )
    row = ct.typed_changes(log, fields).select("after.*")
    got = row.first()
    assert got.id == Decimal("18446744073709551615") and got.amount == Decimal("0.10") and got.flag == 1
    assert got.day is None
    assert normalise_rows(row).first().at == "2024-01-15 10:30:00"


def test_null_safe_match_and_assignment(spark):
    df = spark.createDataFrame([(1, None, 1, None), (1, 2, 1, None), (None, 2, None, 2)], "a int, b int, c int, d int")
    on = images.row_match([F.col("a"), F.col("b")], [F.col("c"), F.col("d")])
    assert [r[0] for r in df.select(on).collect()] == [True, False, True]
    df = spark.createDataFrame([("old", None, ["x"]), ("old", None, [])], "cur string, aft string, present array<string>")
    got = df.select(images.assign(F.col("cur"), F.col("aft"), F.col("present"), "x"))
    assert [r[0] for r in got.collect()] == [None, "old"]


def test_before_image_must_pair_up(spark):
    df = spark.createDataFrame([({"a": "1"}, ["a"]), ({"a": "1"}, ["a", "b"])], "b map<string,string>, p array<string>")
    assert [r[0] for r in df.select(image_error(F.col("b"), F.col("p"))).collect()] == [None, "where_column_value_mismatch"]


def test_evolving_a_table(spark):
    df = spark.createDataFrame([(1, "7", "x")], "id int, n string, gone string")
    steps = [
        {"action": "add", "column": "nickname", "type": "string"},
        {"action": "rename", "column": "n", "to": "number"},
        {"action": "modify", "column": "number", "type": "int"},
        {"action": "drop", "column": "gone"},
    ]
    assert ct.evolve_schema(df, steps).first().asDict() == {"id": 1, "number": 7, "nickname": None}
    with pytest.raises(ValueError, match="unknown schema change"):
        ct.evolve_schema(df, [{"action": "twist", "column": "n"}])


def test_values_of_the_wrong_type_are_set_aside(spark):
    fields = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("day", T.DateType())])
    log = [
        (1, "insert", None, {"id": "7", "day": "2024-02-29"}),
        (2, "insert", None, {"id": "seven", "day": None}),
        (3, "update", {"id": "7", "day": "2024-02-30"}, {"id": "7", "day": "2024-03-01"}),
        (4, "delete", {"id": "7"}, None),
    ]
    df = spark.createDataFrame(log, "pos long, op string, before map<string,string>, after map<string,string>")
    ok, bad = ct.split_valid(ct.check_types(df, fields))
    assert rows(bad.select("pos", "error")) == [(2, "value_type_mismatch"), (3, "value_type_mismatch")]
    assert rows(ct.typed_changes(ok, fields).select("pos", "after.id", "before.id")) == [(1, 7, None), (4, None, 7)]
