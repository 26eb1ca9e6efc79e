"""Schemas: inference against Spark's own JSON reader, merging, pruning, names, reports."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from msgmart.operators.payload import malformed, parse, star
from msgmart.sources import schema as S

AWKWARD = [
    '{"a":1,"b":1.5,"c":{"x":"s","y":null},"d":[{"n":1},{"m":"t"}],"e":[],"f":{},"g":null}',
    '{"a":2,"b":2,"j":5,"c":{"x":1,"z":[1,2.5]},"k":{"p":1},"h":true,"@type":"q","a b":1}',
    '{"k":"str","i":12345678901234567890,"big":1e30,"x`y":1}',
    '{"arr":[1,"a"],"only":[{"@baseType":null,"name":"n"}]}',
    '{"arr":[2],"ts":"2020-01-01","n":1.25}',
    '{"n":1}',
]


def frame(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "jsonstruct string")


def shape(schema: StructType) -> dict:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def test_inference_equals_the_json_reader(spark):
    df = frame(spark, AWKWARD)
    reader = spark.read.json(df.rdd.map(lambda row: row.jsonstruct)).schema
    assert shape(S.infer_schema(df)) == shape(reader)


def test_malformed_text_takes_no_part(spark):
    df = frame(spark, ['{"a":1}', '{"a":', "nonsense", "[1,2]", None, ""])
    assert shape(S.infer_schema(df)) == {"a": "bigint"}
    assert sorted(r.jsonstruct for r in malformed(df).collect()) == ["", "nonsense", '{"a":']


def test_no_messages_give_an_empty_schema(spark):
    assert S.infer_schema(frame(spark, ["x"]).limit(0)) == StructType([])
    with pytest.raises(ValueError):
        parse(frame(spark, ["{}"]), StructType([]))


def test_malformed_message_is_a_row_of_nulls(spark):
    df = frame(spark, ['{"a":1,"b":"x"}', '{"a":'])
    got = star(df, S.infer_schema(df)).collect()
    assert [tuple(r) for r in got] == [(1, "x"), (None, None)]


def test_stored_and_new_schema_merge_as_if_inferred_together(spark):
    left, right = frame(spark, AWKWARD[:3]), frame(spark, AWKWARD[3:])
    merged = S.merge_schemas(S.infer_schema(left), S.infer_schema(right))
    assert shape(merged) == shape(S.infer_schema(frame(spark, AWKWARD)))


@pytest.mark.parametrize(
    "left, right, both",
    [
        ("bigint", "double", "double"),
        ("bigint", "string", "string"),
        ("array<bigint>", "array<double>", "array<double>"),
        ("struct<a:bigint>", "struct<b:string>", "struct<a:bigint,b:string>"),
        ("struct<a:bigint>", "bigint", "string"),
        ("decimal(25,0)", "bigint", "decimal(25,0)"),
    ],
)
def test_merged_types(spark, left, right, both):
    for a, b in ((left, right), (right, left)):
        assert S.merge_types(DataType.fromDDL(a), DataType.fromDDL(b)).simpleString() == both


def test_declared_schema_holds_the_wanted_paths_only(spark):
    declared = S.declared_schema({"a.b[0].c": "string", "a.b[0].d": "bigint", "e": "array<int>"})
    assert declared.simpleString() == "struct<a:struct<b:array<struct<c:string,d:bigint>>>,e:array<int>>"


def test_pruning_ignores_case_and_keeps_open_parts(spark):
    full = DataType.fromDDL("struct<A:struct<B:string,C:bigint>,d:array<struct<e:string,f:struct<g:int>>>,h:int>")
    assert S.pruned(full, ["a.b", "d[0]"]).simpleString() == (
        "struct<A:struct<B:string>,d:array<struct<e:string,f:struct<g:int>>>>"
    )


def test_fields_that_differ_by_case_are_both_read(spark):
    df = frame(spark, ['{"p":{"id":"lower"}}', '{"p":{"ID":"upper"}}', '{"P":{"Id":"mixed"}}', "{}"])
    frame_, data = parse(df, S.infer_schema(df), inferred=True)
    got = [r.v for r in frame_.select(data.value("p.id").alias("v")).collect()]
    assert got == ["lower", "upper", "mixed", None]


def test_unknown_path_and_wrong_shape_give_typed_nulls(spark):
    df = frame(spark, ['{"a":1,"arr":[],"s":"x"}'])
    frame_, data = parse(df, S.infer_schema(df), inferred=True)
    picked = frame_.select(
        data.value("b.c").alias("missing"),
        data.value("s.x", ddl="bigint").alias("through_text"),
        data.value("a[0]").alias("head_of_number"),
        data.value("arr[0]").alias("head_of_empty"),
    )
    assert [t for _, t in picked.dtypes] == ["string", "bigint", "string", "string"]
    assert tuple(picked.first()) == (None, None, None, None)


def test_coalesced_paths_of_different_types_become_text(spark):
    df = frame(spark, ['{"old":5}', '{"new":"six"}'])
    frame_, data = parse(df, S.infer_schema(df), inferred=True)
    assert [r.v for r in frame_.select(data.value("old", "new").alias("v")).collect()] == ["5", "six"]


def test_field_names_with_special_characters(spark):
    df = frame(spark, ['{"list":[{"@type":"t","@baseType":null,"name":"n"}]}'])
    frame_, data = parse(df, S.infer_schema(df), inferred=True)
    assert frame_.select(data.value("list[0].@type").alias("v")).first().v == "t"


def test_layout_report(spark):
    df = frame(spark, ['{"installationAddress":{"x":1},"id":"a"}', '{"installationLocation":{"y":1}}'])
    rows = {r.field: r.layout for r in S.field_report(spark, S.infer_schema(df)).collect()}
    assert rows == {"id": None, "installationAddress": "old", "installationLocation": "new"}


def test_numbers_and_parts_as_declared_text(spark):
    df = frame(spark, ['{"n":5,"b":true,"o":{"q":1},"l":[1,2]}'])
    wanted = dict.fromkeys(("n", "b", "o", "l"), "string")
    frame_, data = parse(df, S.declared_schema(wanted))
    assert tuple(frame_.select(*[data.value(w) for w in wanted]).first()) == ("5", "true", '{"q":1}', "[1,2]")


def test_one_conflicting_field_keeps_the_others(spark):
    df = frame(spark, ['{"a":{"x":1},"b":"keep"}'])
    frame_, data = parse(df, S.declared_schema({"a": "array<struct<y:int>>", "b": "string"}))
    assert frame_.select(F.size(data.value("a")).alias("n"), data.value("b").alias("b")).first().b == "keep"
