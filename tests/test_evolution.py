"""Schemas merged at any depth."""

import decimal

import pytest
from pyspark.sql.types import StructType, _parse_datatype_string

from sedimenta.functions.evolution import aligned, merged_type, union_nested
from sedimenta.operators.merge import upsert


def kind(text):
    return _parse_datatype_string(text)


@pytest.mark.parametrize(
    ("older", "newer", "both"),
    [
        ("int", "bigint", "bigint"),
        ("tinyint", "smallint", "smallint"),
        ("smallint", "float", "float"),
        ("int", "float", "double"),
        ("float", "double", "double"),
        ("int", "decimal(12,2)", "decimal(12,2)"),
        ("bigint", "decimal(12,2)", "decimal(21,2)"),
        ("decimal(10,4)", "decimal(12,2)", "decimal(14,4)"),
        ("void", "string", "string"),
        ("array<int>", "array<bigint>", "array<bigint>"),
        ("map<string,int>", "map<string,decimal(5,1)>", "map<string,decimal(11,1)>"),
        ("struct<a:int,b:struct<c:int>>", "struct<B:struct<d:string,c:bigint>,e:date>", "struct<a:int,b:struct<c:bigint,d:string>,e:date>"),
        ("array<struct<a:int>>", "array<struct<b:int>>", "array<struct<a:int,b:int>>"),
    ],
)
def test_common_types(spark, older, newer, both):
    assert merged_type(kind(older), kind(newer)).simpleString() == both
    turned = merged_type(kind(newer), kind(older))
    assert merged_type(kind(both), turned).simpleString() == both.replace("B:", "b:")


@pytest.mark.parametrize(
    ("older", "newer", "name"),
    [
        ("a: struct<b: array<struct<c: string>>>", "a: struct<b: array<struct<c: int>>>", r"a\.b\[\]\.c"),
        ("a: bigint", "a: double", "a"),
        ("a: string", "a: struct<b: int>", "a"),
        ("a: decimal(38,0)", "a: decimal(10,2)", "a"),
        ("m: map<string,date>", "m: map<string,int>", r"m\{\}"),
        ("a: boolean", "a: int", "a"),
    ],
)
def test_incompatible_types_are_refused_by_name(spark, older, newer, name):
    first, second = (StructType.fromDDL(text) for text in (older, newer))
    with pytest.raises(TypeError, match=f"^{name}: .* no common type"):
        merged_type(first, second)


OLDER = "k int, who struct<name: string, home: struct<nation: int>>, accounts array<struct<amount: decimal(6,2)>>, tags map<string,int>"
NEWER = "K bigint, tags map<string,bigint>, who struct<phone: string, home: struct<city: string, nation: bigint>, name: string>, accounts array<struct<currency: string, amount: decimal(9,1)>>, more date"


def test_rows_of_both_sides(spark):
    D = decimal.Decimal
    older = spark.createDataFrame([(1, ("ann", (5,)), [(D("1.25"),), None], {"a": 1}), (2, None, None, None), (3, ("bo", None), [], {})], OLDER)
    newer = spark.createDataFrame([(9_000_000_000, {"b": 7}, ("123", ("oslo", 6), "cy"), [("eur", D("12345678.5"))], None)], NEWER)
    out = union_nested(older, newer)
    assert out.schema.simpleString() == (
        "struct<k:bigint,who:struct<name:string,home:struct<nation:bigint,city:string>,phone:string>,"
        "accounts:array<struct<amount:decimal(10,2),currency:string>>,tags:map<string,bigint>,more:date>"
    )
    rows = {r.k: r for r in out.collect()}
    assert rows[1].who.asDict(True) == {"name": "ann", "home": {"nation": 5, "city": None}, "phone": None}
    assert [a and a.asDict() for a in rows[1].accounts] == [{"amount": D("1.25"), "currency": None}, None]
    assert (rows[2].who, rows[2].accounts, rows[2].tags) == (None, None, None)
    assert (rows[3].who.home, rows[3].accounts, rows[3].tags) == (None, [], {})
    assert rows[9_000_000_000].who.asDict(True) == {"name": "cy", "home": {"nation": 6, "city": "oslo"}, "phone": "123"}
    assert rows[9_000_000_000].accounts[0].asDict() == {"amount": D("12345678.50"), "currency": "eur"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_upsert_into_a_table_of_an_older_schema(spark):
    older = spark.createDataFrame([(1, ("ann", (5,)), [], {}), (2, ("bo", None), [], {})], OLDER)
    newer = spark.createDataFrame([(2, {}, ("1", None, "bob"), [], None), (3, {}, None, None, None)], NEWER)
    target, source = aligned(older, newer)
    out = {r.k: r.who and r.who.name for r in upsert(target, source, ["k"]).collect()}
    assert out == {1: "ann", 2: "bob", 3: None}


def test_names_that_differ_in_case_only(spark):
    with pytest.raises(TypeError, match="case"):
        merged_type(kind("struct<a:int,A:int>"), kind("struct<b:int>"))
