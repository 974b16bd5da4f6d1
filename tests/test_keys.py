import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sedimenta.operators.keys import greatest_key, lookup_key, with_surrogate_key, with_unknown_member


@pytest.mark.parametrize("partitions", [None, 1, 7])
def test_keys_equal_a_global_row_number(spark, partitions):
    rng = random.Random(1)
    rows = [(rng.choice(["hot", "hot", "b", None]), i, rng.random()) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, i int, x double").repartition(6)
    keyed = with_surrogate_key(df, ["g", "i"], "sk", after=500, partitions=partitions)
    expected = df.withColumn("sk", F.row_number().over(Window.orderBy("g", "i")).cast("long") + 500)
    assert keyed.columns == [*df.columns, "sk"]
    assert sorted(map(repr, keyed.collect())) == sorted(map(repr, expected.collect()))


def test_keys_continue_from_a_table(spark):
    used = spark.createDataFrame([(7,), (41,)], "sk bigint")
    df = spark.createDataFrame([("b",), ("a",)], "k string")
    numbered = with_surrogate_key(df, ["k"], "sk", after=greatest_key(used, "sk"))
    assert sorted(map(tuple, numbered.collect())) == [("a", 42), ("b", 43)]
    empty = with_surrogate_key(df, ["k"], "sk", after=greatest_key(used.limit(0), "sk"))
    assert sorted(map(tuple, empty.collect())) == [("a", 1), ("b", 2)]
    assert with_surrogate_key(df.limit(0), ["k"], "sk").count() == 0


def test_unknown_member_is_added_once_by_name(spark):
    df = spark.createDataFrame([("a", 1, 5)], "name string, sk bigint, n int")
    once = with_unknown_member(df, "sk", {"name": "Unknown"})
    assert sorted(map(tuple, once.collect())) == [("Unknown", -1, None), ("a", 1, 5)]
    assert with_unknown_member(once, "sk", {"name": "Other"}).count() == 2
    with pytest.raises(ValueError, match="nope"):
        with_unknown_member(df, "sk", {"nope": 1})


def test_lookup_falls_back_to_the_unknown_key(spark):
    facts = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "f int, c int")
    dim = spark.createDataFrame([(10, 7, "x"), (11, 8, "y")], "id int, sk int, v string")
    found = lookup_key(facts, dim, "c", "id", "sk")
    assert sorted(map(tuple, found.select("f", "sk").collect())) == [(1, 7), (2, -1), (3, -1)]
    assert found.columns == ["f", "c", "sk"]


def test_hot_order_value_fills_several_partitions(spark):
    df = spark.range(0, 24000, 1, 6).selectExpr("CASE WHEN id % 3 = 0 THEN NULL ELSE id END AS k", "id")
    keyed = with_surrogate_key(df, ["k", "id"], "sk", partitions=8)
    wanted = {r.id: r.n for r in df.withColumn("n", F.row_number().over(Window.orderBy("k", "id"))).collect()}
    assert {r.id: r.sk for r in keyed.collect()} == wanted
    hot = with_surrogate_key(df.select("k"), ["k"], "sk", partitions=8)
    assert sorted(r.sk for r in hot.collect()) == list(range(1, 24001))
    keyed = with_surrogate_key(df, ["k"], "sk", partitions=8)
    sizes = [spark.read.parquet(path).count() for path in set(keyed.inputFiles())]
    assert max(sizes) < 2 * 24000 / 8
