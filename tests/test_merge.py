import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sedimenta.operators.history import scd2_apply, scd2_initial
from sedimenta.operators.merge import (
    merge_rows,
    replace_where,
    union_evolving,
    upsert,
    upsert_keeping,
    upsert_touched,
)
from sedimenta.plans.bronze import watermark_load


def plain(df, *columns):
    return sorted(map(tuple, df.select(*(columns or df.columns)).collect()), key=repr)


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "c"), (None, "m")], "k int, v string")
    expected = [(1, "a"), (2, "B"), (3, "c"), (None, "m"), (None, "n")]
    assert plain(upsert(old, new, ["k"])) == sorted(expected, key=repr)
    assert plain(upsert(None, new, ["k"])) == plain(new)
    assert plain(upsert(upsert(old, new.dropna(), ["k"]), new.dropna(), ["k"])) == plain(upsert(old, new.dropna(), ["k"]))


def test_upsert_counts_the_rows_of_a_key_once(spark, capsys):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    upsert(old, new, ["k"]).explain()
    assert capsys.readouterr().out.count("Window [") == 1


def test_a_key_that_occurs_twice_stops_every_merge(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    twice = spark.createDataFrame([(2, "B"), (2, "C"), (None, "x"), (None, "y")], "k int, v string")
    history = scd2_initial(old, ["v"], "2024-01-01 00:00:00")
    for merge in (
        lambda: upsert(old, twice, ["k"]),
        lambda: upsert(None, twice, ["k"]),
        lambda: upsert_keeping(old, twice, ["k"], ["v"], {}),
        lambda: scd2_apply(history, twice, ["k"], ["v"], "2024-02-01 00:00:00"),
        lambda: scd2_apply(history, twice, ["k"], ["v"], "2024-02-01 00:00:00", small_source=True),
        lambda: watermark_load(old, twice, ["k"], "v"),
        lambda: upsert_touched(old, twice, ["k"], "k", [2]),
    ):
        with pytest.raises(PySparkException, match="share one key \\(k=2\\)"):
            merge().collect()


def test_the_check_adds_no_shuffle(spark):
    old, new = (spark.range(0, 2000).withColumn("v", F.lit(i)).selectExpr("id AS k", "v") for i in range(2))
    big = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in big}
    try:
        for k, v in big.items():
            spark.conf.set(k, v)
        plan = upsert_keeping(old, new, ["k"], ["v"], {})._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert plan.count("Exchange hashpartitioning") == 2


def test_upsert_with_unlike_columns(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, kept int")
    new = spark.createDataFrame([(2, "B", True), (3, "c", False)], "k int, v string, added boolean")
    assert plain(upsert(old, new, ["k"]), "k", "v", "kept", "added") == [
        (1, "a", 10, None),
        (2, "B", 20, True),
        (3, "c", None, False),
    ]


def test_touched_keys_without_a_row_are_removed(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    gone = spark.createDataFrame([(1,)], "k int")
    assert plain(merge_rows(old, old.limit(0), ["k"], touched=gone)) == [(2, "b")]


def test_kept_columns(spark):
    old = spark.createDataFrame([(100, 1, "a"), (200, 2, "b"), (300, None, "n")], "sk int, k int, v string")
    new = spark.createDataFrame([(2, 2, "B"), (3, 3, "c"), (4, None, "m")], "sk int, k int, v string")
    assert plain(upsert_keeping(old, new, ["k"], ["sk"], {})) == [
        (100, 1, "a"),
        (200, 2, "B"),
        (3, 3, "c"),
        (300, None, "n"),
        (4, None, "m"),
    ]
    late = upsert_keeping(old, new.drop("sk"), ["k"], ["sk"], {"sk": F.col("k")})
    assert (3, 3, "c") in plain(late)


def test_replace_where(spark):
    old = spark.createDataFrame([(1, "a"), (5, "b"), (None, "n")], "d int, v string")
    new = spark.createDataFrame([(6, "B")], "d int, v string")
    assert plain(replace_where(old, new, "d >= 5")) == sorted([(1, "a"), (6, "B"), (None, "n")], key=repr)
    assert plain(replace_where(old, new.limit(0), "d >= 5")) == sorted([(1, "a"), (None, "n")], key=repr)
    assert plain(replace_where(None, new, "d >= 5")) == [(6, "B")]
    for outside in (4, None):
        stray = spark.createDataFrame([(outside, "x")], "d int, v string")
        with pytest.raises(PySparkException, match="does not satisfy"):
            replace_where(old, stray, "d >= 5").collect()


def test_union_evolving(spark):
    df = union_evolving(spark.createDataFrame([(1, "a")], "k int, v string"), spark.createDataFrame([(2, 3)], "k int, n int"))
    assert plain(df, "k", "v", "n") == [(1, "a", None), (2, None, 3)]
