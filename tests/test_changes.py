"""Change apply against a fold in plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from sedimenta.operators.changes import (
    apply_changes,
    decode_changes,
    duplicate_keys,
    high_water_mark,
    latest_per_key,
    require_unique,
)
from sedimenta.plans.bronze import initial_load, watermark_load
from sedimenta.sources.feeds import changes_after, in_log_order

CHANGE = (
    "k1 int, k2 string, v string, _cdc_operation_code int, _cdc_version bigint, _cdc_seq bigint, "
    "_change_timestamp timestamp_ntz"
)
STAMP = "2024-01-01 00:00:00"


def plain(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def fold(state, changes):
    """Apply the last change of each key, in plain Python."""
    last = {}
    for k1, k2, v, code, version, seq in changes:
        if code == 3:
            continue
        key = (k1, k2)
        if key not in last or (version, seq) > last[key][0]:
            last[key] = ((version, seq), code, v)
    state = list(state)
    for (k1, k2), (_, code, v) in last.items():
        if k1 is not None and k2 is not None:
            state = [row for row in state if row[:2] != (k1, k2)]
        if code != 1:
            state.append((k1, k2, v))
    return sorted(state, key=repr)


def test_operations_are_decoded_and_before_images_dropped(spark):
    codes = spark.createDataFrame([(c,) for c in (1, 2, 3, 4, 5, None)], "_cdc_operation_code int")
    assert plain(decode_changes(codes), "_cdc_operation_code", "_cdc_operation") == sorted(
        [(1, "DELETE"), (2, "INSERT"), (4, "UPDATE"), (5, "UNKNOWN"), (None, "UNKNOWN")], key=repr
    )


@pytest.mark.parametrize("seed", range(3))
def test_apply_equals_fold_and_batches_compose(spark, seed):
    rng = random.Random(seed)
    keys = [(i, s) for i in range(40) for s in ("a", "b")] + [(None, "a"), (3, None)]
    start = [(i, s, f"old{i}{s}") for i, s in keys if rng.random() < 0.5]
    hot = keys[0]
    changes = [
        (*(hot if rng.random() < 0.33 else rng.choice(keys)), rng.choice(["x", "y", None]), rng.randint(1, 5), n // 3, n)
        for n in range(600)
    ]
    target = initial_load(spark.createDataFrame(start, "k1 int, k2 string, v string"), "r1", STAMP)
    frame = spark.createDataFrame([(*c, None) for c in changes], CHANGE).repartition(5)
    result = apply_changes(target, frame, ["k1", "k2"], "r2", STAMP)
    assert result.columns == target.columns
    assert plain(result, "k1", "k2", "v") == fold(start, changes)

    # Keys that can match: once more changes nothing, and two batches give what one gives.
    keyed = frame.dropna(subset=["k1", "k2"])
    once = apply_changes(target, keyed, ["k1", "k2"], "r2", STAMP)
    again = apply_changes(once, keyed, ["k1", "k2"], "r2", STAMP)
    assert plain(again, "k1", "k2", "v") == plain(once, "k1", "k2", "v")
    early, late = keyed.filter("_cdc_seq < 300"), keyed.filter("_cdc_seq >= 300")
    halves = apply_changes(apply_changes(target, early, ["k1", "k2"], "r2", STAMP), late, ["k1", "k2"], "r3", STAMP)
    assert plain(halves, "k1", "k2", "v") == plain(once, "k1", "k2", "v")


def test_absent_key_delete_does_nothing_and_extra_columns_survive(spark):
    target = initial_load(
        spark.createDataFrame([(1, "a", "v", "kept"), (2, "b", "w", "too")], "k1 int, k2 string, v string, note string"),
        "r1",
        STAMP,
    )
    changes = spark.createDataFrame(
        [(1, "a", "new", 4, 1, 1, None), (9, "z", None, 1, 2, 2, None), (7, "q", "ins", 2, 3, 3, None)], CHANGE
    )
    result = apply_changes(target, changes, ["k1", "k2"], "r2", STAMP)
    assert plain(result, "k1", "v", "note", "_cdc_operation", "_pipeline_run_id") == [
        (1, "new", "kept", "UPDATE", "r2"),
        (2, "w", "too", "F", "r1"),
        (7, "ins", None, "INSERT", "r2"),
    ]


def test_equal_positions_follow_the_sequence(spark):
    df = spark.createDataFrame([(1, 5, 1, "a"), (1, 5, 2, "b"), (2, 5, 9, "c")], "k int, p int, s int, v string")
    assert plain(latest_per_key(df, ["k"], ["p", "s"]), "k", "v") == [(1, "b"), (2, "c")]


def test_reads_behind_a_position(spark):
    df = spark.createDataFrame([(1, "2024-01-01"), (5, "2024-01-02"), (9, "2024-01-03")], "_cdc_version int, d string")
    df = df.withColumn("_change_timestamp", F.col("d").cast("timestamp_ntz"))
    assert changes_after(df).count() == 3
    assert [r[0] for r in in_log_order(changes_after(df, 1), "_cdc_version").collect()] == [5, 9]
    assert changes_after(df, 1, until="2024-01-02").count() == 1
    assert changes_after(df, since="2024-01-03").count() == 1
    assert high_water_mark(df).first()[0] == 9
    assert high_water_mark(df.limit(0)).first()[0] is None


def test_watermark_load(spark):
    old = spark.createDataFrame([(1, 10, "a"), (2, 20, "b")], "k int, t int, v string")
    new = spark.createDataFrame([(1, 10, "late edit, same time"), (2, 30, "b2"), (3, 25, "c")], "k int, t int, v string")
    assert plain(watermark_load(old, new, ["k"], "t", 20), "k", "v") == [(1, "a"), (2, "b2"), (3, "c")]
    assert watermark_load(None, new, ["k"], "t").count() == 3


def test_duplicate_source_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "k int, s string")
    assert plain(duplicate_keys(df, ["k", "s"]), "k", "s", "row_count") == [(1, "a", 2)]
    with pytest.raises(ValueError, match="k=1"):
        require_unique(df, ["k", "s"])
    assert require_unique(df.filter("k > 1"), ["k", "s"]).count() == 3
