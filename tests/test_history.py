"""History tables against a fold in plain Python, and their invariants."""

import random

import pytest
from pyspark.sql import functions as F

from sedimenta.functions.columns import row_hash
from sedimenta.operators.history import (
    current_rows,
    scd2_apply,
    scd2_changed_keys,
    scd2_expired_rows,
    scd2_initial,
    scd2_new_rows,
)

SCHEMA = "case int, id int, a string, b string, note string"
KEYS, TRACKED = ["case", "id"], ["a", "b"]
TIMES = [f"2024-01-0{d} 00:00:00" for d in range(1, 7)]
SHOWN = ["case", "id", "a", "b", "note", "_is_current", "_valid_from", "_valid_to"]


def shown(df):
    return sorted(
        [(*r[:6], str(r[6]), None if r[7] is None else str(r[7])) for r in df.select(*SHOWN).collect()], key=repr
    )


def fold(history, batch, now):
    out, incoming = [], {r[:2]: r for r in batch if None not in r[:2]}
    seen = set()
    for row in history:
        key, source = row[:2], incoming.get(row[:2])
        if row[5] and None not in key and source is not None:
            seen.add(key)
            if source[2:4] != row[2:4]:
                out.append((*row[:5], False, row[6], now))
                out.append((*source, True, now, None))
                continue
        out.append(row)
    out.extend((*r, True, now, None) for r in batch if r[:2] not in seen)
    return out


@pytest.mark.parametrize("seed", range(2))
def test_apply_equals_fold(spark, seed):
    rng = random.Random(seed)
    values = ["x", "y", "x|y", "", None]

    def batch():
        ids = [(c, i) for c in range(12) for i in range(8) if rng.random() < 0.6]
        rows = [(*k, rng.choice(values), rng.choice(values), rng.choice("mn")) for k in ids]
        return rows + [(None, 1, rng.choice(values), "n", "m")]

    first = batch()
    state = scd2_initial(spark.createDataFrame(first, SCHEMA), TRACKED, TIMES[0])
    expected = [(*r, True, TIMES[0], None) for r in first]
    assert shown(state) == sorted(expected, key=repr)
    for now in TIMES[1:4]:
        rows = batch()
        source = spark.createDataFrame(rows, SCHEMA)
        before, state = state, scd2_apply(state, source, KEYS, TRACKED, now)
        expected = fold(expected, rows, now)
        assert shown(state) == sorted(expected, key=repr)
        small = scd2_apply(before, source, KEYS, TRACKED, now, small_source=True)
        assert small.columns == state.columns and shown(small) == shown(state)

        # The separate operators describe the same step.
        keyed = source.dropna(subset=KEYS)
        assert scd2_changed_keys(before, keyed, KEYS, TRACKED).count() == scd2_expired_rows(
            before, keyed, KEYS, TRACKED, now
        ).count()
        opened = state.filter(F.col("_valid_from") == F.lit(now).cast("timestamp"))
        assert opened.count() == (
            scd2_new_rows(before, source, KEYS, TRACKED, now).count()
            + scd2_changed_keys(before, source, KEYS, TRACKED).count()
        )

    keyed = state.dropna(subset=KEYS)
    assert current_rows(keyed).groupBy(*KEYS).count().filter("count <> 1").count() == 0
    overlap = keyed.alias("l").join(
        keyed.alias("r"),
        (F.col("l.case") == F.col("r.case"))
        & (F.col("l.id") == F.col("r.id"))
        & (F.col("l._valid_from") < F.col("r._valid_from"))
        & (F.coalesce(F.col("l._valid_to"), F.lit("2999-01-01").cast("timestamp")) > F.col("r._valid_from")),
    )
    assert overlap.count() == 0


def test_same_source_again_changes_nothing(spark):
    source = spark.createDataFrame([(1, 1, "x", None, "m"), (1, 2, None, "y", "n")], SCHEMA)
    state = scd2_initial(source, TRACKED, TIMES[0])
    assert shown(scd2_apply(state, source, KEYS, TRACKED, TIMES[1])) == shown(state)


def test_untracked_change_keeps_the_row(spark):
    state = scd2_initial(spark.createDataFrame([(1, 1, "x", "y", "m")], SCHEMA), TRACKED, TIMES[0])
    source = spark.createDataFrame([(1, 1, "x", "y", "changed")], SCHEMA)
    assert shown(scd2_apply(state, source, KEYS, TRACKED, TIMES[1])) == shown(state)


def test_new_source_column_appears(spark):
    state = scd2_initial(spark.createDataFrame([(1, 1, "x", "y", "m"), (1, 2, "x", "y", "m")], SCHEMA), TRACKED, TIMES[0])
    source = spark.createDataFrame([(1, 1, "z", "y", "m", 7)], SCHEMA + ", extra int")
    result = scd2_apply(state, source, KEYS, TRACKED, TIMES[1])
    rows = sorted(map(tuple, result.select("id", "a", "extra", "_is_current").collect()))
    assert rows == [(1, "x", None, False), (1, "z", 7, True), (2, "x", None, True)]


def test_hash_tells_rows_apart(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("a", None), (None, "a"), ("~", None), (None, None), ("", None), ("1:a", "")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.select(row_hash(df, ["a", "b"])).distinct().count() == len(rows)
