"""Tables in key-hash folders against the operators on whole tables."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from sedimenta.config import RawConfig, TableConfig
from sedimenta.operators.changes import apply_changes
from sedimenta.operators.history import scd2_apply, scd2_initial
from sedimenta.plans.bronze import run_raw_load
from sedimenta.plans.silver import run_silver
from sedimenta.session import stored
from sedimenta.sinks import partitions
from sedimenta.sinks.buckets import (
    BUCKET,
    apply_guarded,
    bucket_count,
    current_part,
    live_rows,
    load_history,
    start_buckets,
    start_guarded,
    start_history,
)
from sedimenta.sources.tables import read_snapshot, snapshot_path

KEYS, TRACKED = ["k"], ["v", "w"]
ORDER = ("_cdc_version", "_cdc_seq")
CHANGE = "k int, v string, _cdc_operation_code int, _cdc_version long, _cdc_seq long"


def plain(df, *columns):
    return sorted(map(tuple, df.select(*(columns or sorted(df.columns))).collect()), key=repr)


def files(root, version):
    return {f.split(f"version={version:010d}/")[1] for f in glob.glob(f"{snapshot_path(root, version)}/*/*.parquet")}


def people(spark, pick, n):
    keys = pick.sample(range(60), n)
    data = [(k, pick.choice("ab"), pick.choice(["x", None])) for k in keys] + [(None, pick.choice("ab"), None)]
    return spark.createDataFrame(data, "k int, v string, w string")


def test_history_loads_equal_loads_of_whole_tables(spark, tmp_path):
    root, pick = str(tmp_path), random.Random(3)
    times = [f"2024-0{m}-01 00:00:00" for m in range(1, 7)]
    first = people(spark, pick, 40)
    whole = stored(scd2_initial(first, TRACKED, times[0]), "whole")
    start_history(whole, KEYS, root, 8)
    states = [plain(whole)]
    for version, time in enumerate(times[1:], 2):
        batch = people(spark, pick, 20)
        if version == 4:
            batch = batch.withColumn("more", F.lit("m"))
        whole = stored(scd2_apply(whole, batch, KEYS, TRACKED, time), "whole")
        state = load_history(batch, KEYS, TRACKED, root, version, time)
        assert plain(state.drop(BUCKET)) == plain(whole)
        assert plain(current_part(state).drop(BUCKET)) == plain(whole.filter("_is_current"))
        states.append(plain(whole))
    for version, wanted in enumerate(states, 1):  # every older version still reads whole
        columns = sorted(c for c in read_snapshot(spark, root, version).columns if c != BUCKET)
        assert plain(read_snapshot(spark, root, version), *columns) == wanted
    assert bucket_count(spark, root, 6) == 8


def test_only_folders_with_changes_are_written(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.range(400).selectExpr("CAST(id AS INT) AS k", "'a' AS v", "'b' AS w")
    start_history(scd2_initial(rows, TRACKED, "2024-01-01 00:00:00"), KEYS, root, 16)
    before = files(root, 1)
    # All keys arrive, three of them changed.
    batch = rows.withColumn("v", F.when(F.col("k").isin(7, 70, 700), "z").otherwise(F.col("v")))
    state = load_history(batch, KEYS, TRACKED, root, 2, "2024-02-01 00:00:00")
    assert state.count() == 402 and files(root, 1) == before
    written = {f.split("/")[0] for f in files(root, 2)}
    assert f"{BUCKET}=-2" in written and len(written) <= 3
    plan = current_part(state)._jdf.queryExecution().executedPlan().toString()
    assert f"({BUCKET}#" in plan[plan.index("PartitionFilters") :][:120]
    # Nothing changes: a version with no files.
    same = load_history(batch, KEYS, TRACKED, root, 3, "2024-03-01 00:00:00")
    assert plain(same) == plain(state) and not files(root, 3)
    with pytest.raises(Exception, match="share one key"):
        load_history(batch.union(batch.limit(1)), KEYS, TRACKED, root, 4, "2024-03-01 00:00:00").count()


def test_a_history_load_that_failed_is_run_again(spark, tmp_path, monkeypatch):
    root, time = str(tmp_path), "2024-02-01 00:00:00"
    rows = spark.range(20).selectExpr("CAST(id AS INT) AS k", "'a' AS v", "'b' AS w")
    start_history(scd2_initial(rows, TRACKED, "2024-01-01 00:00:00"), KEYS, root, 4)
    batch = rows.withColumn("v", F.lit("z"))

    def fails(*_, **__):
        raise OSError("no room")

    with monkeypatch.context() as broken:
        broken.setattr(partitions, "write_manifest", fails)
        with pytest.raises(OSError):
            load_history(batch, KEYS, TRACKED, root, 2, time)
    for _ in range(2):
        state = load_history(batch, KEYS, TRACKED, root, 2, time)
        assert state.count() == 40 and state.filter("_is_current").count() == 20


def feed(pick, n=300):
    rows = []
    for seq in range(n):
        key = pick.choice([*range(25), None])
        rows.append((key, f"v{seq}", pick.choice((1, 2, 3, 4, 9)), seq // 4, seq))
    return rows


def expected(initial, rows):
    """Key to value after all changes in log order."""
    state = dict(initial)
    for key, value, code, _, _ in sorted(rows, key=lambda r: r[4]):
        if code == 1:
            state.pop(key, None)
        elif code != 3:
            state[key] = value
    return sorted(state.items(), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_overlapping_late_and_repeated_windows(spark, tmp_path, seed):
    root, pick = str(tmp_path), random.Random(seed)
    initial, rows = [(k, "old") for k in range(0, 60, 2)], feed(pick)
    copy = spark.createDataFrame(initial, "k int, v string")
    start_guarded(copy, KEYS, root, 8, ORDER)
    cuts = sorted(pick.sample(range(300), 5))
    windows = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, 300], strict=True)]
    windows += [rows[max(0, a - 40) : a + 60] for a in cuts]  # overlaps
    pick.shuffle(windows)
    windows.append(rows[:50])  # the oldest again, at last
    for version, window in enumerate(windows, 2):
        state = apply_guarded(spark.createDataFrame(window, CHANGE), KEYS, root, version, f"r{version}", "2024-01-01 00:00:00")
    assert plain(live_rows(state), "k", "v") == expected(initial, rows)
    again = apply_guarded(spark.createDataFrame(rows, CHANGE), KEYS, root, version + 1, "again", "2024-01-02 00:00:00")
    assert plain(again) == plain(state) and not files(root, version + 1)


def test_one_batch_equals_the_plain_merge(spark, tmp_path):
    root, rows = str(tmp_path), [r for r in feed(random.Random(9)) if r[0] is not None]
    copy = spark.createDataFrame([(k, "old") for k in range(40)], "k int, v string")
    start_guarded(copy, KEYS, root, 4, ORDER)
    changes = spark.createDataFrame(rows, CHANGE)
    state = live_rows(apply_guarded(changes, KEYS, root, 2, "r", "2024-01-01 00:00:00"))
    whole = apply_changes(copy, changes, KEYS, "r", "2024-01-01 00:00:00")
    assert plain(state) == plain(whole)


def test_changes_up_to_the_copy_are_not_applied(spark, tmp_path):
    root = str(tmp_path)
    start_guarded(spark.createDataFrame([(1, "copied")], "k int, v string"), KEYS, root, 2, ORDER, at=(5, 20))
    changes = spark.createDataFrame([(1, "before", 4, 5, 20), (2, "new", 2, 5, 19)], CHANGE)
    state = apply_guarded(changes, KEYS, root, 2, "r", "2024-01-01 00:00:00")
    assert plain(live_rows(state), "k", "v") == [(1, "copied"), (2, "new")]
    state = apply_guarded(spark.createDataFrame([(1, None, 1, 5, 21)], CHANGE), KEYS, root, 3, "r", "2024-01-01 00:00:00")
    assert plain(live_rows(state), "k", "v") == [(2, "new")]
    state = apply_guarded(spark.createDataFrame([(1, "late", 4, 5, 20)], CHANGE), KEYS, root, 4, "r", "2024-01-01 00:00:00")
    assert plain(live_rows(state), "k", "v") == [(2, "new")]


def test_bytes_written_follow_the_batch(spark, tmp_path):
    root = str(tmp_path)
    copy = spark.range(20_000).selectExpr("CAST(id AS INT) AS k", "'value ' || id AS v")
    start_guarded(copy, KEYS, root, 32, ORDER)
    before = files(root, 1)
    changes = spark.createDataFrame([(5, "x", 4, 1, 1), (5, "y", 4, 1, 2), (6, None, 1, 2, 3)], CHANGE)
    state = apply_guarded(changes, KEYS, root, 2, "r", "2024-01-01 00:00:00")
    assert live_rows(state).count() == 19_999 and files(root, 1) == before
    assert len({f.split("/")[0] for f in files(root, 2)}) <= 2


def test_several_keys_and_a_table_of_no_rows(spark, tmp_path):
    copy = spark.createDataFrame([], "a int, b string, v string")
    start_buckets(copy, ["a", "b"], f"{tmp_path}/empty", 4)
    assert read_snapshot(spark, f"{tmp_path}/empty", 1).collect() == []
    root = f"{tmp_path}/two"
    start_guarded(copy, ["a", "b"], root, 4, ORDER)
    kinds = "a int, b string, v string, _cdc_operation_code int, _cdc_version long, _cdc_seq long"
    changes = spark.createDataFrame([(1, None, "x", 2, 1, 1), (1, "p", "y", 2, 1, 2), (1, None, "z", 4, 2, 3)], kinds)
    for version in (2, 3):
        state = apply_guarded(changes, ["a", "b"], root, version, "r", "2024-01-01 00:00:00")
        assert plain(live_rows(state), "a", "b", "v") == [(1, "p", "y"), (1, None, "z")]


def test_loads_by_setting_in_buckets(spark, tmp_path):
    root = str(tmp_path)
    row = {"table_name": "t", "primary_key_columns": "k", "load_type": "CDC"}
    source = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    copied = run_raw_load(RawConfig.from_row(row), source, None, root, 1, "r1", "2024-01-01 00:00:00", buckets=4)
    assert copied.metrics.schema["high_water_mark"].dataType.simpleString() == "bigint"
    ready = RawConfig.from_row({**row, "initial_load_completed": True, "last_sync_version": 3})
    changes = spark.createDataFrame([(1, "x", 4, 4, 1), (2, None, 1, 5, 2), (9, "skipped", 2, 3, 3)], CHANGE)
    loaded = run_raw_load(ready, changes, copied.state, root, 2, "r2", "2024-01-02 00:00:00", buckets=4)
    assert plain(loaded.state, "k", "v", "_cdc_operation", "_pipeline_run_id") == [(1, "x", "UPDATE", "r2")]
    assert plain(loaded.metrics, "records_read", "records_deleted", "high_water_mark") == [(2, 1, 5)]


def test_silver_history_in_buckets(spark, tmp_path):
    config = TableConfig("people", ("k",), 2, ("v",))
    root, whole = str(tmp_path / "buckets"), str(tmp_path / "whole")
    target = None
    for version in (1, 2, 3):
        time = f"2024-0{version}-01 00:00:00"
        batch = spark.range(30).selectExpr("CAST(id AS INT) AS k", f"IF(id % {version} = 0, 'a', 'b') AS v")
        for place, buckets in ((root, 8), (whole, None)):
            run_silver(batch, target, config, [], place, version, f"r{version}", time, f"{place}-dlq", buckets=buckets)
        target = read_snapshot(spark, f"{whole}/people", version)
        assert plain(read_snapshot(spark, f"{root}/people", version).drop(BUCKET)) == plain(target)
    with pytest.raises(ValueError, match="layout"):
        run_silver(batch, None, TableConfig("p", ("k",), 1), [], root, 1, "r", time, root, buckets=8)
