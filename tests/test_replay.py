"""Rejected rows judged again under changed rules."""

import random

import pytest

from sedimenta.config import NULL_CHECK, RANGE_CHECK, Rule, TableConfig
from sedimenta.plans import replay
from sedimenta.plans.replay import exception_log, judged_again, replay_quarantine, waiting_runs
from sedimenta.plans.silver import run_silver
from sedimenta.sources.tables import read_snapshot

ROWS = "id int, name string, age int"
STRICT = [Rule("N", NULL_CHECK, "name", "name IS NOT NULL"), Rule("V", RANGE_CHECK, "age", "age > 10")]
MILD = [STRICT[0], Rule("V2", RANGE_CHECK, "age", "age > 0")]
CONFIG = TableConfig("people", ("id",), 1)


def plain(df, *columns):
    return sorted(map(tuple, df.select(*(columns or df.columns)).collect()), key=repr)


def loads(spark, root, config=CONFIG):
    first = spark.createDataFrame([(1, "ann", 20), (2, "bo", 5), (3, None, 7), (4, "cy", -1), (5, "old", 6), (None, "no id", 3)], ROWS)
    second = spark.createDataFrame([(5, "new", 50), (2, "bo late", 4), (6, "eve", 2)], ROWS)
    target = None
    for version, (rows, run) in enumerate(((first, "r1"), (second, "r2")), 1):
        run_silver(rows, target, config, STRICT, root, version, run, f"2024-0{version}-01 00:00:00", f"{root}-dlq", log_root=f"{root}-log")
        target = read_snapshot(spark, f"{root}/people", version)
    return target, first.schema


def again(spark, root, target, schema, version, run, rules=MILD, config=CONFIG):
    time = f"2024-0{version}-01 00:00:00"
    metrics = replay_quarantine(spark, schema, target, config, rules, root, version, run, time, f"{root}-dlq", f"{root}-log")
    counts = ("records_read", "records_accepted", "records_rejected", "records_superseded")
    return tuple(metrics.select(*counts).first()), read_snapshot(spark, f"{root}/people", version)


def test_each_accepted_row_moves_once(spark, tmp_path):
    root = str(tmp_path / "s")
    target, schema = loads(spark, root)
    assert plain(target, "id", "name") == [(1, "ann"), (5, "new")]
    counts, after = again(spark, root, target, schema, 3, "r3")
    # 5 was loaded after its rejection, the first row of 2 was rejected again later.
    assert counts == (7, 3, 2, 2) and counts[0] == sum(counts[1:])
    assert plain(after, "id", "name", "_pipeline_run_id") == [
        (1, "ann", "r1"), (2, "bo late", "r3"), (5, "new", "r2"), (6, "eve", "r3"), (None, "no id", "r3"),
    ]
    # A repeated run changes nothing; the next one finds what is still rejected.
    assert again(spark, root, target, schema, 3, "r3")[0] == counts
    assert waiting_runs(spark, f"{root}-dlq", f"{root}-log", "people", "r4") == ["r3"]
    counts, same = again(spark, root, after, schema, 4, "r4")
    assert counts == (2, 0, 2, 0) and plain(same) == plain(after)
    counts, last = again(spark, root, same, schema, 5, "r5", rules=[])
    assert counts == (2, 2, 0, 0) and last.count() == same.count() + 2
    assert again(spark, root, last, schema, 6, "r6")[0] == (0, 0, 0, 0)
    log = exception_log(spark, f"{root}-log")
    assert plain(log, "pipeline_run_id", "rule_id", "exception_count") == [
        ("r1", "N", 1), ("r1", "V", 5), ("r2", "V", 2), ("r3", "N", 1), ("r3", "V2", 1), ("r4", "N", 1), ("r4", "V2", 1),
    ]


def test_history_tables(spark, tmp_path):
    root, config = str(tmp_path / "h"), TableConfig("people", ("id",), 2, ("name", "age"))
    target, schema = loads(spark, root, config)
    _, after = again(spark, root, target, schema, 3, "r3", config=config)
    current = after.filter("_is_current")
    assert plain(current, "id", "name") == [(1, "ann"), (2, "bo late"), (5, "new"), (6, "eve"), (None, "no id")]


@pytest.mark.parametrize("step", ["write_exception_log", "write_snapshot"])
def test_a_replay_that_failed_is_run_again(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path / "f")
    target, schema = loads(spark, root)

    def fails(*_, **__):
        raise OSError("no room")

    with monkeypatch.context() as broken:
        broken.setattr(replay, step, fails)
        with pytest.raises(OSError):
            again(spark, root, target, schema, 3, "r3")
    counts, after = again(spark, root, target, schema, 3, "r3")
    assert counts == (7, 3, 2, 2) and after.count() == 5


def test_counts_add_up_over_random_runs(spark, tmp_path):
    pick = random.Random(4)
    kinds = f"{ROWS}, _failed_rules array<string>, _pipeline_run_id string, _rejection_timestamp timestamp"
    import datetime as dt

    rows = [
        (pick.choice([*range(8), None]), pick.choice(["a", None]), pick.randrange(-5, 20), ["V"], f"r{m}", dt.datetime(2024, m, 1))
        for m in (pick.randrange(1, 6) for _ in range(60))
    ]
    held = spark.createDataFrame([(k, dt.datetime(2024, 3, 15)) for k in range(4)], "id int, _load_timestamp timestamp")
    out = judged_again(spark.createDataFrame(rows, kinds), held, ["id"], MILD).collect()
    assert len(out) == 60
    by_key = {}
    for r in out:
        if r._outcome != "superseded" and r.id is not None:
            assert r.id not in by_key
            by_key[r.id] = r
        passes = r.name is not None and r.age > 0
        assert r._outcome in ("superseded", "accepted" if passes else "rejected")
        if r.id is None:
            assert r._outcome != "superseded"
        elif r.id < 4 and r._rejection_timestamp < dt.datetime(2024, 3, 15):
            assert r._outcome == "superseded"
    assert judged_again(spark.createDataFrame([], kinds), None, ["id"], MILD).count() == 0
