"""Facts of unknown dimension rows get their keys once these arrive."""

import glob

import pytest

from sedimenta.plans import late_keys
from sedimenta.plans.late_keys import Reference, next_open_references, open_references, rekey_facts
from sedimenta.sinks.tables import write_snapshot
from sedimenta.sources.tables import read_snapshot, snapshot_path

REFERENCES = [Reference("c_key", "customer", "customer_id"), Reference("l_key", "place", "place_id")]
FACTS = "n string, c_key long, l_key long, amount int, d int"
ROWS = [("A", 1, 5, 10, 1), ("B", -1, 5, 20, 1), ("C", -1, -1, 30, 2), ("D", 2, -1, 40, 3), ("E", 1, 5, 50, 4), ("F", -1, 5, 60, 5)]
SOURCE = [("A", 100, "x"), ("B", 300, "x"), ("C", 400, "y"), ("D", 200, None), ("E", 100, "x"), ("F", None, "x")]


def plain(df, *columns):
    return sorted(map(tuple, df.select(*(columns or df.columns)).collect()), key=repr)


@pytest.fixture
def table(spark, tmp_path):
    facts = write_snapshot(spark.createDataFrame(ROWS, FACTS), f"{tmp_path}/facts", 1, ["d"])
    source = spark.createDataFrame(SOURCE, "n string, customer int, place string")
    waiting = open_references(facts, source, ["n"], "d", REFERENCES)
    write_snapshot(waiting, f"{tmp_path}/open", 1)
    return str(tmp_path)


def dims(spark, customers, places):
    return {
        "c_key": spark.createDataFrame(customers, "customer_id long, c_key long"),
        "l_key": spark.createDataFrame(places, "place_id string, l_key long"),
    }


def rekey(spark, root, version, dimensions):
    return rekey_facts(spark, f"{root}/facts", f"{root}/open", version, ["n"], "d", REFERENCES, dimensions)


def test_open_references(spark, table):
    # NULL in the source waits for nothing.
    assert plain(read_snapshot(spark, f"{table}/open", 1), "n", "d", "reference", "wanted") == [
        ("B", 1, "c_key", "300"), ("C", 2, "c_key", "400"), ("C", 2, "l_key", "y"),
    ]


def test_facts_that_carry_their_source(spark):
    rows = [*ROWS, (None, -1, -1, 70, 6)]
    facts = spark.createDataFrame(rows, FACTS)
    source = spark.createDataFrame([*SOURCE, (None, 500, "z")], "n string, customer int, place string")
    whole = [row + kept[1:] for row, kept in zip(rows, [*SOURCE, (None, 500, "z")], strict=True)]
    carrying = spark.createDataFrame(whole, f"{FACTS}, customer int, place string")
    found = open_references(carrying, None, ["n"], "d", REFERENCES)
    assert plain(found) == plain(open_references(facts, source, ["n"], "d", REFERENCES)) != []
    # Repeated facts meet every row of their key, as in a join with the source.
    twice = spark.createDataFrame([*whole, ("B", 2, 5, 20, 1, 200, "x"), whole[2]], carrying.schema)
    found = open_references(twice, None, ["n"], "d", REFERENCES)
    assert plain(found) == plain(open_references(twice, twice, ["n"], "d", REFERENCES))
    assert ("B", 1, "c_key", "200") in plain(found, "n", "d", "reference", "wanted")


def test_only_partitions_with_resolved_references_are_written(spark, table):
    second = rekey(spark, table, 2, dims(spark, [(-1, -1), (100, 1), (200, 2), (300, 3)], [("x", 5)]))
    assert plain(second, "n", "c_key", "l_key") == [
        ("A", 1, 5), ("B", 3, 5), ("C", -1, -1), ("D", 2, -1), ("E", 1, 5), ("F", -1, 5),
    ]
    assert {p.split("d=")[1] for p in glob.glob(f"{snapshot_path(f'{table}/facts', 2)}/d=*")} == {"1"}
    # What is resolved is not looked up again; a changed dimension leaves known keys alone.
    third = rekey(spark, table, 3, dims(spark, [(300, 9), (400, 4)], [("x", 7), ("y", 6)]))
    assert plain(third, "n", "c_key", "l_key") == [
        ("A", 1, 5), ("B", 3, 5), ("C", 4, 6), ("D", 2, -1), ("E", 1, 5), ("F", -1, 5),
    ]
    assert read_snapshot(spark, f"{table}/open", 3).count() == 0
    assert plain(read_snapshot(spark, f"{table}/facts", 1)) == sorted(ROWS, key=repr)
    again = rekey(spark, table, 4, dims(spark, [(300, 9)], []))
    assert plain(again) == plain(third) and not glob.glob(f"{snapshot_path(f'{table}/facts', 4)}/d=*")


def test_a_run_that_failed_between_its_writes(spark, table, monkeypatch):
    dimensions = dims(spark, [(300, 3), (400, 4)], [])

    def fails(*_, **__):
        raise OSError("no room")

    with monkeypatch.context() as broken:
        broken.setattr(late_keys, "write_snapshot", fails)
        with pytest.raises(OSError):
            rekey(spark, table, 2, dimensions)
    facts = rekey(spark, table, 2, dimensions)
    assert plain(facts.filter("c_key = -1"), "n") == [("F",)]
    assert plain(read_snapshot(spark, f"{table}/open", 2), "n", "reference") == [("C", "l_key")]


def test_open_references_after_a_load(spark, table):
    old = read_snapshot(spark, f"{table}/open", 1)
    rebuilt = spark.createDataFrame([("B", -1, 5, 1, 9), ("G", 1, -1, 1, 9)], FACTS)
    source = spark.createDataFrame([("B", 301, "x"), ("G", 100, "z")], "n string, customer int, place string")
    new = open_references(rebuilt, source, ["n"], "d", REFERENCES)
    assert plain(next_open_references(old, new, rebuilt, ["n"]), "n", "d", "reference", "wanted") == [
        ("B", 9, "c_key", "301"), ("C", 2, "c_key", "400"), ("C", 2, "l_key", "y"), ("G", 9, "l_key", "z"),
    ]
    assert plain(next_open_references(None, new, rebuilt, ["n"])) == plain(new)
