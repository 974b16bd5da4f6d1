"""Versions made of partitions that earlier loads wrote."""

import glob

import pytest
from pyspark.sql import functions as F

from sedimenta.sinks import partitions, tables
from sedimenta.sinks.partitions import replace_version, upsert_version, write_partitions
from sedimenta.sinks.tables import (
    create_database,
    publish,
    register_table,
    register_version,
    replace_partitions,
    upsert_into_partitions,
    write_snapshot,
)
from sedimenta.sources.tables import read_snapshot, snapshot_path
from sedimenta.sources.versions import partition_places

COLUMNS = "k string, n int, d int"
FIRST = [("A", 1, 1), ("B", 2, 2), ("C", 3, 3), ("D", 4, 3), ("E", 5, 4), ("N", 6, None)]
# B moves and leaves its day empty, C changes, F opens a day, N gets one, M has none.
SECOND = [("B", 20, 4), ("C", 30, 3), ("F", 6, 5), ("N", 60, 1), ("M", 7, None)]
AFTER = [("A", 1, 1), ("B", 20, 4), ("C", 30, 3), ("D", 4, 3), ("E", 5, 4), ("F", 6, 5), ("M", 7, None), ("N", 60, 1)]


def plain(df):
    return sorted(map(tuple, df.select("k", "n", "d").collect()), key=repr)


def rows(spark, data):
    return spark.createDataFrame(data, COLUMNS)


def files(root, version):
    return {f.split(f"version={version:010d}/")[1] for f in glob.glob(f"{snapshot_path(root, version)}/*/*.parquet")}


def test_every_version_reads_whole(spark, tmp_path):
    root = str(tmp_path)
    write_snapshot(rows(spark, FIRST), root, 1, ["d"])
    before = files(root, 1)
    assert plain(upsert_version(rows(spark, SECOND), ["k"], "d", root, 2)) == sorted(AFTER, key=repr)
    third = replace_version(rows(spark, [("Z", 9, 4)]), "d", 4, root, 3)
    kept = [r for r in AFTER if r[2] is None or r[2] < 4]
    assert plain(third) == sorted([*kept, ("Z", 9, 4)], key=repr)
    assert plain(read_snapshot(spark, root, 1)) == sorted(FIRST, key=repr)
    assert plain(read_snapshot(spark, root, 2)) == sorted(AFTER, key=repr)
    assert plain(read_snapshot(spark, root, 3, third.schema)) == plain(third)
    assert files(root, 1) == before
    # Only touched partitions were written; the others are named where they lie.
    assert {f.split("/")[0] for f in files(root, 2)} == {"d=1", "d=3", "d=4", "d=5", "d=__HIVE_DEFAULT_PARTITION__"}
    assert partition_places(spark, root, 3) == {"d=1": 2, "d=3": 2, "d=4": 3, "d=__HIVE_DEFAULT_PARTITION__": 2}
    # A filter on the partition column still prunes.
    plan = read_snapshot(spark, root, 2).filter("d = 3")._jdf.queryExecution().executedPlan().toString()
    assert "(d#" in plan[plan.index("PartitionFilters") :][:80]


def test_a_load_by_another_base(spark, tmp_path):
    root = str(tmp_path)
    write_snapshot(rows(spark, FIRST), root, 1, ["d"])
    upsert_version(rows(spark, SECOND), ["k"], "d", root, 2)
    again = upsert_version(rows(spark, [("A", 0, 1)]), ["k"], "d", root, 3, base=1)
    assert plain(again) == sorted([("A", 0, 1), *FIRST[1:]], key=repr)


def test_published_versions(spark, tmp_path):
    root = str(tmp_path / "t")
    create_database(spark, "versions_db", str(tmp_path / "db"))
    write_snapshot(rows(spark, FIRST), root, 1, ["d"])
    second = upsert_version(rows(spark, SECOND), ["k"], "d", root, 2)
    for version, wanted in ((1, FIRST), (2, AFTER), (2, AFTER), (1, FIRST), (2, AFTER)):
        publish(spark, "versions_db.now", root, version)
        assert plain(spark.table("versions_db.now")) == sorted(wanted, key=repr)
    register_version(spark, "versions_db.second", second.schema, root, 2, ["d"])
    assert plain(spark.table("versions_db.second")) == sorted(AFTER, key=repr)
    register_version(spark, "versions_db.first", second.schema, root, 1, ["d"])
    assert plain(spark.table("versions_db.first")) == sorted(FIRST, key=repr)


def test_a_load_that_failed_is_run_again(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    write_snapshot(rows(spark, FIRST), root, 1, ["d"])

    def fails(*_, **__):
        raise OSError("no room")

    with monkeypatch.context() as broken:
        broken.setattr(partitions, "write_manifest", fails)
        with pytest.raises(OSError):
            upsert_version(rows(spark, SECOND), ["k"], "d", root, 2)
    # The folder holds partitions only, so it is no version.
    with pytest.raises(ValueError, match="not complete"):
        read_snapshot(spark, root, 2)
    assert plain(upsert_version(rows(spark, SECOND), ["k"], "d", root, 2)) == sorted(AFTER, key=repr)
    # Once complete, a repeated load writes nothing.
    before = files(root, 2)
    assert plain(upsert_version(rows(spark, SECOND), ["k"], "d", root, 2)) == sorted(AFTER, key=repr)
    assert files(root, 2) == before
    with pytest.raises(ValueError, match="complete"):
        write_snapshot(rows(spark, FIRST), root, 2, ["d"])


@pytest.mark.parametrize("how", ["upsert", "replace"])
def test_pointing_that_failed_is_taken_up(spark, tmp_path, monkeypatch, how):
    root, name = str(tmp_path / "t"), f"pointing.{how}"
    create_database(spark, "pointing", str(tmp_path / "db"))
    first = [r for r in FIRST if r[2]]
    write_snapshot(rows(spark, first), root, 1, ["d"])
    register_table(spark, name, rows(spark, []).schema, snapshot_path(root, 1), ["d"])
    second = [r for r in SECOND if r[0] in "BCF"]

    def load():
        if how == "upsert":
            return upsert_into_partitions(name, rows(spark, second), ["k"], "d", root, 2)
        return replace_partitions(name, rows(spark, [("Z", 0, 3), ("Y", 1, 9)]), "d", 3, root, 2)

    sql, done = spark.sql, []

    def stops(text, *args, **kwargs):
        if text.startswith("ALTER"):
            if len(done) == 1:
                raise OSError("catalog gone")
            done.append(text)
        return sql(text, *args, **kwargs)

    with monkeypatch.context() as broken:
        broken.setattr(spark, "sql", stops)
        with pytest.raises(OSError):
            load()
    touched = load()
    if how == "upsert":
        assert touched == [2, 3, 4, 5]
        wanted = [("A", 1, 1), ("B", 20, 4), ("C", 30, 3), ("D", 4, 3), ("E", 5, 4), ("F", 6, 5)]
    else:
        wanted = [("A", 1, 1), ("B", 2, 2), ("Y", 1, 9), ("Z", 0, 3)]
    assert plain(spark.table(name)) == wanted
    assert plain(read_snapshot(spark, root, 1)) == first


def test_rows_without_a_partition_in_a_registered_table(spark, tmp_path):
    root = str(tmp_path / "t")
    create_database(spark, "no_value", str(tmp_path / "db"))
    write_snapshot(rows(spark, FIRST[:-1]), root, 1, ["d"])
    register_table(spark, "no_value.t", rows(spark, []).schema, snapshot_path(root, 1), ["d"])
    with pytest.raises(Exception, match="no partition"):
        upsert_into_partitions("no_value.t", rows(spark, SECOND), ["k"], "d", root, 2)


def test_partition_names_and_a_column_named_version(spark, tmp_path):
    root = str(tmp_path / "t")
    create_database(spark, "odd_names", str(tmp_path / "db"))
    first = spark.createDataFrame([(1, "a/b", 1), (2, "x=y", 1), (3, "it's é", 2), (4, "", 7)], "k int, p string, version int")
    wanted = sorted((r.k, r.p or None, r.version) for r in first.collect())

    def found(df):
        return sorted(map(tuple, df.select("k", "p", "version").collect()))

    write_partitions(first, root, 1, ["version", "p"])
    assert found(read_snapshot(spark, root, 1)) == wanted
    change = spark.createDataFrame([(5, "a/b", 1)], "k int, p string, version int")
    write_partitions(change, root, 2, ["version", "p"], base=1)
    after = sorted([r for r in wanted if r[0] != 1] + [(5, "a/b", 1)])
    assert found(read_snapshot(spark, root, 2)) == after and found(read_snapshot(spark, root, 1)) == wanted
    publish(spark, "odd_names.t", root, 2)
    assert found(spark.table("odd_names.t")) == after


def test_new_columns_and_an_emptied_table(spark, tmp_path):
    root = str(tmp_path)
    write_snapshot(rows(spark, FIRST), root, 1, ["d"])
    wider = rows(spark, [("A", 1, 1)]).withColumn("more", F.lit("x"))
    write_partitions(wider, root, 2, ["d"], base=1)
    assert {(r.k, r.more) for r in read_snapshot(spark, root, 2).collect()} == {("A", "x")} | {(r[0], None) for r in FIRST[1:]}
    empty = replace_version(rows(spark, []), "d", 0, root, 3, base=1, without_value=rows(spark, []))
    assert empty.collect() == [] and empty.schema == rows(spark, []).schema
    with pytest.raises(ValueError, match="not partitioned"):
        write_snapshot(rows(spark, FIRST), f"{root}/flat", 1)
        write_partitions(rows(spark, FIRST), f"{root}/flat", 2, ["d"], base=1)


def test_large_numbers_of_partitions_are_added_in_steps(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "_TOGETHER", 2)
    root = str(tmp_path / "t")
    create_database(spark, "steps", str(tmp_path / "db"))
    write_partitions(rows(spark, FIRST), root, 1, ["d"])
    publish(spark, "steps.t", root, 1)
    assert plain(spark.table("steps.t")) == sorted(FIRST, key=repr)
