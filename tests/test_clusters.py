"""Clustered tables that grow."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from sedimenta.session import stored
from sedimenta.sinks import clusters
from sedimenta.sinks.clusters import (
    DataFile,
    append_clusters,
    cluster_again,
    data_files,
    overlapping,
    read_clusters,
    start_clusters,
)


def plain(df):
    return sorted(map(tuple, df.collect()), key=repr)


def days(spark, first, last, step=1):
    return spark.range(first, last, step, 4).selectExpr("id", "date_add(DATE'2024-01-01', CAST(id / 20 AS INT)) AS day", "'c' || (id * 7919) % 1000 AS who")


def brute(files, depth):
    """Files that are open with depth - 1 others at some point strictly inside."""
    cuts = sorted({f.low for f in files} | {f.high for f in files})
    picked = set()
    for a, b in zip(cuts, cuts[1:], strict=False):
        here = [f for f in files if f.low <= a and f.high >= b and f.high > f.low]
        if len(here) >= depth:
            picked |= set(here)
    return picked


def test_overlapping_files():
    pick = random.Random(2)
    for _ in range(300):
        files = [DataFile(str(i), 1, *sorted(pick.choices(range(30), k=2))) for i in range(pick.randrange(12))]
        for depth in (2, 3):
            assert set(overlapping(files, depth)) == brute(files, depth), files


def hits(spark, root, version, cell):
    return sum(f.low <= cell <= f.high for f in data_files(spark, root, version))


@pytest.mark.parametrize("columns", [["day"], ["day", "who"]])
def test_only_overlapping_files_are_written_again(spark, tmp_path, columns):
    root = str(tmp_path / "t")
    first = stored(days(spark, 0, 8000), "days")
    start_clusters(first, columns, root, files=16)
    before = {f: open(f, "rb").read() for f in glob.glob(f"{root}/version=0000000001/*.parquet")}
    assert len(before) >= 12 and not overlapping(data_files(spark, root, 1))
    late = days(spark, 6001, 8400, 3)  # some of the newest days again, and new ones
    grown = append_clusters(late, root, 2, files=4)
    everything = plain(first.union(late))
    assert plain(grown) == everything
    again = cluster_again(spark, root, 3)
    assert plain(again) == everything and not overlapping(data_files(spark, root, 3))
    kept = [f for f in data_files(spark, root, 3) if f.path.startswith("version=0000000001")]
    if columns == ["day"]:
        assert len(kept) >= len(before) // 2
    assert kept == [f for f in data_files(spark, root, 1) if f in kept]
    assert {f: open(f, "rb").read() for f in before} == before
    assert plain(read_clusters(spark, root, 1)) == plain(first) and plain(read_clusters(spark, root, 2)) == everything
    # A cell is looked for in about as many files as if all rows had been clustered at once.
    whole = str(tmp_path / "whole")
    start_clusters(stored(first.union(late), "all"), columns, whole, files=20)
    for frame, place, version in ((again, root, 3), (read_clusters(spark, whole, 1), whole, 1)):
        cells = [f.low for f in data_files(spark, place, version)]
        assert frame.columns == first.columns
        assert sum(hits(spark, place, version, c) for c in cells) <= 2.5 * len(cells)
    # Nothing overlaps any more: the next version has the same files.
    assert plain(cluster_again(spark, root, 4)) == everything
    assert data_files(spark, root, 4) == data_files(spark, root, 3)


def test_a_hot_value_fills_several_files(spark, tmp_path):
    root = str(tmp_path)
    rows = stored(spark.range(0, 30_000, 1, 4).selectExpr("IF(id % 3 = 0, 5, id % 1000) AS v", "id"), "hot")
    start_clusters(rows, ["v"], root, files=12)
    assert max(f.rows for f in data_files(spark, root, 1)) < 5000
    assert not overlapping(data_files(spark, root, 1))


def test_nulls_an_empty_table_and_loads_that_failed(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "n")
    rows = stored(spark.createDataFrame([(None, 1), (5, None), (7, 3), (None, None)], "a int, b int"), "n")
    assert plain(start_clusters(rows, ["a", "b"], root)) == plain(rows)
    assert plain(append_clusters(rows, root, 2)) == plain(rows.union(rows))

    def fails(*_, **__):
        raise OSError("no room")

    with monkeypatch.context() as broken:
        broken.setattr(clusters, "_list", fails)
        with pytest.raises(OSError):
            cluster_again(spark, root, 3)
    for _ in range(2):
        assert plain(cluster_again(spark, root, 3)) == plain(rows.union(rows))
    empty = start_clusters(rows.limit(0), ["a"], str(tmp_path / "e"))
    assert empty.count() == 0
    more = append_clusters(rows, str(tmp_path / "e"), 2).filter(F.col("a").isNotNull())
    assert more.count() == 2
