"""Approximate nearest neighbours: a navigable small-world graph per shard."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.vectors import blocked, matrix, spread, usable
from sedimenta.session import stored

#: Links per node on the ground level and above, and beams for building and searching.
GROUND_LINKS, UPPER_LINKS, BUILD_BEAM, SEARCH_BEAM = 24, 12, 64, 128
#: Nodes inserted together, and beam entries expanded together.
_TOGETHER, _WIDTH = 256, 4


class Graph:
    """A hierarchy of neighbour arrays over one shard's vectors.

    Nodes are numbered by falling level, so level ``l`` is an array of its first
    ``len(levels[l])`` nodes, one row of neighbour numbers each (-1: none), and
    node 0 is the entry of all.
    """

    def __init__(self, vectors: np.ndarray, levels: list[np.ndarray]):
        self.vectors = vectors
        self.levels = levels

    @classmethod
    def built(cls, vectors: np.ndarray, heights: np.ndarray) -> Graph:
        """``heights``: each node's level, falling."""
        n = len(vectors)
        sizes = [int((heights >= level).sum()) for level in range(int(heights[0]) + 1 if n else 1)]
        levels = [np.full((s, UPPER_LINKS if i else GROUND_LINKS), -1, np.int32) for i, s in enumerate(sizes)]
        graph = cls(vectors, levels)
        at = 1
        while at < n:
            # Not more at once than the graph holds already.
            end = min(n, at + min(_TOGETHER, at))
            graph._insert(np.arange(at, end))
            at = end
        return graph

    def _insert(self, new: np.ndarray) -> None:
        x = self.vectors[new]
        entry = np.zeros(len(new), np.int64)
        mates = _distances(x, np.broadcast_to(x, (len(new), *x.shape)))
        np.fill_diagonal(mates, np.inf)
        for level in range(len(self.levels) - 1, -1, -1):
            links = self.levels[level]
            here = new < len(links)
            if not here.all():
                entry[~here] = self._beam(level, x[~here], entry[~here], 1)[0][:, 0]
            if not here.any():
                continue
            # Nodes are numbered by level: those of this level come first in the batch.
            m = int(here.sum())
            ids, dist = self._beam(level, x[:m], entry[:m], BUILD_BEAM)
            near = np.argsort(mates[:m, :m], axis=1)[:, : BUILD_BEAM // 2]
            ids = np.hstack([ids, np.where(np.isfinite(np.take_along_axis(mates[:m, :m], near, 1)), new[near], -1)])
            dist = np.hstack([dist, np.take_along_axis(mates[:m, :m], near, 1)])
            chosen = self._diverse(ids, dist, links.shape[1])
            links[new[:m]] = chosen
            self._link_back(links, new[:m], chosen)
            entry[:m] = ids[np.arange(m), np.where(ids[:, : dist.shape[1]] >= 0, dist, np.inf).argmin(axis=1)]
            # A mate may not be linked below yet; start from what was found there before.
            entry[:m] = np.where(entry[:m] >= new[0], 0, entry[:m])

    def _link_back(self, links: np.ndarray, new: np.ndarray, chosen: np.ndarray) -> None:
        to, by = chosen.ravel(), np.repeat(new, chosen.shape[1])
        by, to = by[to >= 0], to[to >= 0]
        order = np.argsort(to, kind="stable")
        to, by = to[order], by[order]
        targets, first, counts = np.unique(to, return_index=True, return_counts=True)
        for at in range(0, len(targets), _TOGETHER):
            t, f, c = (a[at : at + _TOGETHER] for a in (targets, first, counts))
            added = np.full((len(t), c.max()), -1, np.int64)
            column = np.arange(c.max())
            fill = column[None, :] < c[:, None]
            added[fill] = by[(f[:, None] + column[None, :])[fill]]
            added[(added[:, :, None] == links[t][:, None, :]).any(axis=2)] = -1  # linked already
            ids = np.hstack([links[t], added])
            dist = _distances(self.vectors[t], self.vectors[ids])
            links[t] = self._diverse(ids, np.where(ids >= 0, dist, np.inf), links.shape[1])

    def _diverse(self, ids: np.ndarray, dist: np.ndarray, most: int) -> np.ndarray:
        """Of each row's candidates, those nearer to the node than to a nearer chosen
        one; then the nearest of the rest while there is room."""
        dist = np.where(ids >= 0, dist, np.inf)
        order = np.argsort(dist, axis=1, kind="stable")
        ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
        valid = np.isfinite(dist)
        x = self.vectors[ids]
        norms = np.einsum("bcd,bcd->bc", x, x)
        between = norms[:, :, None] + norms[:, None, :] - 2 * np.matmul(x, x.transpose(0, 2, 1))
        closest = np.full(dist.shape, np.inf, np.float32)
        kept = np.zeros(dist.shape, bool)
        for j in range(dist.shape[1]):
            keep = valid[:, j] & (kept.sum(axis=1) < most) & (dist[:, j] <= closest[:, j])
            kept[:, j] = keep
            closest = np.where(keep[:, None], np.minimum(closest, between[:, :, j]), closest)
        rank = np.where(kept, 0, 1) * dist.shape[1] + np.arange(dist.shape[1])[None, :]
        rank = np.where(valid, rank, 3 * dist.shape[1])
        best = np.argsort(rank, axis=1)[:, :most]
        out = np.where(np.take_along_axis(valid, best, 1), np.take_along_axis(ids, best, 1), -1)
        if out.shape[1] < most:
            out = np.hstack([out, np.full((len(out), most - out.shape[1]), -1)])
        return out.astype(np.int32)

    def _beam(self, level: int, queries: np.ndarray, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``width`` nodes found from ``entry``, nearest first: numbers (-1:
        none) and squared distances.  All queries advance side by side."""
        links = self.levels[level]
        n = len(queries)
        ids = np.full((n, width), -1, np.int64)
        dist = np.full((n, width), np.inf, np.float32)
        ids[:, 0] = entry
        dist[:, 0] = _distances(queries, self.vectors[entry][:, None, :])[:, 0]
        done = np.zeros((n, width), bool)
        visited = np.zeros((n, len(links)), bool)
        visited[np.arange(n), entry] = True
        live = np.arange(n)
        while len(live):
            pending = (ids[live] >= 0) & ~done[live]
            live = live[pending.any(axis=1)]
            if not len(live):
                break
            pending = (ids[live] >= 0) & ~done[live]
            take = pending & (pending.cumsum(axis=1) <= _WIDTH)
            done[live] |= take
            # The numbers to expand, in up to _WIDTH columns.
            which = np.argsort(~take, axis=1, kind="stable")[:, : min(_WIDTH, width)]
            nodes = np.where(np.take_along_axis(take, which, 1), np.take_along_axis(ids[live], which, 1), -1)
            next_ids = np.where(nodes[:, :, None] >= 0, links[nodes], -1).reshape(len(live), -1)
            next_ids.sort(axis=1)
            next_ids[:, 1:][next_ids[:, 1:] == next_ids[:, :-1]] = -1
            next_ids[visited[live[:, None], next_ids]] = -1
            rows, columns = np.nonzero(next_ids >= 0)
            visited[live[rows], next_ids[rows, columns]] = True
            found = np.full(next_ids.shape, np.inf, np.float32)
            gap = self.vectors[next_ids[rows, columns]] - queries[live[rows]]
            found[rows, columns] = np.einsum("rd,rd->r", gap, gap)
            all_ids = np.hstack([ids[live], next_ids])
            all_dist = np.hstack([dist[live], found])
            all_done = np.hstack([done[live], np.zeros(next_ids.shape, bool)])
            best = np.argsort(all_dist, axis=1, kind="stable")[:, :width]
            dist[live] = np.take_along_axis(all_dist, best, 1)
            ids[live] = np.where(np.isfinite(dist[live]), np.take_along_axis(all_ids, best, 1), -1)
            done[live] = np.take_along_axis(all_done, best, 1)
        return ids, dist

    def search(self, queries: np.ndarray, beam: int) -> np.ndarray:
        """Numbers of the ``beam`` nearest nodes found (-1: none), nearest first."""
        entry = np.zeros(len(queries), np.int64)
        for level in range(len(self.levels) - 1, 0, -1):
            entry = self._beam(level, queries, entry, 1)[0][:, 0]
        return self._beam(0, queries, entry, beam)[0]


def _distances(x: np.ndarray, others: np.ndarray) -> np.ndarray:
    gap = others - x[:, None, :]
    return np.einsum("bcd,bcd->bc", gap, gap)


def _levels(ids: np.ndarray) -> np.ndarray:
    """Each node's level, from its id: geometric, a level in UPPER_LINKS goes up."""
    x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    unit = (x >> np.uint64(11)).astype(float) / float(1 << 53)
    return np.minimum(8, (-np.log(np.maximum(unit, 1e-12)) / np.log(UPPER_LINKS)).astype(int))


def _fitting(values: np.ndarray, unit: float) -> np.ndarray:
    """Single-precision copies for the graph, scaled so that no square overflows."""
    return np.ascontiguousarray(values / unit, dtype=np.float32)


_INDEX = "dim int, rb int, unit double, ids binary, copies binary, counts array<int>, vectors binary, sizes array<int>, links binary"


#: Nodes of a shard: at least, so that graphs pay, and at most, so that one is built in minutes.
LEAST_NODES, MOST_NODES = 4096, 32768


def shard_count(nodes: int, tasks: int, least: int = LEAST_NODES, most: int = MOST_NODES) -> int:
    """As few shards as their bound allows (every query visits each), but one for each of ``tasks``
    that run at once while shards do not get too small."""
    return max(1, -(-nodes // most), min(tasks, -(-nodes // least)))


def vector_index(vectors: DataFrame, k: int, shard_rows: int | None = None) -> tuple[DataFrame, int]:
    """A graph per shard as one row of flat arrays, in the shared folder, and the
    number of shards (by :func:`shard_count`, or of ``shard_rows`` nodes each).

    A node is a distinct vector; its members are the rows that hold it.  Every row that
    can be in a result is a member: a query leaves out its own id only, so of
    equal vectors the ``k + 1`` smallest distinct ids, each with up to ``k`` of its
    rows, hold the ``k`` smallest rows for any query (ties going to smaller ids).
    ``vectors`` has ``vec_id``, ``dim`` and ``v`` (doubles).
    """
    rows = vectors.groupBy("v", "vec_id").agg(F.count(F.lit(1)).alias("_copies"))
    same = Window.partitionBy("v").orderBy("vec_id")
    kept = rows.withColumn("_n", F.row_number().over(same)).filter(F.col("_n") <= k + 1)
    member = F.struct("vec_id", F.least("_copies", F.lit(k)).cast("int").alias("copies"))
    nodes = kept.groupBy("v").agg(F.sort_array(F.collect_list(member)).alias("_members"))
    nodes = nodes.select(
        F.col("_members")[0]["vec_id"].alias("vec_id"),
        F.size("v").alias("dim"),
        "v",
        F.col("_members.vec_id").alias("ids"),
        F.col("_members.copies").alias("copies"),
    )
    nodes = stored(nodes, "vectors")
    total = nodes.count()
    n = shard_count(total, nodes.sparkSession.sparkContext.defaultParallelism) if shard_rows is None else max(1, -(-total // shard_rows))
    dealt, n = blocked(nodes, "rb", -(-total // n) or 1, total)

    def build(shard: pa.Table) -> pa.Table:
        first, values = shard.column("vec_id").to_numpy(), matrix(shard, "v")
        heights = _levels(first)
        order = np.lexsort((first, -heights))
        values, heights = values[order], heights[order]
        unit = float(np.abs(values).max(initial=0)) or 1.0
        graph = Graph.built(_fitting(values, unit), heights)
        members = shard.select(["ids", "copies"]).take(pa.array(order))
        ids, copies = (members.column(c).combine_chunks() for c in ("ids", "copies"))
        row = {
            "dim": shard.column("dim")[:1].cast(pa.int32()),
            "rb": shard.column("rb")[:1].cast(pa.int32()),
            "unit": pa.array([unit]),
            "ids": pa.array([ids.flatten().to_numpy().astype("<i8").tobytes()], pa.binary()),
            "copies": pa.array([copies.flatten().to_numpy().astype("<i4").tobytes()], pa.binary()),
            "counts": pa.array([ids.value_lengths().to_pylist()], pa.list_(pa.int32())),
            "vectors": pa.array([values.astype("<f8").tobytes()], pa.binary()),
            "sizes": pa.array([[len(level) for level in graph.levels]], pa.list_(pa.int32())),
            "links": pa.array([b"".join(level.astype("<i4").tobytes() for level in graph.levels)], pa.binary()),
        }
        return pa.table(row)

    # Building takes long and reads little: a number of partitions of its own keeps shards apart.
    apart = dealt.repartition(2 * n, "dim", "rb")
    return stored(apart.groupBy("dim", "rb").applyInArrow(build, _INDEX), "graphs"), n


def _opened(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, Graph, float]:
    ids, copies = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["copies"], "<i4")
    starts = np.concatenate([[0], np.cumsum(row["counts"], dtype=np.int64)])
    values = np.frombuffer(row["vectors"], "<f8").reshape(len(row["counts"]), -1)
    flat, levels, at = np.frombuffer(row["links"], "<i4"), [], 0
    for i, size in enumerate(row["sizes"]):
        width = UPPER_LINKS if i else GROUND_LINKS
        levels.append(flat[at : at + size * width].reshape(size, width))
        at += size * width
    return ids, copies, starts, values, Graph(_fitting(values, row["unit"]), levels), row["unit"]


def nearest(ids: np.ndarray, copies: np.ndarray, starts: np.ndarray, values: np.ndarray, graph: Graph, unit: float, query_ids: np.ndarray, queries: np.ndarray, k: int, beam: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query: its id, and ids and exact distances of the ``k`` nearest found.

    Node ``i`` has the members ``starts[i]`` to ``starts[i + 1]`` of ``ids``, each
    ``copies`` times.
    """
    lengths = np.diff(starts)
    for at in range(0, len(queries), _TOGETHER):
        found = graph.search(_fitting(queries[at : at + _TOGETHER], unit), beam)
        for own, query, nodes in zip(query_ids[at:], queries[at:], found, strict=False):
            nodes = nodes[nodes >= 0]
            gap = values[nodes] - query
            exact = np.sqrt((gap * gap).sum(axis=1))
            n = lengths[nodes]
            rows = np.repeat(starts[nodes] - (n.cumsum() - n), n) + np.arange(n.sum())
            exact = np.repeat(exact, n)
            other = ids[rows] != own
            rows, exact = rows[other], exact[other]
            order = np.lexsort((ids[rows], exact))[:k]
            order = np.repeat(order, copies[rows[order]])[:k]
            yield own, ids[rows[order]], exact[order]


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    beam: int = SEARCH_BEAM,
    shard_rows: int | None = None,
    query_rows: int = 4096,
) -> DataFrame:
    """Each query's ``k`` nearest rows found, by Euclidean distance on the vectors.

    ``vectors`` has ``vec_id`` and ``embedding``.  Returns ``query_id``, ``rank``,
    ``vec_id``, ``score`` (the distance in double precision, not the graph's
    estimate); ties go to the smaller id; all rows if fewer than ``k``.  Rows with a
    NULL id, a NULL or zero vector, or a NULL or non-finite component take no part;
    vectors meet only those of their length.  Rows that repeat an id are
    candidates each, but none for a query of that id; of such queries the least vector stands.
    Empty tables give an empty result.

    Distinct vectors are dealt to shards of bounded size (see :func:`shard_count`) by a hash of id and
    vector; each shard's graph is built in one task and meets each block of queries in one task.
    """
    whole = vectors.filter(
        F.col("vec_id").isNotNull() & usable("embedding") & F.exists("embedding", lambda x: x != 0)
    ).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.size("embedding").alias("dim"),
        F.transform("embedding", lambda x: x.cast("double")).alias("v"),
        is_query.alias("is_query"),
    )
    index, shards = vector_index(whole.drop("is_query"), k, shard_rows)
    asked = whole.filter("is_query").groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    queries, blocks = blocked(asked, "qb", query_rows, asked.count())

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            query_ids, asked = left.column("vec_id").to_numpy(), matrix(left, "v")
            for row in right.to_pylist():
                for own, ids, exact in nearest(*_opened(row), query_ids, asked, k, beam):
                    out.append((np.full(len(ids), own), ids, exact))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] or [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    keys = ("dim", "qb", "rb")
    best = (
        spread(queries, "rb", shards)
        .groupBy(*keys)
        .cogroup(spread(index, "qb", blocks).groupBy(*keys))
        .applyInArrow(search, "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
