"""Exact top-k inner-product search, pruned by segment means and deviations from coarse to fine."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.vectors import blocked, matrix, spread, usable

#: Below this, sums of products are exact in double precision.
_EXACT = float(1 << 52)
#: Rows that rotations are fitted on, and of how many lengths of vectors at most.
SAMPLE_ROWS, SAMPLE_LENGTHS = 20_000, 16


def resolutions(width: int) -> list[int]:
    """Segments per vector, coarse to fine: 2, 4, 8 and so on, three quarters of the width, the width."""
    powers = [1 << i for i in range(1, 64) if 1 << i < width]
    return sorted({*powers, max(1, width * 3 // 4), width})


def haar_basis(width: int) -> np.ndarray:
    """Orthonormal rows (``width`` a power of two) of which the first 2, 4, 8 ... are constant
    on the 2, 4, 8 ... segments."""
    rows = [np.full(width, width**-0.5)]
    size = width
    while size > 1:
        for at in range(0, width, size):
            row = np.zeros(width)
            row[at : at + size // 2], row[at + size // 2 : at + size] = 1, -1
            rows.append(row / size**0.5)
        size //= 2
    return np.array(rows)


def fitted_rotation(sample: np.ndarray) -> np.ndarray:
    """An orthogonal change of axes after which means of 2, 4, 8 ... segments hold the most
    of the vectors' squares that so many numbers can: the principal axes, put onto
    those of :func:`haar_basis`.  Products stay as they are, whatever the sample."""
    width = 1 << max(0, sample.shape[1] - 1).bit_length()
    _, axes = np.linalg.eigh(sample.T @ sample)
    padded = np.zeros((sample.shape[1], width))
    padded[:, : sample.shape[1]] = axes[:, ::-1]
    return padded @ haar_basis(width)


def segment_statistics(rows: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations by segment, scaled by the segment's root length.

    The product of two rows of statistics bounds the inner product of the two
    vectors from above: in a segment of n components it is n times (product of
    means + covariance), and the covariance is at most the product of deviations.
    In terms of distance, it bounds the squared distance from below, the norms being known.
    """
    segments = max(1, min(segments, rows.shape[1]))
    if segments == rows.shape[1]:
        return rows
    sizes = [len(p) for p in np.array_split(np.arange(rows.shape[1]), segments)]
    starts, sizes = np.cumsum([0, *sizes[:-1]]), np.array(sizes, dtype=float)
    sums, squares = np.add.reduceat(rows, starts, axis=1), np.add.reduceat(rows * rows, starts, axis=1)
    means = sums / np.sqrt(sizes)
    return np.hstack([means, np.sqrt(np.maximum(squares - means * means, 0.0))])


def search_block(
    query_ids: np.ndarray,
    queries: np.ndarray,
    ids: np.ndarray,
    rows: np.ndarray,
    k: int,
    rotation: np.ndarray | None = None,
    seen: dict[int, int] | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, row ids and scores of each query's ``k`` best among ``rows``.

    Integers in; exact scores out.  Bounds from coarse statistics are taken for all
    rows, those of each finer resolution for what is left only.  At each, the
    rows with the best bounds are scored exactly, which gives the query a threshold, and
    rows whose bound does not reach it go.  What the finest leaves is scored
    exactly.  ``seen`` counts the pairs left by number of segments.

    Products too large for double precision have no bounds: they are compared as whole numbers.
    """
    width = max(1, queries.shape[1])
    size = max(float(np.abs(queries.astype(float)).max(initial=0)), 1.0) * max(float(np.abs(rows.astype(float)).max(initial=0)), 1.0)
    if size * width >= _EXACT:
        return _best(query_ids, ids, k, [(i, np.arange(len(ids)), rows @ queries[i]) for i in range(len(queries))])
    q, r = queries.astype(float), rows.astype(float)
    turned = (q, r) if rotation is None else (q @ rotation, r @ rotation)
    steps = resolutions(turned[0].shape[1]) if queries.shape[1] else []
    # A bound is a sum of rounded products; this margin is far above its error.
    margin = 1 + np.linalg.norm(q, axis=1) * float(np.linalg.norm(r, axis=1).max(initial=0)) * 1e-9
    stats = [tuple(segment_statistics(side, n) for side in turned) for n in steps]
    found = []
    for i in range(len(q)):
        alive, least = np.flatnonzero(ids != query_ids[i]), -np.inf
        for n, (own, theirs) in zip(steps, stats, strict=True):
            bounds = theirs[alive] @ own[i]
            if len(alive) > 8 * k:
                best = alive[np.argpartition(-bounds, 8 * k)[: 8 * k]]
                least = max(least, -np.partition(-(r[best] @ q[i]), k - 1)[k - 1])
            alive = alive[bounds + margin[i] >= least]
            if seen is not None:
                seen[n] = seen.get(n, 0) + len(alive)
        found.append((i, alive, np.rint(r[alive] @ q[i]).astype(np.int64)))
    return _best(query_ids, ids, k, found)


def _best(query_ids, ids, k, found):
    out = []
    for i, rows, scores in found:
        own = ids[rows] != query_ids[i]
        rows, scores = rows[own], scores[own]
        if len(rows) > k:  # all ties of the k-th stay in for the order by id
            keep = scores >= -np.partition(-scores, k - 1)[k - 1]
            rows, scores = rows[keep], scores[keep]
        order = np.lexsort((ids[rows], -scores))[:k]
        out.append((np.full(len(order), query_ids[i], dtype=np.int64), ids[rows[order]], scores[order]))
    if not out:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(3))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _rotations(whole: DataFrame, count: int) -> dict[int, np.ndarray]:
    """A rotation for each of the most frequent lengths, from a bounded sample."""
    wide = 1 << 30
    share = int(wide * min(1.0, SAMPLE_ROWS / max(1, count)))
    sample = whole.filter((F.pmod(F.xxhash64("vec_id", "v"), F.lit(wide)) < share) & (F.col("dim") > 1))
    # A hash takes equal rows together: once is enough.
    sample = sample.select("dim", "v").distinct().limit(2 * SAMPLE_ROWS).toArrow()
    lengths, n = np.unique(sample.column("dim").to_numpy(), return_counts=True)
    made = {}
    for length in lengths[np.argsort(-n, kind="stable")][:SAMPLE_LENGTHS]:
        own = sample.filter(pa.compute.equal(sample.column("dim"), int(length)))
        made[int(length)] = fitted_rotation(matrix(own, "v").astype(float))
    return made


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: int = 256,
    query_rows: int = 4096,
    block_rows: int = 8192,
) -> DataFrame:
    """Each query's ``k`` highest integer inner products among all other rows.

    ``vectors`` has ``vec_id`` and ``embedding``; a component x counts as
    ``floor(scale * x)``.  Returns ``query_id``, ``rank``, ``vec_id``, ``score``;
    ties go to the smaller id; all rows if fewer than ``k``.  Rows with a NULL or
    non-finite component, a NULL vector or a NULL id take no part; vectors meet
    only those of their own length.  Rows that repeat an id are candidates each,
    but none for a query of that id; of such queries the least vector stands.
    Empty tables give an empty result.

    Queries and rows are dealt to blocks of bounded size and each pair of blocks
    meets in one task, which returns ``k`` rows per query.  The axes that bounds are
    taken on are fitted on about ``SAMPLE_ROWS`` rows, chosen by a hash, for the
    ``SAMPLE_LENGTHS`` most frequent lengths of vectors; they change the work only, never the result.
    """
    whole = vectors.filter(F.col("vec_id").isNotNull() & usable("embedding")).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.size("embedding").alias("dim"),
        F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("v"),
        is_query.alias("is_query"),
    )
    counts = whole.agg(F.count(F.lit(1)), F.sum(F.col("is_query").cast("int"))).first()
    rotations = _rotations(whole, counts[0])
    rows, n_rows = blocked(whole.drop("is_query"), "rb", block_rows, counts[0])
    asked = whole.filter("is_query").groupBy("vec_id").agg(F.min("v").alias("v"))
    queries, n_queries = blocked(asked.withColumn("dim", F.size("v")), "qb", query_rows, counts[1] or 0)

    def pair(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [np.empty(0, dtype=np.int64)] * 3
        if left.num_rows and right.num_rows:
            queries = matrix(left, "v")
            found = search_block(
                left.column("vec_id").to_numpy(),
                queries,
                right.column("vec_id").to_numpy(),
                matrix(right, "v"),
                k,
                rotations.get(queries.shape[1]),
            )
        return pa.table(dict(zip(("query_id", "vec_id", "score"), found, strict=True)))

    keys = ("dim", "qb", "rb")
    best = (
        spread(queries, "rb", n_rows)
        .groupBy(*keys)
        .cogroup(spread(rows, "qb", n_queries).groupBy(*keys))
        .applyInArrow(pair, "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
