import numpy as np
from pyspark.sql import functions as F

from sedimenta.llm.neighbours import nearest_neighbours, shard_count
from sedimenta.llm.topk import exact_top_k, fitted_rotation, haar_basis, resolutions, search_block, segment_statistics
from sedimenta.llm.vectors import blocked

SCHEMA = "vec_id long, embedding array<double>, score string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "other") for i, v in rows], SCHEMA)


def vectors(n, d=16, seed=3):
    return np.random.default_rng(seed).standard_normal((n, d))


def brute_products(rows, every, k=5):
    ids = [i for i, _ in rows]
    v = np.array([[int(np.floor(256 * x)) for x in r] for _, r in rows])
    out = []
    for q, (i, _) in enumerate(rows):
        if i % every == 0:
            found = sorted((-int(v[q] @ v[j]), ids[j]) for j in range(len(rows)) if ids[j] != i)[:k]
            out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(found)]
    return sorted(out)


def test_top_k_equals_brute_force_over_many_blocks(spark):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors(400))]
    rows += [(1000 + i, rows[7][1]) for i in range(12)]  # ties
    found = exact_top_k(table(spark, rows), F.col("vec_id") % 50 == 0, query_rows=4, block_rows=64)
    assert sorted(tuple(r) for r in found.collect()) == brute_products(rows, 50)


def test_top_k_leaves_out_unusable_vectors(spark):
    good = [(0, [1.0, 2.0]), (1, [0.5, 0.25]), (2, [-1.0, 3.0])]
    bad = [(3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 0.0]), (None, [1.0, 1.0]), (50, [1.0])]
    found = exact_top_k(table(spark, good + bad), F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in found.collect()) == brute_products(good, 50)
    assert exact_top_k(table(spark, []), F.col("vec_id") % 50 == 0).count() == 0
    twice = exact_top_k(table(spark, [*good, good[0], good[1]]), F.col("vec_id") % 50 == 0).orderBy("rank").collect()
    assert [r.vec_id for r in twice] == [2, 1, 1]


def test_bounds_never_lie_below_the_product():
    a, b = np.floor(256 * vectors(50, 10, 1)), np.floor(256 * vectors(60, 10, 2))
    for segments in (1, 2, 3, 8, 10, 16):
        assert (segment_statistics(a, segments) @ segment_statistics(b, segments).T >= a @ b.T - 1e-6).all()


def test_rotations_keep_products_and_put_them_first():
    for width in (1, 2, 8, 64):
        assert np.allclose(haar_basis(width) @ haar_basis(width).T, np.eye(width))
    for width in (3, 16, 20):
        v = vectors(200, width) * np.arange(1, width + 1) + 3
        turned = v @ fitted_rotation(v)
        assert np.allclose(turned @ turned.T, v @ v.T)
        energy = [(segment_statistics(turned, n)[:, :n] ** 2).sum() for n in (1, 2, 4, 8)]
        best = np.sort(np.linalg.eigvalsh(v.T @ v))[::-1].cumsum()
        assert np.allclose(energy, [best[min(n, width) - 1] for n in (1, 2, 4, 8)])


def pairs_left(v, queries=20, k=5):
    ids, whole, seen = np.arange(len(v)), np.floor(256 * v).astype(np.int64), {}
    q, r, s = search_block(ids[:queries], whole[:queries], ids, whole, k, fitted_rotation(whole.astype(float)), seen)
    for i in range(queries):
        products = sorted((-int(whole[i] @ whole[j]), j) for j in ids if j != i)[:k]
        assert list(zip(-s[q == i], r[q == i], strict=True)) == products
    assert list(seen) == resolutions(v.shape[1])
    return [n / (queries * len(v)) for n in seen.values()]


def test_fewer_pairs_are_left_at_every_resolution():
    # Directions alike in all axes: only fine statistics tell rows apart.
    even = vectors(3000, 64, 5)
    left = pairs_left(even / np.linalg.norm(even, axis=1)[:, None])
    assert all(a >= b for a, b in zip(left, left[1:], strict=False))
    assert left[-3] < 0.6 and left[-2] < 0.2 and left[-1] < 0.01
    # Vectors of few directions and some noise: the coarse ones do.
    few = vectors(3000, 6, 6) @ vectors(6, 64, 7) + 0.05 * vectors(3000, 64, 8)
    left = pairs_left(few / np.linalg.norm(few, axis=1)[:, None])
    assert left[1] < 0.5 and left[2] < 0.05 and left[-1] < 0.01


def test_large_whole_numbers_stay_exact():
    ids, big = np.arange(4), np.array([[3_000_000_000, 1], [3_000_000_000, 2], [2_999_999_999, 3], [1, 1]])
    _, found, scores = search_block(ids[:1], big[:1], ids, big, 2)
    assert list(found) == [1, 2]
    assert list(scores) == [3_000_000_000**2 + 2, 3_000_000_000 * 2_999_999_999 + 3]


def brute_distances(rows, every, k=10):
    out = {}
    for i, v in rows:
        if i % every == 0:
            found = sorted((float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), j) for j, w in rows if j != i)[:k]
            out[i] = [j for _, j in found]
    return out


def test_neighbours_recall_and_exact_scores(spark):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors(3000, 24))]
    by_id = dict(rows)
    found = nearest_neighbours(table(spark, rows), F.col("vec_id") % 100 == 0, shard_rows=700, query_rows=9).collect()
    wanted = brute_distances(rows, 100)
    hits = sum(r.vec_id in wanted[r.query_id] for r in found)
    assert len(found) == 300
    assert hits / 300 >= 0.95
    for r in found:
        gap = np.array(by_id[r.query_id]) - np.array(by_id[r.vec_id])
        assert abs(r.score - np.sqrt((gap**2).sum())) < 1e-12


def test_neighbours_with_many_equal_vectors(spark):
    base = [(i, [float(x) for x in v]) for i, v in enumerate(vectors(300, 8))]
    rows = base + [(10_000 + i, base[0][1]) for i in range(900)]
    found = nearest_neighbours(table(spark, rows), F.col("vec_id") == 0, shard_rows=256).orderBy("rank").collect()
    assert [r.vec_id for r in found] == list(range(10_000, 10_010))
    assert {r.score for r in found} == {0.0}


def test_neighbours_with_repeated_ids_among_equal_vectors(spark):
    base = [(i, [float(x) for x in v]) for i, v in enumerate(vectors(60, 8), 1)]
    for repeats in (2, 11, 40):
        group = [(i, base[0][1]) for i in [100] * repeats + list(range(101, 116)) + [103] * 4 + [200] * 3]
        rows = base + group
        found = nearest_neighbours(table(spark, rows), F.col("vec_id") % 100 == 0, shard_rows=32).orderBy("query_id", "rank").collect()
        wanted = brute_distances(rows, 100)
        assert sorted(wanted) == [100, 200]
        for q, ids in wanted.items():
            assert [r.vec_id for r in found if r.query_id == q] == ids


def test_an_id_of_many_vectors_is_dealt_to_all_blocks(spark):
    rows = [(7, [float(x) for x in v]) for v in vectors(400, 4)]
    dealt, n = blocked(spark.createDataFrame(rows, "vec_id long, v array<double>"), "rb", 100, len(rows))
    sizes = [r["count"] for r in dealt.groupBy("rb").count().collect()]
    assert n == len(sizes) == 4
    assert max(sizes) <= 150


def test_neighbours_edge_cases(spark):
    good = [(0, [1.0, 2.0]), (1, [0.5, 0.25]), (2, [-1.0, 3.0]), (3, [1e200, 1.0])]
    bad = [(4, None), (5, [0.0, 0.0]), (6, [None, 1.0]), (7, [float("nan"), 1.0]), (8, [float("inf"), 0.0]), (100, [1.0])]
    found = nearest_neighbours(table(spark, good + bad), F.col("vec_id") % 100 == 0).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in found] == [(0, 1, 1), (0, 2, 2), (0, 3, 3)]
    assert nearest_neighbours(table(spark, []), F.col("vec_id") % 100 == 0).count() == 0
    assert nearest_neighbours(table(spark, good[:1]), F.col("vec_id") % 100 == 0).count() == 0


def test_shards_are_few_and_bounded():
    assert [shard_count(n, 6) for n in (0, 1, 4096, 4097, 20_000, 51_282, 1_000_000, 10**9)] == [1, 1, 1, 2, 5, 6, 31, 30518]
    assert shard_count(100_000, 1000) == 25
