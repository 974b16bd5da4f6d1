import random
from collections import defaultdict

import numpy as np

from sedimenta.llm.components import components
from sedimenta.llm.jaccard import one_of_each, runs_needed, similar, similarity_classes
from sedimenta.llm.texts import shingle_sets
from tests.llm.helpers import documents, words


def shingles(text):
    own = (text or "").split()
    if not own:
        return frozenset()
    return frozenset(tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4)))


def brute(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    links, parent = [0] * n, list(range(n))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(n):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and common >= threshold * (len(sets[i]) + len(sets[j]) - common) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[root(i)].append(d)
    return [(d, min(ids[root(i)], default=None), links[i]) for i, (d, _) in enumerate(rows)]


def rows(near=180):
    base = words(1, 120, 5000)
    pick = random.Random(4)
    out = [(i, " ".join(words(i + 50, 20 + i % 90, 3000))) for i in range(150)]
    for i in range(near):  # near copies of one text, and of one another
        own = list(base)
        for _ in range(i % 4):
            own[pick.randrange(120)] = f"x{i}"
        out.append((1000 + i, " ".join(own)))
    passage = " ".join(words(2, 40))
    out += [(2000 + i, passage + " " + " ".join(words(i + 700, 60))) for i in range(90)]
    out += [(3000 + i, " ".join(words(7, 200, 900))) for i in range(70)]
    out += [(4000, None), (4001, ""), (4002, " \n"), (4003, "a b"), (4004, "a  b"), (4005, "a b c"), (4006, "é " * 30_000)]
    return out + [(4003, "a b"), (None, "no id at all here"), (None, "no id at all here"), (4007, "no id at all here")]


def key(r):
    return (r[0] is None, r[0] or 0, r[1] or 0, r[2])


def test_classes_and_links_equal_brute_force(spark):
    data = rows()
    found = [tuple(r) for r in similarity_classes(documents(spark, data)).collect()]
    assert sorted(found, key=key) == sorted(brute(data), key=key)


def test_small_leaves_and_blocks_lose_nothing(spark):
    data = rows(60)
    found = [tuple(r) for r in similarity_classes(documents(spark, data), depth=2, small=8, block=16).collect()]
    assert sorted(found, key=key) == sorted(brute(data), key=key)


def test_one_document_of_each_class_stays(spark):
    data = rows(40)
    docs = documents(spark, data).withColumnRenamed("lang", "sid")
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    expected = {c for d, c, _ in brute(data)} | {4000, 4001, 4002}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expected)
    texts = dict(data)
    assert all(r.text == texts[r.doc_id] for r in kept.collect())


def test_empty_table(spark):
    docs = documents(spark, [(1, "x")]).limit(0)
    assert similarity_classes(docs).count() == 0
    assert one_of_each(docs).count() == 0


def test_both_ways_to_compare_sets_agree():
    texts = [t.encode() for _, t in rows(30) if t and t.strip()]
    sets = shingle_sets(texts)
    left, right = np.triu_indices(len(sets), 1)
    dense = similar(sets, left, right, 0.8)
    one = np.concatenate([similar(sets, left[k : k + 1], right[k : k + 1], 0.8) for k in range(0, len(left), 97)])
    assert (dense[::97] == one).all()


def test_runs_follow_from_the_recall():
    assert runs_needed(0.8, 5, 0.9) < runs_needed(0.8, 5, 0.999999)
    assert runs_needed(0.9, 5, 0.999) < runs_needed(0.8, 5, 0.999)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (301, 300)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.least for r in components(frame).collect()}
    expected = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {300: 300, 301: 300}
    assert found == expected
    assert components(frame.limit(0)).count() == 0
