import pytest

from sedimenta.llm.mixing import mix_sources, mixed_rows
from tests.llm.helpers import documents, words


def shares(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets round by round, as the rule says it."""
    names = sorted((k for k in sizes if k is not None)) + ([None] if None in sizes else [])
    weight = {k: weights[i % 3] for i, k in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        total = sum(weight[k] for k in open_)
        over = {k for k in open_ if left * weight[k] / total >= most * sizes[k]}
        if not over:
            target.update({k: left * weight[k] / total for k in open_})
            break
        for k in over:
            target[k] = most * sizes[k]
        left -= sum(target[k] for k in over)
        open_ -= over
    return target


def table(spark):
    rows = [(i, " ".join(words(i, 1 + i % 37)), ("a", "b", "ü", None)[min(3, i % 7)]) for i in range(700)]
    rows += [(1000, None, "a"), (1001, "", "empty"), (1002, " \t\n", "empty"), (1003, "x " * 9000, "long"), (5, "same id", "b")]
    return documents(spark, rows + [(5, "same id", "b")]), rows + [(5, "same id", "b")]


def test_targets_and_words_taken(spark):
    docs, rows = table(spark)
    sizes = {}
    for r in rows:
        sizes[r[2]] = sizes.get(r[2], 0) + len((r[1] or "").split())
    wanted = shares(sizes)
    out = mix_sources(docs).collect()
    assert len(out) == len(rows)
    taken = dict.fromkeys(sizes, 0)
    for r in out:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(wanted[r.source])
        assert r.size == len((r.text or "").split())
        assert 0 <= r.copies <= 2
        taken[r.source] += r.copies * r.size
    for k in sizes:
        assert abs(taken[k] - wanted[k]) <= max((len((r[1] or "").split()) for r in rows if r[2] == k), default=0)


def test_reruns_and_other_partitions_agree(spark):
    docs, _ = table(spark)
    first = sorted((r.doc_id, r.text or "", r.copies) for r in mix_sources(docs).collect())
    again = sorted((r.doc_id, r.text or "", r.copies) for r in mix_sources(docs.repartition(11)).collect())
    assert first == again


def test_copies_become_rows(spark):
    docs, _ = table(spark)
    mixed = mix_sources(docs).agg({"copies": "sum"}).first()[0]
    out = mixed_rows(docs)
    assert out.columns == docs.columns
    assert out.count() == mixed


def test_empty_table_and_clashing_names(spark):
    docs, _ = table(spark)
    assert mix_sources(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="copies"):
        mix_sources(docs.withColumnRenamed("lang", "copies"))
    kept = mix_sources(docs, keep=["doc_id"])
    assert kept.columns == ["doc_id", "size", "source_size", "target", "copies"]
