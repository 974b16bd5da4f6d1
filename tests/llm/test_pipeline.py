from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sedimenta.llm.queries import ORACLES, QUERIES
from sedimenta.llm.secrets import secret_spans
from tests.llm.helpers import documents, words
from tests.llm.test_jaccard import brute

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture
def tables(spark, tmp_path):
    rows, labels = [], []
    for i in range(240):
        text = words(i, 60)
        if i % 8 == 0:
            text[5] = text[30] = text[50] = "blarg"
        rows.append((i, " ".join(text), f"src{i % 3}"))
        labels.append((i, 1, int(i % 8 == 0)))
    rows += [(1000 + i, rows[1][1] + f" tail{i}", "src1") for i in range(5)]
    rows += [(2000, "password=abcdef1234 " + " ".join(words(5000, 30)), None), (2001, None, "src2"), (2002, "", "src2")]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path), rows


def test_stages_in_order():
    assert list(STAGES) == ["toxicity", "n-gram jaccard join", "secret scans", "mixing sources", "best-fit packing"]


def test_each_stage_on_what_the_one_before_kept(spark, tables):
    sf_dir, rows = tables
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    clean = STAGES["toxicity"](spark, docs, sf_dir)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(d for d, t, _ in rows if "blarg" not in (t or ""))
    clean.write.parquet(f"{sf_dir}/1")
    docs = spark.read.parquet(f"{sf_dir}/1")
    single = STAGES["n-gram jaccard join"](spark, docs, sf_dir)
    expected = {c for _, c, _ in brute([(r.doc_id, r.text) for r in docs.collect()])}
    assert sorted(r.doc_id for r in single.collect()) == sorted(expected)
    single.write.parquet(f"{sf_dir}/2")
    docs = spark.read.parquet(f"{sf_dir}/2")
    safe = STAGES["secret scans"](spark, docs, sf_dir)
    assert safe.count() == docs.count()
    assert not any(secret_spans(r.text) for r in safe.collect())
    mixed = STAGES["mixing sources"](spark, safe, sf_dir)
    assert mixed.columns == docs.columns
    assert max(Counter(r.doc_id for r in mixed.collect()).values()) <= 2
    packed = STAGES["best-fit packing"](spark, mixed, sf_dir)
    assert packed.filter("piece = 0").count() == mixed.count()


def test_stages_keep_columns_of_any_name(spark, tables):
    sf_dir, rows = tables
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    own = ["size", "source_size", "target", "Copies", "_k", "_slot", "_sum", "_d", "_s", "_sid", "_row", "_toxicity", "_n", "a.b"]
    more = docs.select("*", *[F.concat(F.lit(f"{n}:"), "doc_id").alias(n) for n in own])
    for name in ("toxicity", "n-gram jaccard join", "secret scans", "mixing sources"):
        plain, out = STAGES[name](spark, docs, sf_dir), STAGES[name](spark, more, sf_dir)
        assert out.columns == more.columns
        found = out.collect()
        assert all(r[n] == f"{n}:{r.doc_id}" for r in found for n in own)
        assert Counter((r.doc_id, r.text) for r in found) == Counter((r.doc_id, r.text) for r in plain.collect())
    assert STAGES["best-fit packing"](spark, more, sf_dir).count() == STAGES["best-fit packing"](spark, docs, sf_dir).count()


def test_run_is_all_stages(spark, tables):
    sf_dir, _ = tables
    out = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns)
    assert out.count() > 0


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
