"""A training corpus from ``documents``, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm.carried import quoted, unused
from sedimenta.llm.jaccard import one_of_each
from sedimenta.llm.mixing import mixed_rows
from sedimenta.llm.packing import pack_documents
from sedimenta.llm.queries import TOXIC, tokenizer_path, toxicity_model
from sedimenta.llm.secrets import without_secrets
from sedimenta.llm.toxicity import toxicity_scores
from sedimenta.session import stored


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar scores as toxic go.  Learns from labels only where
    they aren't held out."""
    name = unused("_toxicity", docs.columns)
    scored = toxicity_scores(docs, toxicity_model(spark, docs, sf_dir), name)
    return scored.filter(F.col(name) < TOXIC).select(*map(quoted, docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays, the one of the smallest id."""
    return one_of_each(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row stays; secrets in its text are replaced by a mark."""
    return without_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated or left out so that sources reach their target weights."""
    return mixed_rows(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 2048 tokens."""
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity),
    ("n-gram jaccard join", near_duplicates),
    ("secret scans", secret_scans),
    ("mixing sources", mixing),
    ("best-fit packing", packing),
]

#: SQL cannot express the grammar, the similarity join or the packing; tests
#: hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
