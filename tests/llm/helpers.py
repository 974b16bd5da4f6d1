"""Small tables for the tests of the text operators."""

from __future__ import annotations

import hashlib
import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    pick = random.Random(seed)
    return [f"w{pick.randrange(vocabulary)}" for _ in range(n)]


def documents(spark, rows):
    """``rows``: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def read_back(df):
    return [tuple(r) for r in df.collect()]
