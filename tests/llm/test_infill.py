import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from sedimenta.llm import infill
from sedimenta.llm.infill import UNITS, fill_in_middle, restored
from sedimenta.llm.wavelet import WaveletMatrix
from tests.llm.helpers import documents

UNIT = {"line": r"[^\n]*\n|[^\n]+", "sentence": r"[^\n.!?]*[\n.!?]|[^\n.!?]+", "word": r"[^ \t\x0b\x0c\r\n]*[ \t\x0b\x0c\r\n]|[^ \t\x0b\x0c\r\n]+"}


def brute(doc_id, text, unit="line", rate=100, spm=50):
    text = text or ""
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = re.findall(UNIT[unit], text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    pick = random.Random(3)
    out = [None, "", "\n", "\n\n\n", "no end", "end\n", "a\nb", "é\nß\n日本", "x<P>y\nz", "<S>", "<M>\n", "< P>\n<", "<\n<S\n<M", "\r\n \r", "😀\n😀😀\n", ".!?\n."]
    out += ["".join(pick.choice("ab é日😀\n\n\t.<>PSM") for _ in range(pick.randint(1, 200))) for _ in range(300)]
    return out + ["long é line\n" * 60_000, "y" * 500_000]


def test_ranks_and_places():
    pick = np.random.default_rng(1)
    for size in (0, 1, 63, 64, 65, 1000):
        symbols = pick.integers(0, 8, size).astype(np.uint8)
        matrix = WaveletMatrix(symbols, 3)
        at = np.arange(size + 1)
        for c in range(8):
            want = np.concatenate([[0], np.cumsum(symbols == c)])
            assert (matrix.rank(c, at) == want).all()
        both = np.concatenate([[0], np.cumsum((symbols == 1) | (symbols == 5))])
        for k in range(int(both[-1]) + 2):
            place = matrix.reach((1, 5), np.array([k]), np.array([0]), np.array([size]))[0]
            assert place == (np.flatnonzero(both >= k)[0] if k <= both[-1] else size)


def test_examples_equal_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "no id\nhere"), (3, "\n\n\n"), (3, "other\ntext")]
    docs = documents(spark, rows).withColumn("fim", F.lit("own")).withColumn("_cut", F.lit(1))
    for unit in UNITS:
        out = fill_in_middle(docs, unit)
        assert out.columns == [*docs.columns, "fim_"]
        out = out.withColumn("back", restored(F.col("fim_.output"), F.col("fim_.form"))).collect()
        found = sorted(((r.doc_id, r.text, tuple(r.fim_), r.back) for r in out), key=repr)
        assert found == sorted(((d, t, brute(d, t, unit), t or "") for d, t in rows), key=repr)
        assert all(r.fim == "own" for r in out)


def test_runs_of_texts_do_not_matter(monkeypatch):
    pieces = [(t or "").encode() for t in texts()]
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
    data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    draws = np.random.default_rng(2).integers(0, 1 << 32, (2, len(pieces)))
    whole = infill.cuts(data, offsets, *draws, UNITS["line"])
    monkeypatch.setattr(infill, "_TOGETHER", 100)
    for a, b in zip(whole, infill.cuts(data, offsets, *draws, UNITS["line"]), strict=True):
        assert (a == b).all()


def test_rates(spark):
    rows = [(i, f"line {i}\nline\nmore\n") for i in range(200)]
    out = fill_in_middle(documents(spark, rows), rate=60, spm=30).collect()
    found = {r.doc_id: tuple(r.fim) for r in out}
    assert found == {d: brute(d, t, rate=60, spm=30) for d, t in rows}
    assert {f[1] for f in found.values()} == {"plain", "psm", "spm"}


def test_empty_table(spark):
    assert fill_in_middle(documents(spark, [(1, "x")]).limit(0)).collect() == []
