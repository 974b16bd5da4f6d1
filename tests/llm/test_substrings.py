import random
import tracemalloc

import numpy as np

from sedimenta.llm.substrings import Windows, equal_strings, repeated_spans
from tests.llm.helpers import documents, words


def brute(rows, length=50):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            key = b[p : p + length]
            d_ = float("inf") if d is None else d
            first[key] = min(first.get(key, float("inf")), d_)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < (float("inf") if d is None else d):
                gone[p : p + length] = True
        turns = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        out.append((d, len(b), [tuple(x) for x in turns.reshape(-1, 2).tolist()], np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return out


def rows():
    pick = random.Random(8)
    passage, other = " ".join(words(1, 40)), " ".join(words(2, 30))
    out = []
    for i in range(120):
        own = words(i + 10, pick.randint(0, 60))
        if i % 3 == 0:
            own.insert(len(own) // 2, passage[pick.randint(0, 60) : pick.randint(90, len(passage))])
        if i % 5 == 0:
            own.append(other)
        out.append((pick.randrange(10_000), " ".join(own)))
    out += [(20_000 + i, "same text " * 30) for i in range(15)]
    out += [(30_000, "ab" * 3000), (30_001, "ab" * 40), (30_002, "x" * 49), (30_003, "x" * 49), (30_004, "x" * 50), (30_005, "x" * 50), (30_006, "é" * 200_000), (30_007, "zé" + "é" * 60)]
    out += [(40_000, None), (40_001, ""), (40_002, passage), (40_002, passage), (None, passage), (None, passage + " end of it")]
    pick.shuffle(out)
    return out


def key(r):
    return (r[0] is None, r[0] or 0, r[1], r[3])


def read(df):
    return sorted([(r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in df.collect()], key=key)


def test_spans_equal_brute_force(spark):
    data = rows()
    docs = documents(spark, data).withColumnRenamed("lang", "pack").repartition(5)
    assert read(repeated_spans(docs, pack_bytes=3000)) == sorted(brute(data), key=key)


def test_other_lengths(spark):
    data = [(i, " ".join(words(i, 40, 12))) for i in range(60)]
    assert read(repeated_spans(documents(spark, data), length=20, pack_bytes=1000)) == sorted(brute(data, 20), key=key)


def test_empty_table(spark):
    assert repeated_spans(documents(spark, [(1, "x")]).limit(0)).count() == 0


def test_block_order_and_classes():
    pick = random.Random(3)
    contents = ["".join(pick.choice("ab") for _ in range(70)).encode() for _ in range(30)]
    contents += contents[:10]
    text = np.frombuffer(b"".join(contents), np.uint8)
    begin, count = np.arange(40) * 70, np.full(40, 21)
    order, new = equal_strings(text, begin, np.full(40, 5), count, 50)
    strings = [contents[c][i : i + 50] for c in range(40) for i in range(21)]
    residue = [(i - 5) % 13 for _ in range(40) for i in range(21)]
    seen = [(residue[k], strings[k]) for k in order]
    assert [a != b for a, b in zip(seen, seen[1:], strict=False)] == list(new[1:])
    assert len(set(zip(residue, strings, strict=True))) == new.sum()


def test_a_long_text_takes_little_memory_beside_its_bytes():
    data = np.random.default_rng(5).integers(97, 101, 8_000_000).astype(np.uint8)
    tracemalloc.start()
    whole = Windows(data, np.array([len(data)]), 50)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12 * len(data)
    assert (whole.start[1:] == whole.start[:-1] + whole.count[:-1]).all() and whole.count.sum() == len(data) - 49


def test_runs_of_a_pack_are_those_of_its_documents():
    pick = np.random.default_rng(6)
    texts = [pick.integers(97, 100, n).astype(np.uint8) for n in (0, 49, 50, 51, 70_000, 0, 200_000, 65_536, 65_585, 10)]
    pack = Windows(np.concatenate(texts), np.cumsum([len(t) for t in texts]), 50)
    at = 0
    for doc, text in enumerate(texts):
        own, mine = Windows(text, np.array([len(text)]), 50), pack.doc == doc
        assert (pack.start[mine] - at == own.start).all() and (pack.count[mine] == own.count).all()
        assert (pack.value[mine] == own.value).all() and (pack.offset[mine] == own.offset).all()
        at += len(text)
