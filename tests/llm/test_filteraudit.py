import random
from collections import defaultdict
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from sedimenta.llm.filteraudit import audit_filters, failure_masks, gray_states, labelled
from tests.llm.helpers import words

SCHEMA = "doc_id long, text string, lang string, mask string"


def mask_of(text, copy):
    own = text.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ")
    split = [w for w in own.split(" ") if w]
    fails = [
        len(split) < 200,
        100 * len(set(split)) < 50 * len(split),
        100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
        any(c in "#$%&*|" for c in text),
        copy,
    ]
    return sum(1 << i for i, f in enumerate(fails) if f)


def brute(rows, labels):
    """Runs every order of filters over the rows themselves."""
    least = defaultdict(lambda: None)
    for d, t, _ in rows:
        if d is not None:
            least[t or ""] = d if least[t or ""] is None else min(d, least[t or ""])
    good, toxic = ({d for d, *marks in labels if marks[i] == 1 and d is not None} for i in (0, 1))
    docs = [(d, p or "", mask_of(t or "", d is not None and d > least[t or ""])) for d, t, p in rows]
    out, whole = [], defaultdict(int)
    for part in {p for _, p, _ in docs}:
        own = [(d, m) for d, p, m in docs if p == part]
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                gone = [(d, m) for d, m in left if m & bit]
                left = [(d, m) for d, m in left if not m & bit]
                fails = [(d, m) for d, m in own if m & bit]
                whole[part, letter] += len(gone)
                counts = len(left), len(gone), len(fails) - len(gone), sum(m == bit for _, m in own)
                marks = sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)
                out.append((part, "".join(order), step, letter, *counts, *marks))
    return sorted((*r[:3], *r[4:], whole[r[0], r[3]]) for r in out)


def table():
    pick = random.Random(7)
    rows = []
    for i in range(260):
        text = " ".join(words(i % 90, pick.choice((3, 199, 200, 400)), pick.choice((20, 400))))
        text += pick.choice(["", " UPPER CASE LETTERS", " $", "\té日 " * 3, "|" + "X" * 30])
        rows.append((i, text, pick.choice(["en", "de", None, ""])))
    rows += [(1000 + i, "the same text", ("en", "fr")[i % 2]) for i in range(130)]  # a third of all rows
    rows += [(2000, None, "fr"), (2001, "", "fr"), (2002, " \n\t", None), (5, "repeated id", "en"), (5, "repeated id", "en"), (None, "the same text", "en"), (None, None, "fr"), (2003, "wörd " * 30_000, "de")]
    labels = [(i, pick.choice((0, 1, None)), pick.choice((0, 1, None))) for i in range(0, 260, 2)]
    return rows, labels + [(1001, 1, 1), (1001, 0, 0), (5, 1, 0), (None, 1, 1), (9999, 1, 1)]


def audited(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "own") for r in rows], SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    masked = labelled(failure_masks(docs, F.col("lang")), marks)
    return audit_filters(masked, {"good_lost": F.col("good"), "toxic_lost": F.col("toxic")})


def test_every_order_equals_running_it(spark):
    rows, labels = table()
    out = audited(spark, rows, labels)
    assert out.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(tuple(r) for r in out.collect()) == brute(rows, labels)


def test_states_are_survivors_of_every_set():
    cells = np.random.default_rng(1).integers(0, 50, (32, 3))
    states = gray_states(cells)
    for chosen in range(32):
        assert (states[chosen] == cells[[m for m in range(32) if not m & chosen]].sum(axis=0)).all()


def test_fewer_filters_and_an_empty_table(spark):
    masked = spark.createDataFrame([("x", 1), ("x", 3), ("x", 0)], "part string, mask int")
    out = {(r.filter_order, r.step): r for r in audit_filters(masked, {}, "PQ").collect()}
    assert (out["PQ", 1].kept, out["PQ", 1].removed, out["PQ", 2].removed, out["PQ", 2].redundant) == (1, 2, 0, 1)
    assert (out["QP", 1].removed, out["QP", 2].removed, out["QP", 2].shapley) == (1, 1, 3)
    rows, labels = table()
    assert audited(spark, rows[:0], labels).collect() == []
    assert {r.good_lost for r in audited(spark, rows, []).collect()} == {0}
