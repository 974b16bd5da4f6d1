import random

import numpy as np

from sedimenta.llm import language
from sedimenta.llm.language import (
    LanguageModel,
    document_probabilities,
    fit_language,
    language_predictions,
    new_model,
    position_probabilities,
    stretches,
    train_step,
)

SYLLABLES = {"aa": ["the", "ing", "ou", "wh"], "bb": ["sch", "ung", "ß", "ei"], "cc": ["eau", "é", "oi", "ç"]}


def text(lang, seed, n=30):
    pick = random.Random(f"{lang}{seed}")
    return " ".join("".join(pick.choices(SYLLABLES[lang], k=pick.randint(1, 3))) for _ in range(n))


def test_gradients_agree_with_differences():
    model = new_model(["a", "b", "c"], 4, 1)
    model = LanguageModel(model.languages, *[w.astype(float) for w in model.parameters()])
    random_ = np.random.default_rng(0)
    x, y = random_.integers(0, 257, (5, 9)).astype(np.int16), np.array([0, 1, 2, 1, 0])
    _, grads = train_step(model, x, y)
    for w, g in zip(model.parameters(), grads, strict=True):
        for at in map(tuple, np.argwhere(np.abs(g) > 1e-3)[:5]):
            old = w[at]
            w[at] = old + 1e-3
            up = train_step(model, x, y)[0]
            w[at] = old - 1e-3
            down = train_step(model, x, y)[0]
            w[at] = old
            assert abs((up - down) / 2e-3 - g[at]) < 1e-3 * max(1, abs(g[at]))


def test_side_by_side_steps_equal_one_direction_at_a_time():
    model = new_model(["a", "b"], 5, 2)
    x = np.random.default_rng(1).integers(0, 257, (6, 11)).astype(np.int16)
    sig = lambda v: 1 / (1 + np.exp(-v))
    units = np.zeros((11, 6, 10))
    for d, order in enumerate((range(11), range(10, -1, -1))):
        h = np.zeros((6, 5))
        for t in order:
            a, u = model.inputs[d][x[:, t]], h @ model.hidden[d]
            z, r = sig(a[:, :5] + u[:, :5]), sig(a[:, 5:10] + u[:, 5:10])
            n = np.tanh(a[:, 10:] + r * u[:, 10:])
            h = (1 - z) * h + z * n
            units[t, :, 5 * d : 5 * d + 5] = h
    logits = units @ model.labels + model.bias
    p = np.exp(logits) / np.exp(logits).sum(axis=2, keepdims=True)
    assert np.allclose(position_probabilities(model, x), p, atol=1e-4)


def test_whole_texts_count_whatever_their_length():
    model = new_model(["a", "b"], 4, 3)
    long = b"abc " * 60_000
    whole = document_probabilities(model, [b"", long, b"x"])
    assert np.allclose(whole.sum(axis=1), [0, 1, 1], atol=1e-3)
    rows = stretches(long, 128)
    p = position_probabilities(model, rows) * (rows.T != 256)[:, :, None]
    assert np.allclose(whole[1], p.sum(axis=(0, 1), dtype=float) / len(long), atol=1e-4)


def test_held_out_accuracy_and_edge_cases(spark):
    schema = "doc_id long, text string, lang string, score string"
    rows = [(i, text(lang, i), lang, "x") for i, lang in enumerate(list(SYLLABLES) * 150)]
    odd = [(900, None, "aa", "x"), (901, "", "aa", "x"), (902, "12 34 !?", "bb", "x"), (903, "the", None, "x"), (903, "the", None, "x")]
    docs = spark.createDataFrame(rows + odd, schema)
    model = fit_language(docs.filter("doc_id % 4 != 2"), rounds=150)
    out = language_predictions(docs, model)
    assert sorted(out.columns) == sorted(["doc_id", "text", "lang", "score", "lang_pred"])
    got = [r for r in out.collect() if r.doc_id < 900 and r.doc_id % 4 == 2]
    assert sum(r.lang == r.lang_pred for r in got) / len(got) >= 0.97
    odd_out = {r.doc_id: (r.lang_pred, r.score) for r in out.collect() if r.doc_id >= 900}
    assert [odd_out[i] for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert odd_out[903][0] in SYLLABLES
    assert out.count() == len(rows) + 5


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert fit_language(docs) is None
    assert language_predictions(docs, None).first().lang_pred == "und"
    assert language_predictions(docs.limit(0), None).count() == 0


def test_copies_of_a_text_are_learned_from_once(spark, monkeypatch):
    texts = [text("aa", i) for i in range(50)]
    rows = [(i, t, "aa") for i, t in enumerate([*texts, *texts[:1] * 2000])] + [(9000, texts[0], "bb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    seen = []
    monkeypatch.setattr(language, "train", lambda x, y, *_: seen.append((x, y)))
    fit_language(docs)
    x, y = seen[0]
    assert len(x) == sum(min(4, max(1, len(t.encode()) - 63)) for t in [*texts, texts[0]])
    assert (y == 1).sum() == 4
    fit_language(docs, sample_rows=20)
    assert 4 * 5 <= (seen[1][1] == 0).sum() <= 4 * 40


def test_all_languages_are_learned(spark):
    names = [f"l{i:03}" for i in range(520)]
    docs = spark.createDataFrame([(f"text of {n}", n) for n in names for _ in range(2)], "text string, lang string")
    model = fit_language(docs, rounds=1)
    assert model.languages == names
    assert document_probabilities(model, [b"some text", b""]).shape == (2, 520)


def test_number_signs_are_no_letters_and_columns_keep_their_names(spark):
    rows = [(1, "½ ² ①", "own"), (2, "Ⅷ", "own"), (3, "123 _", "own"), (4, None, "own")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _language string")
    out = language_predictions(docs, new_model(["aa", "bb"], 4, 1))
    assert out.columns == [*docs.columns, "lang_pred", "score"]
    assert {(r.lang_pred, r.score, r._language) for r in out.collect()} == {("und", 0.0, "own")}
    (named,) = language_predictions(docs.limit(0).union(spark.createDataFrame([(5, "x", "own")], docs.schema)), new_model(["aa", "bb"], 4, 1)).collect()
    assert named.lang_pred in ("aa", "bb")
