"""Language identification by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from sedimenta.llm.carried import unused

#: Input number of positions after the end of a text.
_PAD = 256
#: Bytes of a stretch that the network reads at once, in training and in use.
TRAIN_STEPS, STEPS = 64, 128
#: Stretches computed together, with many languages fewer: so many probabilities a position.
_BATCH, _CELLS = 4096, 1 << 18
#: Stretches of a training batch.
_TOGETHER = 128
#: Prediction for texts without any letter.
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")  # a letter by its category: signs for numbers are none


@dataclass
class LanguageModel:
    """Both directions in one set of arrays, forward units first.

    ``inputs`` holds each byte's contribution to the gates (update, reset,
    candidate, for each direction), ``hidden`` the recurrent weights per direction
    and ``labels`` the weights from the units of both directions to the languages.
    """

    languages: list[str]
    inputs: np.ndarray  # direction, byte, 3 * units
    hidden: np.ndarray  # direction, units, 3 * units
    labels: np.ndarray  # 2 * units, languages
    bias: np.ndarray  # languages

    def parameters(self) -> list[np.ndarray]:
        return [self.inputs, self.hidden, self.labels, self.bias]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def new_model(languages: list[str], units: int, seed: int) -> LanguageModel:
    random = np.random.default_rng(seed)

    def start(*shape: int, scale: float) -> np.ndarray:
        return (random.standard_normal(shape) * scale).astype(np.float32)

    inputs = start(2, _PAD + 1, 3 * units, scale=0.3)
    hidden = start(2, units, 3 * units, scale=units**-0.5)
    return LanguageModel(
        languages, inputs, hidden, start(2 * units, len(languages), scale=0.3), np.zeros(len(languages), np.float32)
    )


def train_step(model: LanguageModel, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Loss and gradients for stretches ``x`` (rows of byte numbers) of languages ``y``.

    Every position inside a text is labelled; the gradient goes back through all
    steps of both directions.
    """
    rows, steps = x.shape
    units = model.hidden.shape[1]
    seen = x != _PAD
    states = np.zeros((2, steps + 1, rows, units), np.float32)
    gates = np.empty((2, steps, rows, 3 * units), np.float32)
    inner = np.empty((2, steps, rows, units), np.float32)
    order = (range(steps), range(steps - 1, -1, -1))
    for d in range(2):
        h = states[d, 0]
        for i, t in enumerate(order[d]):
            a = model.inputs[d][x[:, t]]
            u = h @ model.hidden[d]
            zr = _sigmoid(a[:, : 2 * units] + u[:, : 2 * units])
            z, r = zr[:, :units], zr[:, units:]
            n = np.tanh(a[:, 2 * units :] + r * u[:, 2 * units :])
            h = h + z * (n - h)
            gates[d, i, :, : 2 * units], gates[d, i, :, 2 * units :], inner[d, i], states[d, i + 1] = zr, n, u[:, 2 * units :], h
    # Units at position t, of both directions.
    both = np.concatenate([states[0, 1:], states[1, 1:][::-1]], axis=2)
    logits = both @ model.labels + model.bias
    logits -= logits.max(axis=2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=2, keepdims=True)
    weight = (seen.T / max(1, seen.sum())).astype(np.float32)
    picked = np.take_along_axis(p, y[None, :, None].repeat(steps, 0), axis=2)[:, :, 0]
    loss = float(-(np.log(picked + 1e-9) * weight).sum())
    back = p * weight[:, :, None]
    np.subtract.at(back, (np.arange(steps)[:, None], np.arange(rows)[None, :], y[None, :]), weight)
    grads = [np.zeros_like(w) for w in model.parameters()]
    grads[2] += np.tensordot(both, back, axes=([0, 1], [0, 1]))
    grads[3] += back.sum(axis=(0, 1))
    to_units = back @ model.labels.T
    for d in range(2):
        from_labels = to_units[:, :, d * units : (d + 1) * units]
        dh = np.zeros((rows, units), np.float32)
        for i in range(steps - 1, -1, -1):
            t = i if d == 0 else steps - 1 - i
            dh = dh + from_labels[t]
            h, z, r, n = states[d, i], gates[d, i, :, :units], gates[d, i, :, units : 2 * units], gates[d, i, :, 2 * units :]
            dz = dh * (n - h) * z * (1 - z)
            dn = dh * z * (1 - n * n)
            dr = dn * inner[d, i] * r * (1 - r)
            da = np.concatenate([dz, dr, dn], axis=1)
            du = np.concatenate([dz, dr, dn * r], axis=1)
            np.add.at(grads[0][d], x[:, t], da)
            grads[1][d] += h.T @ du
            dh = dh * (1 - z) + du @ model.hidden[d].T
    return loss, grads


def train(x: np.ndarray, y: np.ndarray, languages: list[str], units: int, rounds: int, seed: int) -> LanguageModel:
    """Adam on shuffled batches, all languages weighing the same by how often they
    are drawn."""
    model, random = new_model(languages, units, seed), np.random.default_rng(seed)
    by_language = [np.flatnonzero(y == k) for k in range(len(languages))]
    first = [np.zeros_like(w) for w in model.parameters()]
    second = [np.zeros_like(w) for w in model.parameters()]
    each = max(1, _TOGETHER // len(languages))
    # More languages than a batch holds take turns.
    rounds *= -(-len(languages) // _TOGETHER)
    for step in range(1, rounds + 1):
        drawn = range(len(languages)) if len(languages) <= _TOGETHER else random.choice(len(languages), _TOGETHER, replace=False)
        rows = np.concatenate([random.choice(by_language[k], each) for k in drawn])
        _, grads = train_step(model, x[rows], y[rows])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = 0.02 * (1 - step / (rounds + 1)) + 0.001
        for w, g, m, v in zip(model.parameters(), grads, first, second, strict=True):
            g *= min(1.0, 1.0 / (norm + 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model


def stretches(text: bytes, steps: int) -> np.ndarray:
    """The whole text in rows of ``steps`` byte numbers, the last one padded."""
    rows = -(-len(text) // steps)
    out = np.full(rows * steps, _PAD, dtype=np.int16)
    out[: len(text)] = np.frombuffer(text, dtype=np.uint8)
    return out.reshape(rows, steps)


def position_probabilities(model: LanguageModel, x: np.ndarray) -> np.ndarray:
    """Probabilities (step, row, language) of every position of the rows."""
    rows, steps = x.shape
    units = model.hidden.shape[1]
    both = 2 * units
    # Both directions run side by side: one step reads a row from its two ends.
    ahead, behind = model.inputs
    hidden = np.zeros((both, 3 * both), np.float32)
    tables = np.zeros((2, len(ahead), 3 * both), np.float32)
    for gate in range(3):
        for d in range(2):
            to = slice(gate * both + d * units, gate * both + (d + 1) * units)
            hidden[d * units : (d + 1) * units, to] = model.hidden[d][:, gate * units : (gate + 1) * units]
            tables[d, :, to] = model.inputs[d][:, gate * units : (gate + 1) * units]
    # Gates through tanh only: sigmoid(x) = tanh(x / 2) / 2 + 1 / 2.
    hidden[:, : 2 * both] *= 0.5
    tables[:, :, : 2 * both] *= 0.5
    h = np.zeros((rows, both), np.float32)
    logits = np.empty((2, steps, rows, len(model.languages)), np.float32)
    columns = np.ascontiguousarray(x.T)
    for i in range(steps):
        a = tables[0].take(columns[i], axis=0)
        a += tables[1].take(columns[steps - 1 - i], axis=0)
        u = h @ hidden
        zr = a[:, : 2 * both]
        zr += u[:, : 2 * both]
        np.tanh(zr, out=zr)
        zr *= 0.5
        zr += 0.5
        n = u[:, 2 * both :]
        n *= zr[:, both:]
        n += a[:, 2 * both :]
        np.tanh(n, out=n)
        n -= h
        n *= zr[:, :both]
        h = h + n
        logits[0, i] = h[:, :units] @ model.labels[:units]
        logits[1, steps - 1 - i] = h[:, units:] @ model.labels[units:]
    p = logits[0]
    p += logits[1]
    p += model.bias
    p -= p.max(axis=2, keepdims=True)
    np.exp(p, out=p)
    p /= p.sum(axis=2, keepdims=True)
    return p


def document_probabilities(model: LanguageModel, texts: list[bytes]) -> np.ndarray:
    """The mean over all positions of each text; rows of zeros for empty texts.

    Stretches of many texts are computed together and added up per text, so memory
    doesn't depend on a text's length.
    """
    totals = np.zeros((len(texts), len(model.languages)))
    batch = max(1, min(_BATCH, _CELLS // len(model.languages)))
    waiting, owners, held = [], [], 0

    def flush() -> None:
        x, owner = np.concatenate(waiting), np.concatenate(owners)
        for at in range(0, len(x), batch):
            part = x[at : at + batch]
            p = position_probabilities(model, part)
            p *= (part.T != _PAD)[:, :, None]
            np.add.at(totals, owner[at : at + batch], p.sum(axis=0, dtype=np.float64))

    for i, text in enumerate(texts):
        for start in range(0, len(text), STEPS * _BATCH):
            rows = stretches(text[start : start + STEPS * _BATCH], STEPS)
            waiting.append(rows)
            owners.append(np.full(len(rows), i))
            held += len(rows)
            if held >= _BATCH:
                flush()
                waiting, owners, held = [], [], 0
    if held:
        flush()
    lengths = np.array([max(1, len(t)) for t in texts], dtype=float)
    return totals / lengths[:, None]


def fit_language(
    docs: DataFrame,
    sample_rows: int = 4_000,
    windows: int = 4,
    units: int = 8,
    rounds: int = 600,
    seed: int = 7,
) -> LanguageModel | None:
    """Learn from ``text`` and non-NULL ``lang`` of ``docs``; None without any.

    About ``sample_rows`` different texts per language are used, chosen by a hash,
    with ``windows`` stretches of each, evenly spread; this bound is the only
    sampling.  Copies of a text count once.  All languages are learned.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "text", "lang", F.xxhash64("text").alias("_h")
    )
    texts = known.select("lang", "_h").distinct()
    counts = texts.groupBy("lang").count().collect()
    if not counts:
        return None
    limits = {r["lang"]: int((1 << 30) * min(1.0, sample_rows / r["count"])) for r in counts}

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()
        for batch in batches:
            out = []
            for text, lang, h in zip(batch["text"], batch["lang"], batch["_h"], strict=True):
                if h % (1 << 30) >= limits.get(lang, 0) or (lang, h) in seen:
                    continue
                seen.add((lang, h))
                if not _LETTER.search(text):
                    continue
                data = text.encode()
                last = max(0, len(data) - TRAIN_STEPS)
                starts = sorted({last * k // max(1, windows - 1) for k in range(windows)})
                out.append(([data[s : s + TRAIN_STEPS] for s in starts], lang, h))
            yield pd.DataFrame(out, columns=["x", "lang", "_h"])

    # Bounded: about sample_rows * windows stretches of TRAIN_STEPS bytes per language.
    cuts = known.mapInPandas(cut, "x array<binary>, lang string, _h long").dropDuplicates(["lang", "_h"])
    rows = cuts.select("lang", F.explode("x").alias("x")).orderBy("lang", "x").collect()
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    x = np.concatenate([stretches(bytes(r["x"]), TRAIN_STEPS) for r in rows])
    y = np.array([languages.index(r["lang"]) for r in rows])
    return train(x, y, languages, units, rounds, seed)


def language_predictions(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and its probability ``score``.

    Whole texts, one pass, no shuffle.  A text that is NULL or has no letter is
    ``und`` with score 0, as is every text when nothing could be learned.  All
    other columns, whatever their names, and repeated rows stay; columns of these two names are replaced.
    """
    kind = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def predict(text: pa.Array) -> pa.Array:
        lang = np.full(len(text), UNDETERMINED, dtype=object)
        score = np.zeros(len(text))
        for at in range(0, len(text), 1000):
            part = text[at : at + 1000].to_pylist()
            known = [i for i, t in enumerate(part) if model is not None and t is not None and _LETTER.search(t)]
            if known:
                p = document_probabilities(model, [part[i].encode() for i in known])
                places = at + np.array(known)
                lang[places] = np.array(model.languages, dtype=object)[p.argmax(axis=1)]
                score[places] = np.clip(p.max(axis=1), 0.0, 1.0)
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score)], ["lang_pred", "score"])

    made = unused("_language", docs.columns)
    named = docs.withColumn(made, F.arrow_udf(predict, kind)("text"))
    return named.withColumns({"lang_pred": F.col(made)["lang_pred"], "score": F.col(made)["score"]}).drop(made)
