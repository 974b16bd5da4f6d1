"""Toxicity by a weighted finite-state grammar over clauses."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from math import log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from sedimenta.llm.texts import shingle_sets
from sedimenta.session import stored

# Fixed word lists of the grammar, in four languages.  Insults are learned.
THREATS = frozenset(
    "kill hurt destroy murder strangle stab shoot töten umbringen vernichten verletzen erschießen "
    "tuer détruire blesser frapper étrangler matar destruir golpear herir estrangular".split()
)
# Who an insult can be aimed at; a threat is aimed at someone spoken to, in English behind it.
TARGETS = frozenset("he she they him her them du ihr sie er tu ton ta il elle ils tú él ella ellos your yours".split())
SPOKEN_TO, AIMED_AT = frozenset(["you"]), frozenset("dich dir euch te toi vous ti usted".split())
NEGATIONS = frozenset(
    "not no never neither nor without isn't don't nicht kein keine nie niemals ohne pas jamais aucun sans nunca jamás ni sin".split()
)
REPORTS = frozenset(
    "said says wrote quoted claimed called reported sagte schrieb nannte behauptete dit écrit appelé prétend dijo escribió llamó".split()
)
_TOKENS = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?\n]|[,;:]|[\"“”«»]")
_ENDS, _BREAKS, _QUOTES = frozenset(".!?\n"), frozenset(",;:"), frozenset("\"“”«»")

#: Lengths of stems, longest first, and the least length of a word that has them.
_STEMS, _STEMMED = (8, 7, 6, 5, 4), 5

#: Symbols between the transducers.  Lower layers rewrite I and T, the rest passes.
#: I insult, T threat, P target (Y and O: one spoken to), N negation, R reporting verb, Q quote, C clause
#: break, o other word; after the layers also insults that are negated (n), reported (q)
#: or aimed at a target (A), and such threats (m, r, B).
SYMBOLS = "ITPYONRQConqAmrB"
#: Weight of a threatening word; learned insults weigh from 0.1 to as much.
_THREAT = 1.5
#: What a clause can be, the strongest first, and each one's weight before any label is seen.
FEATURES = {"B": 1.8, "A": 1.2, "T": 0.3, "I": 1.0, "r": 0.1, "q": 0.4, "m": 0.1, "n": 0.4}


class Transducer:
    """A finite-state transducer over SYMBOLS: per state and symbol, the next state
    and the symbol that goes out.  What a rule leaves out passes unchanged."""

    def __init__(self, states: int, rules: dict[tuple[int, str], tuple[int, str]]):
        n = len(SYMBOLS)
        self.next = np.repeat(np.arange(states), n).reshape(states, n)
        self.out = np.tile(np.arange(n), (states, 1))
        for (state, symbol), (to, out) in rules.items():
            self.next[state, SYMBOLS.index(symbol)] = to
            self.out[state, SYMBOLS.index(symbol)] = SYMBOLS.index(out)

    def then(self, other: Transducer) -> Transducer:
        """The composition: ``other`` reads what this one writes."""
        mine, theirs = len(self.next), len(other.next)
        both = Transducer(mine * theirs, {})
        for a in range(mine):
            for b in range(theirs):
                between = self.out[a]
                both.next[a * theirs + b] = self.next[a] * theirs + other.next[b, between]
                both.out[a * theirs + b] = other.out[b, between]
        return both

    @cached_property
    def _steps(self) -> list[list[tuple[int, int]]]:
        return [list(zip(*rows, strict=True)) for rows in zip(self.next.tolist(), self.out.tolist(), strict=True)]

    def run(self, symbols: list[int]) -> list[int]:
        state, out, steps = 0, [], self._steps
        for s in symbols:
            state, made = steps[state][s]
            out.append(made)
        return out


def _fading(opens: str, span: int, becomes: dict[str, str]) -> Transducer:
    """After one of ``opens``, symbols within ``span`` words become others; a clause break ends it."""
    rules = {}
    for left in range(span + 1):
        rules |= {(left, s): (span, s) for s in opens}
        rules[left, "C"] = (0, "C")
        for s in SYMBOLS:
            if s not in opens + "C":
                rules[left, s] = (max(0, left - 1), becomes.get(s, s) if left else s)
    return Transducer(span + 1, rules)


def _reported() -> Transducer:
    """Inside quotes, or after a reporting verb to the end of the sentence, insults
    and threats are reported."""
    rules = {(0, "Q"): (1, "Q"), (1, "Q"): (0, "Q"), (0, "R"): (2, "R"), (2, "Q"): (1, "Q")}
    rules |= {(state, s): (state, to) for state in (1, 2) for s, to in (("I", "q"), ("T", "r"))}
    return Transducer(3, rules)


#: Negation first, then reported speech, then a target before what is left.
LAYERS = (
    _fading("N", 3, {"I": "n", "T": "m"}),
    _reported(),
    _fading("PYO", 4, {"I": "A"}),
    _fading("O", 4, {"T": "B"}),
)
GRAMMAR = LAYERS[0].then(LAYERS[1]).then(LAYERS[2]).then(LAYERS[3])
#: A target behind it: this one reads from the end.
BACKWARD = _fading("PYO", 3, {"I": "A"}).then(_fading("YO", 3, {"T": "B"}))


def clause_symbols(symbols: list[int]) -> list[int]:
    """What all layers make of a sentence."""
    return BACKWARD.run(GRAMMAR.run(symbols)[::-1])[::-1]


@dataclass(frozen=True)
class ToxicityModel:
    """Insults with their weights, and the weights of the grammar's outputs."""

    insults: dict[str, float]
    weights: tuple[float, ...]
    bias: float

    def __post_init__(self):
        symbols = {w: "R" for w in REPORTS} | {w: "N" for w in NEGATIONS} | {w: "P" for w in TARGETS}
        symbols |= {w: "Y" for w in SPOKEN_TO} | {w: "O" for w in AIMED_AT}
        symbols |= {w: "T" for w in THREATS} | {w: "I" for w in self.insults}
        symbols |= dict.fromkeys(_QUOTES, "Q") | dict.fromkeys(_BREAKS, "C")
        object.__setattr__(self, "_symbols", {w: SYMBOLS.index(s) for w, s in symbols.items()})
        object.__setattr__(self, "_seen", frozenset(THREATS | set(self.insults)))
        stems = sorted(re.escape(w[:-1]) for w in self.insults if w.endswith("*"))
        object.__setattr__(self, "_stems", re.compile(rf"(?<![^\W\d_])(?:{'|'.join(stems)})" if stems else r"(?!)"))

    def _form(self, word: str) -> str:
        """The word, or the stem by which it is known."""
        if word not in self._symbols and len(word) >= _STEMMED:
            for n in _STEMS:
                if (stem := word[:n] + "*") in self.insults:
                    return stem
        return word

    def features(self, text: str | None) -> np.ndarray:
        """Summed weights of matched clauses by what the grammar makes of each as a whole."""
        sums = dict.fromkeys(FEATURES, 0.0)
        lower = (text or "").lower()
        tokens = _TOKENS.findall(lower)
        if self._stems.search(lower):
            tokens = [self._form(t) for t in tokens]
        if not self._seen.isdisjoint(tokens):
            sentence: list[str] = []
            for token in [*tokens, "."]:
                if token in _ENDS:
                    if not self._seen.isdisjoint(sentence):
                        self._count(sentence, sums)
                    sentence = []
                else:
                    sentence.append(token)
        return np.array(list(sums.values()))

    def _count(self, sentence: list[str], sums: dict[str, float]) -> None:
        """Add the weights of each clause's matches to what its strongest match makes it."""
        other = SYMBOLS.index("o")
        clause: dict[str, float] = {}
        made = clause_symbols([self._symbols.get(t, other) for t in sentence])
        for token, symbol in [*zip(sentence, made, strict=True), (",", SYMBOLS.index("C"))]:
            name = SYMBOLS[symbol]
            if name == "C":
                if clause:
                    sums[next(f for f in FEATURES if f in clause)] += sum(clause.values())
                clause = {}
            elif name in sums and token in self._seen:
                clause[name] = clause.get(name, 0.0) + self.insults.get(token, _THREAT)

    def score(self, features: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(features @ np.array(self.weights) + self.bias, -30, 30))))


#: Weights are sums of steps that are never negative, so that an aimed clause weighs no less than the same
#: one unaimed, and that no less than a negated and a reported one together.  An aimed threat, of which few
#: labels tell, also weighs no less than an aimed insult.
_STEPS = {
    "n": "n", "q": "q", "I": "nqi", "A": "nqia",
    "m": "m", "r": "r", "T": "mrt", "B": "mrtnqiab",
}
_STEP_NAMES = "nqiamrtb"


def _learned_weights(x: np.ndarray, y: np.ndarray, count: np.ndarray) -> tuple[tuple[float, ...], float]:
    """Logistic regression by Newton steps over non-negative steps, drawn to the grammar's own weights."""
    made = np.array([[float(step in _STEPS[f]) for step in _STEP_NAMES] for f in FEATURES])
    start = {f: 2.0 * w for f, w in FEATURES.items()}
    own = {"i": start["I"] - start["n"] - start["q"], "a": start["A"] - start["I"]}
    own |= {"t": start["T"] - start["m"] - start["r"], "b": start["B"] - start["T"] - start["A"]}
    prior = np.array([*[max(0.0, own.get(s, start.get(s, 0.0))) for s in _STEP_NAMES], -2.5])
    design = np.hstack([x @ made, np.ones((len(x), 1))])
    pull = np.array([1.0] * len(_STEP_NAMES) + [0.01])
    sign = np.where(y > 0, 1.0, -1.0)

    def loss(z: np.ndarray) -> float:
        return float(count @ np.logaddexp(0, -sign * (design @ z)) + 0.5 * (pull * (z - prior) ** 2).sum())

    z, best = prior.copy(), loss(prior)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(design @ z, -30, 30)))
        gradient = design.T @ (count * (p - y)) + pull * (z - prior)
        free = (z > 0) | (gradient < 0)
        free[-1] = True
        hessian = (design * (count * p * (1 - p))[:, None]).T @ design + np.diag(pull)
        step = np.zeros(len(z))
        step[free] = np.linalg.solve(hessian[np.ix_(free, free)], gradient[free])
        size = 1.0
        while size > 1e-6:
            next_ = z - size * step
            next_[:-1] = np.maximum(next_[:-1], 0.0)
            if (found := loss(next_)) <= best:
                break
            size /= 2
        if size <= 1e-6 or best - found < 1e-9 * max(1.0, abs(best)):
            break
        z, best = next_, found
    return tuple(float(v) for v in made @ z[:-1]), float(z[-1])


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = 20_000,
    least_evidence: float = 20.0,
    insult_words: int = 5_000,
) -> ToxicityModel:
    """Learn from ``labels`` (``doc_id``, ``toxic``) and the texts of ``docs``.

    About ``sample_rows`` labelled documents are used, chosen by a hash; this bound
    is the only sampling, and scoring is over all rows.  Near copies (equal least
    shingle) count once.  A word, or a stem with any ending, is an
    insult if most documents with it are toxic, with a log-likelihood ratio of
    ``least_evidence`` against the average; the ``insult_words`` strongest are kept.  Labels that are NULL are left out;
    without any label the grammar's own weights hold.
    """
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "toxic")
    rows = known.count()
    wide = 1 << 30
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(wide)) < int(wide * min(1.0, sample_rows / max(1, rows))))
    # Bounded by sample_rows, whatever the tables' size.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    @F.pandas_udf("long")
    def key(text: pd.Series) -> pd.Series:
        sets = shingle_sets([(t or "").encode() for t in text])
        return pd.Series([int(s[0] >> np.uint64(1)) if len(s) else -1 for s in sets], dtype="int64")

    train = stored(
        texts.withColumn("key", key("text"))
        .groupBy("key", "toxic")
        .agg(F.min_by("text", "doc_id").alias("text"))
        .select("text", "toxic")
        .repartition(24),
        "toxicity-sample",
    )

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen, bad = Counter(), Counter()
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                own = {t for t in _TOKENS.findall((text or "").lower()) if t[0].isalpha()}
                own |= {t[:n] + "*" for t in own if len(t) >= _STEMMED for n in _STEMS}
                seen.update(own)
                if toxic:
                    bad.update(own)
            if seen:
                yield pd.DataFrame(
                    {"word": list(seen), "n": list(seen.values()), "bad": [bad.get(w, 0) for w in seen]}
                )

    total = train.agg(F.count(F.lit(1)), F.sum(F.when(F.col("toxic") != 0, 1).otherwise(0))).first()
    n_docs, n_bad = total[0], total[1] or 0
    insults: dict[str, float] = {}
    if 0 < n_bad < n_docs:
        share = n_bad / n_docs
        counts = train.mapInPandas(words, "word string, n long, bad long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        p, good = F.col("bad") / F.col("n"), F.col("n") - F.col("bad")
        evidence = 2 * (
            F.col("bad") * F.log(p / share) + F.when(good > 0, good * F.log((1 - p) / (1 - share))).otherwise(F.lit(0.0))
        )
        strong = counts.filter((F.col("bad") >= 3) & (p > max(0.5, share))).withColumn("g", evidence)
        top = strong.filter(F.col("g") >= least_evidence).orderBy(F.desc("g"), "word").limit(insult_words)
        odds = {
            r["word"]: log((r["bad"] + 0.5) / (r["n"] - r["bad"] + 0.5)) - log(share / (1 - share)) for r in top.collect()
        }
        typical = float(np.median(list(odds.values()))) if odds else 1.0
        insults = {w: min(_THREAT, max(0.1, v / typical)) for w, v in odds.items()}
    unfitted = ToxicityModel(insults, tuple(2.0 * w for w in FEATURES.values()), -2.5)
    if not 0 < n_bad < n_docs:
        return unfitted

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"x": [unfitted.features(t) for t in batch["text"]], "y": batch["toxic"] != 0})

    fitted = train.mapInPandas(features, "x array<double>, y boolean").groupBy("x", "y").count().collect()
    x, y, n = (np.array([r[name] for r in fitted], dtype=float) for name in ("x", "y", "count"))
    return ToxicityModel(insults, *_learned_weights(x, y, n))


def toxicity_scores(docs: DataFrame, model: ToxicityModel, name: str = "score") -> DataFrame:
    """``docs`` with the score of its ``text``, from 0 to 1.

    One pass over whole texts, no shuffle; NULL and empty texts get the score of a
    text without matches.  All other columns and repeated rows stay; a column that has the
    name ``name`` already is replaced by the score.
    """

    def scored(text: pa.Array) -> pa.Array:
        return pa.array([model.score(model.features(t.as_py())) for t in text], pa.float64())

    return docs.withColumn(name, F.arrow_udf(scored, DoubleType())("text"))
