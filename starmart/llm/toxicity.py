"""Clause toxicity by composed weighted transducers (operator 10).

Tokens pass through a cascade. The lexical acceptors (a trie of insult stems
with weights, and small word classes for threat, target, negation and reported
speech) turn words into classes. Three small transducers read the classes of a
clause: how far a negation reaches, whether speech is reported, whether a target was
named. They are composed once into one table of states, whose arcs give each matched insult
to one of four readings: negated, reported, aimed at a target, or plain; a threat counts
only unnegated and with a target in its clause. A document is scored from the weights of its matched clauses by a
logistic layer, so a word alone never decides how much it counts.

The stems are learned from labels: word beginnings (and whole words) that
toxic documents hold far more often than others. Both the stems and the
logistic layer are fitted on at most ``max_labelled`` labelled rows, those
with the least hash of their id; every document is scored from its whole text.

Defined cases: null and empty texts get the score of a text without a match;
rows whose labels are null are not learned from, and the larger label holds
where they disagree; without a toxic row the score is below 0.5 everywhere;
repeated rows and null ids are scored alike (a null id counts as not held
out); an empty table gives no rows; other columns are kept by
``toxicity_filter`` and ignored by ``score_documents``.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare

#: Words (one in "n't" keeps its apostrophe), ends of clauses, quotes.
_TOKEN = re.compile(r"[^\W\d_]+n['’]t(?!\w)|[^\W\d_]+|[.!?;:\n]+|[\"«»“”„]")
#: Word classes of the grammar.
THREAT = "kill hurt destroy beat burn töten tuer matar".split()
TARGET = "you your yourself he she they him her them du dich ihr sie vous toi tu ellos usted".split()
NEGATION = "not never no cannot nicht kein nie jamais pas nunca".split()
REPORTED = "said says wrote called claimed quoted sagte dit dijo".split()
#: Tokens after a negation that it still governs.
REACH = 3
WORD, BREAK, QUOTE, NEG, REP, TAR, THR, INSULT = range(8)
READINGS = ("plain", "aimed", "negated", "reported")
#: Least and greatest length of a stem; whole words end in "$".
STEM = (3, 8)


def negation(state: int, c: int) -> int:
    """How many tokens a negation still governs."""
    return REACH if c == NEG else max(0, state - 1)


def report(state: int, c: int) -> int:
    """Whether speech is reported from here to the clause's end."""
    return 1 if c in (REP, QUOTE) else state


def target(state: int, c: int) -> int:
    """Whether the clause has named a target."""
    return 1 if c == TAR else state


def composed(*parts) -> tuple[list[tuple[int, ...]], list[list[int]]]:
    """The product of transducers that read the same classes: its states, and its arcs by class.

    Each starts in 0, and so does the product after the end of a clause.
    """
    states, arcs = [(0,) * len(parts)], []
    for state in states:
        row = []
        for c in range(INSULT + 1):
            to = states[0] if c == BREAK else tuple(f(x, c) for f, x in zip(parts, state))
            if to not in states:
                states.append(to)
            row.append(states.index(to))
        arcs.append(row)
    return states, arcs


STATES, ARCS = composed(negation, report, target)
#: What a state makes of an insult: 0 open (plain or aimed, as the clause ends), 1 negated, 2 reported.
SLOT = [1 if n else 2 if q else 0 for n, q, _ in STATES]
AIMED = [bool(t) for _, _, t in STATES]


class Grammar:
    """The composed transducers for one lexicon of weighted stems."""

    def __init__(self, stems: dict[str, float]):
        self.stems = stems
        self.fixed = {w: c for ws, c in ((THREAT, THR), (TARGET, TAR), (NEGATION, NEG),
                                         (REPORTED, REP)) for w in ws}
        self.known: dict[str, int] = {}
        self.weights: dict[str, float] = {}

    def __getstate__(self):
        return {"stems": self.stems}

    def __setstate__(self, state):
        self.__init__(state["stems"])

    def _class(self, token: str) -> int:
        if not token[0].isalpha():
            return QUOTE if token in "\"«»“”„" else BREAK
        if token.endswith(("n't", "n’t")):
            return NEG
        paths = [token[:n] for n in range(STEM[0], min(STEM[1], len(token)) + 1)] + [token + "$"]
        weight = max((self.stems[p] for p in paths if p in self.stems), default=0.0)
        if weight:
            self.weights[token] = weight
            return INSULT
        return self.fixed.get(token, WORD)

    def classes(self, tokens: list[str]) -> list[int]:
        known = self.known
        if len(known) > 100_000:
            known.clear()
            self.weights.clear()
        for t in set(tokens):
            if t not in known:
                known[t] = self._class(t)
        return list(map(known.__getitem__, tokens))

    def features(self, text: str | None) -> list[float]:
        """Summed weights by reading (on a log scale), threats, and the largest weight."""
        sums, threats, top = [0.0] * len(READINGS), 0, 0.0
        tokens = _TOKEN.findall(text.lower()) if text else []
        classes = self.classes(tokens)
        if tokens and max(classes) >= THR:
            state, held, threat = 0, [0.0, 0.0, 0.0], 0
            for token, c in zip(tokens + ["."], classes + [BREAK]):
                if c == INSULT:
                    weight = self.weights[token]
                    held[SLOT[state]] += weight
                    top = max(top, weight)
                elif c == THR:
                    threat += SLOT[state] != 1
                elif c == BREAK:
                    sums[1 if AIMED[state] else 0] += held[0]
                    sums[2] += held[1]
                    sums[3] += held[2]
                    threats += threat if AIMED[state] else 0
                    held, threat = [0.0, 0.0, 0.0], 0
                state = ARCS[state][c]
        return [*np.log1p(sums), float(np.log1p(threats)), top]


class Scorer:
    def __init__(self, grammar: Grammar, weights: np.ndarray):
        self.grammar, self.weights = grammar, weights

    def scores(self, texts) -> np.ndarray:
        x = np.array([self.grammar.features(t) for t in texts], float).reshape(-1, 6)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[1:] + self.weights[0], -30, 30)))


def _document_features(batches):
    """How many toxic and other documents of these batches hold each stem."""
    counts = (Counter(), Counter())

    def flush():
        names = list(counts[0].keys() | counts[1].keys())
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string())] +
            [pa.array([c[n] for n in names], pa.int64()) for c in counts],
            names=["stem", "toxic", "other"])

    for b in batches:
        for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
            stems = set()
            for w in {t for t in _TOKEN.findall((text or "").lower()) if t[0].isalpha()}:
                stems.update(w[:n] for n in range(STEM[0], min(STEM[1], len(w)) + 1))
                stems.add(w + "$")
            counts[0 if toxic else 1].update(stems)
        if len(counts[0]) + len(counts[1]) > 300_000:
            yield flush()
            counts = (Counter(), Counter())
    yield flush()


def specific(stems: dict[str, tuple[float, int]]) -> dict[str, float]:
    """Weights of the stems, without those that a longer stem nearly always extends.

    ``stems``: weight and number of toxic documents. Short beginnings of an insult
    would match words that only begin like it.
    """
    general = {word[:n] for word, (_, k) in stems.items() if not word.endswith("$")
               for n in range(STEM[0], len(word))
               if word[:n] in stems and k >= 0.95 * stems[word[:n]][1]}
    return {s: w for s, (w, _) in stems.items() if s not in general}


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Newton steps; the intercept is not shrunk."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w, penalty = np.zeros(x.shape[1]), np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty,
                               x.T @ (y - p) - penalty @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000,
          max_stems: int = 5_000, least_gain: float = 20.0) -> Scorer:
    prepare(docs.sparkSession)
    marks = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()
                          & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    # At most max_labelled pairs of an id and a label.
    known = docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id").select(
        "text", "toxic").persist()
    n = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_other = n.get(1, 0), n.get(0, 0)
    if not n_toxic or not n_other:
        known.unpersist()
        bias = -5.0 if not n_toxic else 5.0
        return Scorer(Grammar({}), np.array([bias, 0, 0, 0, 0, 0, 0]))
    # A stem's gain is the log-likelihood ratio of its two rates against one.
    a, b, a_all, b_all = F.col("toxic"), F.col("other"), F.lit(n_toxic), F.lit(n_other)
    log = lambda part, of, rate: F.when(part > 0, part * F.log(part / of / rate)).otherwise(0.0)
    rate = (a + b) / (a_all + b_all)
    miss_rate = F.greatest(1 - rate, F.lit(1e-12))
    gain = 2 * (log(a, a_all, rate) + log(b, b_all, rate)
                + log(a_all - a, a_all, miss_rate) + log(b_all - b, b_all, miss_rate))
    odds = F.log((a + 0.5) / (a_all + 1)) - F.log((b + 0.5) / (b_all + 1))
    stems = (known.mapInArrow(_document_features, "stem string, toxic long, other long")
             .groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
             .where(a >= 4)
             .select("stem", "toxic", gain.alias("gain"), odds.alias("odds"))
             .where((F.col("gain") >= least_gain) & (F.col("odds") > 2.3))
             .orderBy(F.desc("gain"), "stem").limit(max_stems).collect())
    grammar = Grammar(specific({r["stem"]: (r["odds"], r["toxic"]) for r in stems}))

    def features(batches):
        for batch in batches:
            x = [grammar.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.list_(pa.float64())), batch.column("toxic").cast(pa.int32())],
                names=["x", "toxic"])

    rows = known.mapInArrow(features, "x array<double>, toxic int").collect()
    known.unpersist()
    x = np.array([r["x"] for r in rows], float)
    y = np.array([r["toxic"] for r in rows], float)
    # Sorted, so that sums do not depend on the order in which rows came.
    order = np.lexsort((*x.T, y))
    return Scorer(grammar, fit_logistic(x[order], y[order]))


def score_column(scorer: Scorer, text: Column) -> Column:
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(scorer.scores(texts.to_pylist()))
    return score(text)


def score_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    scorer = train(docs, labels, **options)
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                       score_column(scorer, F.col("text")).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def toxicity_filter(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents with a score under 0.5, with all their columns."""
    return docs.where(score_column(train(docs, labels, **options), F.col("text")) < 0.5)
