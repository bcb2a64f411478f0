"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols: insult, harm, future, target, negation, report, quote, stop or plain word. Four small
transducers rewrite the symbols of a clause and are composed into one table:

* negation turns an insult within three words after a negation into a negated one,
* reported speech turns what stands in quotation marks, or after a verb of saying, into reported,
* target turns an insult in a clause with a target into an aimed one, in either order,
* threat recognises future + harm + target.

What the composed machine emits is weighed clause by clause: each insult with its lexicon weight, each kind of
event with a weight that is learned. A document's score is the logistic value of the sums over its clauses.

The insult lexicon holds fixed words and what the labels teach: words and word beginnings that occur in many
more toxic documents than chance allows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlegrid.llm.batches import Memo, map_texts

# ---- alphabet ----

WORD, INSULT, HARM, FUTURE, TARGET, NOT, REPORT, QUOTE, STOP, BREAK = range(10)
# what transducers add
NEGATED, REPORTED, AIMED, AIM_LATE, THREAT = range(10, 15)

# fixed values: words of the grammar
INSULTS = ("idiot", "moron", "stupid", "scum", "trash", "clown", "loser", "pathetic", "worthless", "disgusting", "imbecile", "bastard", "vermin", "dumb")
HARMS = ("kill", "hurt", "beat", "destroy", "shoot", "stab", "burn", "crush", "strangle", "murder", "punch")
FUTURES = ("will", "gonna", "going", "shall", "i'll", "we'll", "they'll", "should", "must")
TARGETS = ("you", "you're", "your", "yourself", "he", "she", "him", "her", "they", "them", "he's", "she's", "they're", "these", "those", "du", "ihr", "sie", "tu", "vous", "ils", "usted", "ellos")
NEGATIONS = ("not", "never", "no", "isn't", "aren't", "wasn't", "won't", "don't", "doesn't", "nobody", "hardly", "nicht", "kein", "keine", "pas", "jamais", "nunca")
REPORTS = ("said", "says", "wrote", "called", "claims", "claimed", "quoted", "reported", "allegedly", "sagte", "schrieb", "dit", "dijo")

#: Words after a negation, and words between future, harm and target, that still belong together.
REACH = 3
#: Word beginnings that the lexicon may learn, in characters; whole words are learned at any length.
ROOTS = (4, 5, 6, 7)
#: Training rows: all labelled ones if they are fewer, else about so many, chosen by a hash of doc_id.
TRAINING_ROWS = 20_000
#: Learned lexicon: entries at most, documents of the toxic label an entry needs, and the likelihood ratio it needs.
LEXICON, LEAST_DOCS, LEAST_RATIO = 5_000, 4, 18.0

#: Features of a document and the weights from which learning starts and towards which it is held.
EVENTS = {INSULT: 0, AIMED: 1, NEGATED: 2, REPORTED: 3, THREAT: 4}
PRIOR = np.array([2.5, 4.0, 0.2, 0.2, 5.0])
PRIOR_BIAS = -2.5


class Transducer:
    """Deterministic: (state, symbol) to (state, output). `rules` wins over `otherwise`, which names the next state of the rest."""

    def __init__(self, states: int, rules: dict[tuple[int, int], tuple[int, int]], otherwise: dict[int, int] | None = None):
        self.states, self.rules, self.otherwise = states, rules, otherwise or {}

    def step(self, state: int, symbol: int) -> tuple[int, int]:
        return self.rules.get((state, symbol)) or (self.otherwise.get(state, state), symbol)


def composed(machines: list[Transducer], symbols: int = 15) -> dict[tuple[int, int], tuple[int, int]]:
    """One table of the chain: each machine reads what the one before it writes; only states that can be reached."""
    start = (0,) * len(machines)
    number, table, todo = {start: 0}, {}, [start]
    while todo:
        states = todo.pop()
        for symbol in range(symbols):
            out, after = symbol, []
            for machine, state in zip(machines, states, strict=True):
                state, out = machine.step(state, out)
                after.append(state)
            key = tuple(after)
            if key not in number:
                number[key] = len(number)
                todo.append(key)
            table[number[states], symbol] = (number[key], out)
    return table


def grammar() -> dict[tuple[int, int], tuple[int, int]]:
    ends = (STOP, BREAK)
    # state n > 0: n - 1 words after a negation
    negation = Transducer(
        REACH + 1,
        {(s, NOT): (1, WORD) for s in range(REACH + 1)}
        | {(s, INSULT): (s, NEGATED) for s in range(1, REACH + 1)}
        | {(s, HARM): (s, WORD) for s in range(1, REACH + 1)}
        | {(s, e): (0, e) for s in range(REACH + 1) for e in ends},
        {s: (s + 1) % (REACH + 1) for s in range(1, REACH + 1)},
    )
    # 1: inside quotation marks, to their end or the line's; 2: after a verb of saying, to the clause's end
    reported = Transducer(
        3,
        {(0, QUOTE): (1, WORD), (1, QUOTE): (0, WORD), (2, QUOTE): (1, WORD), (0, REPORT): (2, WORD)}
        | {(s, x): (s, REPORTED) for s in (1, 2) for x in (INSULT, NEGATED)}
        | {(s, HARM): (s, WORD) for s in (1, 2)}
        | {(2, STOP): (0, STOP)}
        | {(s, BREAK): (0, BREAK) for s in (1, 2)},
    )
    # 1: the clause has a target; 2: it has an insult and no target yet
    target = Transducer(
        3,
        {(0, TARGET): (1, TARGET), (1, INSULT): (1, AIMED), (0, INSULT): (2, INSULT), (2, TARGET): (1, AIM_LATE)}
        | {(s, e): (0, e) for s in (1, 2) for e in ends},
    )
    # 1..REACH: words after a future; the next REACH states: words after harm
    after_harm = range(REACH + 1, 2 * REACH + 1)
    threat = Transducer(
        2 * REACH + 1,
        {(s, FUTURE): (1, WORD) for s in range(2 * REACH + 1)}
        | {(s, HARM): (REACH + 1, WORD) for s in range(1, REACH + 1)}
        | {(s, TARGET): (0, THREAT) for s in after_harm}
        | {(s, e): (0, e) for s in range(2 * REACH + 1) for e in ends},
        {s: s + 1 if s not in (REACH, 2 * REACH) else 0 for s in range(1, 2 * REACH + 1)},
    )
    return composed([negation, reported, target, threat])


_FIXED = {
    w: kind
    for kind, words in ((INSULT, INSULTS), (HARM, HARMS), (FUTURE, FUTURES), (TARGET, TARGETS), (NOT, NEGATIONS), (REPORT, REPORTS))
    for w in words
}
_MARKS = frozenset("\"“”„«»")
_STOPS = frozenset(".!?;:,…")
# those that end a clause without a word before them
_ALONE = frozenset(".!?;…")
# two hyphens are a dash and part words, one doesn't
_INNER = re.compile(r"[^\W_](?:(?:[\w'’]|-(?!-))*[^\W_])?")
_JOINTS = re.compile(r"[-_]+")


@dataclass(frozen=True)
class Model:
    """words and roots: lexicon weights in (0, 1]; weights and bias: of the events."""

    words: dict[str, float]
    roots: dict[str, float]
    weights: tuple[float, ...] = tuple(PRIOR)
    bias: float = PRIOR_BIAS


class Scorer:
    """Reads texts clause by clause."""

    REMEMBERED = 100_000
    #: Longer pieces are read each time.
    LONGEST = 64

    def __init__(self, model: Model):
        self.model = model
        self.table = grammar()
        self.symbols = Memo(self._symbols, self.REMEMBERED)

    def insult(self, word: str) -> float:
        found = self.model.words.get(word, 0.0)
        for n in ROOTS:
            if len(word) < n:
                break
            found = max(found, self.model.roots.get(word[:n], 0.0))
        return found

    def _kind(self, word: str) -> tuple[int, float]:
        kind = _FIXED.get(word, WORD)
        weight = 1.0 if kind == INSULT else self.insult(word) if kind == WORD else 0.0
        return (INSULT if weight else kind), weight

    def _symbols(self, raw: str) -> tuple[bool, tuple[tuple[int, float], ...]]:
        """Whether a word of the piece begins an event, and the symbols of its words and marks with their weights."""
        if raw == "\n":
            return False, ((BREAK, 0.0),)
        out, at = [], 0
        for inner in _INNER.finditer(raw):
            gap = raw[at : inner.start()]
            out += [(QUOTE, 0.0)] * sum(c in _MARKS for c in gap)
            out += [(STOP, 0.0)] * (at > 0 and not _STOPS.isdisjoint(gap))
            word = inner[0].replace("’", "'")
            own = [self._kind(word)]
            if own[0][0] == WORD and _JOINTS.search(word):
                # a compound is one word unless the grammar knows a part of it
                parts = [self._kind(w) for w in _JOINTS.split(word)]
                own = parts if any(kind != WORD for kind, _ in parts) else own
            out += own
            at = inner.end()
        tail = raw[at:]
        out += [(QUOTE, 0.0)] * sum(c in _MARKS for c in tail)
        out += [(STOP, 0.0)] * (not (_STOPS if at else _ALONE).isdisjoint(tail))
        return any(kind in (INSULT, HARM) for kind, _ in out), tuple(out)

    def events(self, text: str | None) -> np.ndarray:
        """Weight of each kind of event, summed over clauses."""
        out = np.zeros(len(EVENTS))
        if not text:
            return out
        pieces = [p for line in text.lower().splitlines() for p in (*line.split(), "\n")]
        told = [self.symbols[p] if len(p) <= self.LONGEST else self._symbols(p) for p in pieces]
        if not any([begins for begins, _ in told]):
            return out
        state, pending = 0, 0.0
        for _, symbols in told:
            for symbol, weight in symbols:
                state, event = self.table[state, symbol]
                if event == INSULT:
                    pending += weight
                elif event == AIM_LATE:
                    # the clause's target comes after its insults
                    out[EVENTS[AIMED]] += pending
                    pending = 0.0
                elif event in (STOP, BREAK):
                    out[EVENTS[INSULT]] += pending
                    pending = 0.0
                elif event in EVENTS:
                    out[EVENTS[event]] += 1.0 if event == THREAT else weight
        out[EVENTS[INSULT]] += pending
        return out

    def score(self, text: str | None) -> float:
        x = self.model.bias + float(np.dot(np.log1p(self.events(text)), self.model.weights))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


# ---- learning ----


def training_rows(docs: DataFrame, labels: DataFrame, rows: int, folds: int, id_col: str, text_col: str) -> DataFrame:
    """Labelled rows outside the held-out fold as (text, toxic): all, or about `rows` of them by a hash of the id."""
    key = F.col(id_col).cast("string")
    told = (
        labels.where(F.col("toxic").isNotNull() & (F.crc32(key) % folds != 0))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    total = told.count()
    if total > rows:
        told = told.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < int((1 << 30) * rows / total))
    # at most about `rows` narrow rows
    picked = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    return picked.join(F.broadcast(told), "_id").select("text", "toxic")


def _units(text: str) -> set[str]:
    """Words as themselves, word beginnings with a hyphen after them."""
    words = set(_INNER.findall(text.lower()))
    return words | {f"{w[:n]}-" for n in ROOTS for w in words if len(w) > n}


def learn_lexicon(training: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Words and roots whose documents are toxic more often than chance allows, by the likelihood ratio."""

    def count(batches):
        toxic, every = Counter(), Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(every)), pa.array([toxic[u] for u in every], pa.int64()), pa.array(list(every.values()), pa.int64())], names=["unit", "toxic", "docs"])
            toxic.clear(), every.clear()
            return out

        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                units = _units(text or "")
                every.update(units)
                if y:
                    toxic.update(units)
                if len(every) > 300_000:
                    yield flush()
        if every:
            yield flush()

    counts = training.mapInArrow(count, "unit string, toxic long, docs long").groupBy("unit").agg(F.sum("toxic").alias("t"), F.sum("docs").alias("d"))
    totals = training.agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("d")).first()
    if not totals["t"] or totals["t"] == totals["d"]:
        return {}, {}
    rate = totals["t"] / totals["d"]

    def part(observed, expected):
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    t, d = F.col("t"), F.col("d")
    ratio = 2 * (part(t, d * rate) + part(d - t, d * (1 - rate)))
    weight = (t + 0.5 * rate) / (d + 0.5)
    best = (
        counts.where((t >= LEAST_DOCS) & (t > d * rate))
        .select("unit", ratio.alias("ratio"), weight.alias("weight"))
        .where((F.col("ratio") >= LEAST_RATIO) & (F.col("weight") >= 0.6))
        .orderBy(F.desc("ratio"), "unit")
        .limit(LEXICON)
        .collect()
    )
    words = {r["unit"]: float(r["weight"]) for r in best if not r["unit"].endswith("-")}
    roots = {r["unit"][:-1]: float(r["weight"]) for r in best if r["unit"].endswith("-")}
    return words, roots


def fit_weights(features: np.ndarray, toxic: np.ndarray, steps: int = 200, hold: float = 1.0) -> tuple[np.ndarray, float]:
    """Logistic regression held towards the prior weights; by Newton's steps. Weights don't fall below zero."""
    x = np.column_stack([np.log1p(features), np.ones(len(features))])
    start = np.append(PRIOR, PRIOR_BIAS)
    w = start.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - toxic) + hold * (w - start)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + hold * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return np.maximum(w[:-1], 0.0), float(w[-1])


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, folds: int = 5, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Lexicon and weights from labelled rows whose crc32(id as text) mod folds is not 0. Without labels of both kinds: the fixed grammar."""
    training = training_rows(docs, labels, rows, folds, id_col, text_col)
    words, roots = learn_lexicon(training)
    first = Model(words, roots)

    def read(batches):
        scorer = Scorer(first)
        for batch in batches:
            made = [scorer.events(t).tolist() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.list_(pa.float64())), batch.column(1)], names=["x", "toxic"])

    # equal rows are counted, so what comes to the driver is at most the bounded sample
    seen = training.mapInArrow(read, "x array<double>, toxic int").collect()
    if not seen:
        return first
    weights, bias = fit_weights(np.array([r["x"] for r in seen]), np.array([r["toxic"] for r in seen], float))
    return Model(words, roots, tuple(weights.tolist()), bias)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of docs: id, what `keep` names, score (0 to 1) and the weight of each event.

    Null and empty texts get the score of a text without events; repeated rows and null ids each keep their row;
    other columns are ignored; the score depends on the text alone.
    """
    names = ("insult", "aimed", "negated", "reported", "threat")
    columns = [T.StructField("score", T.DoubleType()), *[T.StructField(n, T.DoubleType()) for n in names]]

    def make():
        scorer = Scorer(model)

        def apply(texts):
            events = [scorer.events(t) for t in texts]
            x = model.bias + np.log1p(np.array(events).reshape(-1, len(names))) @ np.array(model.weights)
            return [1 / (1 + np.exp(-np.clip(x, -30, 30))), *np.array(events).reshape(-1, len(names)).T]

        return apply

    return map_texts(docs, make, columns, id_col, text_col, keep)
