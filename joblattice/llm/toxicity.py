"""Toxicity by a learned lexicon, Levenshtein automata over its trie, and scores of the words around a hit.

The lexicon and the final logistic regression come from a bounded sample of labelled rows. A trie
holds the lexicon; the automaton that accepts everything within the allowed edits of any term is the
product of the trie with the Levenshtein automata of its terms, made deterministic as it is walked.
A hit inside quotation marks or behind a verb of reporting counts as quotation, a hit near a word of
address or near other hits as abuse; both kinds are features of their own.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from joblattice.llm.shared import crc_remainder, free_name, hash_sample, staged

# Words around a hit.
REPORTING = frozenset(
    "said says say called calls wrote writes quoted quote quotes word term sagte sagt nannte schrieb wort"
    " dit disait appelait mot dijo dice llamó palabra".split()
)
ADDRESS = frozenset("you your you're youre u ur du dich dir dein deine sie tu te toi vous votre tú ti usted eres".split())
OPENING, CLOSING = "\"'“‘«„", "\"'”’»“"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~“”‘’«»„…¡¿–—"


@dataclass(frozen=True)
class Spec:
    """``max_train_docs`` bounds the labelled sample, ``max_terms`` the lexicon; both hold at every size."""

    max_train_docs: int = 20_000
    max_terms: int = 500
    min_docs: int = 5
    min_log_odds: float = 3.0
    one_edit_from: int = 5
    two_edits_from: int = 9
    window: int = 6
    folds: int = 5


class Trie:
    """Terms as nodes ``[children, term, most edits allowed below]``, with the automaton walked over them."""

    MAX_STATES = 50_000

    def __init__(self, terms: dict[str, float], one_edit_from: int, two_edits_from: int):
        self.weights = terms
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.allowed = [0]
        self.edits = {t: (len(t) >= one_edit_from) + (len(t) >= two_edits_from) for t in terms}
        for t in sorted(terms):
            at = 0
            self.allowed[0] = max(self.allowed[0], self.edits[t])
            for ch in t:
                if ch not in self.children[at]:
                    self.children[at][ch] = len(self.term)
                    self.children.append({})
                    self.term.append(None)
                    self.allowed.append(0)
                at = self.children[at][ch]
                self.allowed[at] = max(self.allowed[at], self.edits[t])
            self.term[at] = t
        self.alphabet = frozenset("".join(terms))
        self._reset()

    def _reset(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.accepts: list[tuple[int, float, str] | None] = []
        self.start = self._state({0: 0}) if self.weights else -1

    def _state(self, nodes: dict[int, int]) -> int:
        """The number of a set of (node, edits); -1 if nothing can follow. Missing letters cost an edit each."""
        todo = list(nodes.items())
        while todo:
            node, e = todo.pop()
            if nodes.get(node, 99) < e:
                continue
            for child in self.children[node].values():
                if e + 1 <= self.allowed[child] and nodes.get(child, 99) > e + 1:
                    nodes[child] = e + 1
                    todo.append((child, e + 1))
        key = frozenset(nodes.items())
        if not key:
            return -1
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
            ends = [(e, -self.weights[t], t) for n, e in key if (t := self.term[n]) is not None and e <= self.edits[t]]
            self.accepts.append(min(ends) if ends else None)
        return self.states[key]

    def _move(self, state: int, ch: str) -> int:
        nodes: dict[int, int] = {}

        def put(node: int, e: int) -> None:
            if e <= self.allowed[node] and nodes.get(node, 99) > e:
                nodes[node] = e

        for node, e in self.sets[state]:
            put(node, e + 1)
            for c, child in self.children[node].items():
                put(child, e + (c != ch))
        return self._state(nodes)

    def match(self, word: str) -> tuple[int, str] | None:
        """(edits, term) of the nearest term within its allowed edits, the weightiest among equals."""
        if len(self.sets) > self.MAX_STATES:
            self._reset()
        state = self.start
        for ch in word:
            if state < 0:
                return None
            ch = ch if ch in self.alphabet else "\0"
            moves = self.moves[state]
            if ch not in moves:
                moves[ch] = self._move(state, ch)
            state = moves[ch]
        found = self.accepts[state] if state >= 0 else None
        return (found[0], found[2]) if found else None


def _core(token: str) -> str:
    return token.strip(PUNCTUATION)


def _terms_of(text: str) -> set[str]:
    return {w for t in set(text.lower().split()) if 3 <= len(w := _core(t)) <= 64}


@dataclass
class Model:
    spec: Spec
    lexicon: dict[str, float]
    prior: float
    coef: list[float] = field(default_factory=list)

    def __post_init__(self):
        self.trie = None

    def __getstate__(self):
        return {**self.__dict__, "trie": None}

    def _match(self, token: str) -> tuple[int, str] | None:
        if token not in self.seen:
            if len(self.seen) > 300_000:
                self.seen.clear()
            self.seen[token] = self.trie.match(_core(token))
        return self.seen[token]

    def features(self, text: str | None) -> list[float]:
        """Bias, weights of exact, misspelled and quoted hits, abuse near hits, different terms, density."""
        if self.trie is None:
            self.trie = Trie(self.lexicon, self.spec.one_edit_from, self.spec.two_edits_from)
            self.seen: dict[str, tuple[int, str] | None] = {}
        tokens = text.lower().split() if text else []
        match = self._match
        hot = {t: m for t in set(tokens) if (m := match(t)) is not None}
        if not hot:
            return [1.0] + [0.0] * 6 + [math.log1p(len(tokens))]
        at = [i for i, t in enumerate(tokens) if t in hot]
        exact = fuzzy = quoted = abuse = 0.0
        terms, w = set(), self.spec.window
        for i in at:
            edits, term = hot[tokens[i]]
            weight = self.lexicon[term]
            terms.add(term)
            around = tokens[max(0, i - w) : i + w + 1]
            quote, attack = self._context(tokens, i, around)
            if quote > attack:
                quoted += weight
            elif edits:
                fuzzy += weight / (1 + edits)
            else:
                exact += weight
            abuse += weight * attack
        density = 1000.0 * (exact + fuzzy) / (len(tokens) + 20)
        return [1.0] + [math.log1p(x) for x in (exact, fuzzy, quoted, abuse, len(terms), density)] + [math.log1p(len(tokens))]

    def _context(self, tokens: list[str], i: int, around: list[str]) -> tuple[float, float]:
        """How much the window speaks for quotation and for abuse."""
        w = self.spec.window
        opened = any(t[0] in OPENING for t in tokens[max(0, i - w) : i + 1])
        closed = any(t[-1] in CLOSING or t.rstrip(".,;:!?")[-1:] in tuple(CLOSING) for t in tokens[i : i + w + 1])
        cores = [_core(t) for t in around]
        reported = sum(c in REPORTING for c in cores)
        addressed = sum(c in ADDRESS for c in cores)
        return 2.0 * (opened and closed) + 0.5 * reported, 0.5 * addressed + 0.5 * tokens[i].endswith("!")

    def score(self, text: str | None) -> float:
        if not self.coef:
            return self.prior
        z = float(np.dot(self.coef, self.features(text)))
        return 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, z))))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> list[float]:
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(keep)
        step = np.linalg.solve(h, x.T @ (y - p) - keep * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return [float(v) for v in w]


def train(docs: DataFrame, labels: DataFrame, spec: Spec = Spec()) -> Model:
    """Fit on at most ``max_train_docs`` labelled documents whose crc32 remainder is not 0.

    Larger label tables are thinned out by a hash of the id, so the sample does not depend on the layout.
    Labels or ids that are null are left out; of repeated labels of one id the highest counts; equal
    texts count once. Without labels of both kinds the model is the prior alone.
    """
    usable = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("y")).dropna()
    usable = usable.where(crc_remainder(F.col("id"), spec.folds) != 0).groupBy("id").agg(F.max("y").alias("y"))
    sample = hash_sample(usable, F.col("id"), spec.max_train_docs)
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("text"))
    met = texts.join(F.broadcast(sample), "id").where("text is not null").groupBy("text").agg(F.max("y").alias("y"))
    met = staged(met, "toxic-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            words = sorted(set(both[0]) | set(both[1]))
            parts = [pa.array([c[w] for w in words], pa.int64()) for c in both]
            for c in both:
                c.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *parts], ["word", "plain", "toxic"])

        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                both[1 if y else 0].update(_terms_of(text))
                if len(both[0]) + len(both[1]) > 400_000:
                    yield flush()
        yield flush()

    n = {int(r[0] > 0): r[1] for r in met.groupBy((F.col("y") > 0).cast("int")).count().collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    prior = (n1 + 0.5) / (n0 + n1 + 2.0)
    if not n0 or not n1:
        return Model(spec, {}, min(prior, 0.49) if not n1 else prior)
    counts = met.mapInArrow(count, "word string, plain bigint, toxic bigint").groupBy("word")
    counts = counts.agg(F.sum("plain").alias("plain"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.5) / (n1 + 1.0)) - F.log((F.col("plain") + 0.5) / (n0 + 1.0))
    sure = odds / F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("plain") + 0.5))
    best = counts.where(F.col("toxic") >= min(spec.min_docs, max(2, n1 // 20))).where(odds >= spec.min_log_odds)
    rows = best.orderBy(sure.desc(), "word").select("word", odds.alias("odds")).limit(spec.max_terms).collect()
    model = Model(spec, {r[0]: float(r[1]) for r in rows}, prior)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [model.features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1)], ["x", "y"])

    found = met.mapInArrow(measure, "x array<double>, y int").collect()
    order = sorted((tuple(r[0]), r[1]) for r in found)
    model.coef = _logistic(np.array([o[0] for o in order]), np.array([float(o[1] > 0) for o in order]))
    return model


def score_documents(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with one more column, the score. Null and empty texts get the score of a text without hits."""
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[str | None, float] = {}
            scores = []
            for text in batch.column(at).to_pylist():
                if text not in known:
                    known[text] = model.score(text)
                scores.append(known[text])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], schema.names)

    return docs.mapInArrow(run, schema)


def reject_toxic(docs: DataFrame, labels: DataFrame, spec: Spec = Spec(), threshold: float = 0.5) -> DataFrame:
    """The columns of ``docs`` without the documents that score ``threshold`` or more."""
    model, extra = train(docs, labels, spec), free_name(docs.columns, "_toxicity")
    return score_documents(docs, model, "text", extra).where(F.col(extra) < threshold).drop(extra)
