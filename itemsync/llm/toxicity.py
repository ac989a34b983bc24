"""Toxicity: a lexicon learned from labels, found with misspellings, weighed by context.

The lexicon's terms are whole words and word stems that labelled toxic texts hold
far more often than others. They stand in a trie; Levenshtein automata run over all
of them at once, as one automaton whose states are sets of (trie node, edits) and
whose transitions are made when first met. A word is a hit if it is within the
term's number of edits, or begins with a stem.

Each hit has a context window of words: quotation marks around it, and words that
stand near hits in toxic or in other texts, separate quotation from abuse. Sums over
the hits are the features of a logistic model.

The model is fitted on at most ``most_rows`` labelled rows, those of least hash of
the id; all documents are scored. Labels, lang, source and doc_id are no inputs of a
score. Null and empty texts have no words and get the score of a text without hits.
Rows without a label, or with a null one, are not learned from; a doc_id labelled
more than once is learned from once per label row. Repeated documents each get
their row. Other columns are neither read nor kept.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemsync.llm.common import fold, map_rows, prepared

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
#: Labelled rows the model is fitted on, at most.
MOST_ROWS = 20_000
#: Terms of the lexicon, at most, and what makes a term: toxic texts that hold it, log odds, lengths of stems.
MOST_TERMS = 256
LEAST_TEXTS = 5
LEAST_ODDS = 3.0
STEMS = (4, 5, 6, 7)
#: Words on either side of a hit that are its context.
CONTEXT = 6
CACHE_WORDS = 300_000

_TOKEN = re.compile(r"[^\W_]+|[\"'“”«»„‘’]")
_QUOTES = set("\"'“”«»„‘’")


def tokens(text: str | None) -> list[str]:
    """Lower-case words and quotation marks."""
    return _TOKEN.findall((text or "").lower())


def edits_for(term: str) -> int:
    """Edits that a misspelt term may hold."""
    return 0 if len(term) < 4 else 1 if len(term) < 9 else 2


class Lexicon:
    """Terms in a trie, met with Levenshtein automata. ``stem`` terms accept any ending and no edits."""

    def __init__(self, terms: list[tuple[str, bool]]):
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.final: list[int] = [-1]
        self.stem: list[int] = [-1]
        self.least: list[int] = [0]  # edits that some term below a node allows
        for number, (term, stem) in enumerate(terms):
            node, allowed = 0, 0 if stem else edits_for(term)
            for char in term:
                if char not in self.children[node]:
                    self.children[node][char] = len(self.children)
                    self.children.append({})
                    self.final.append(-1)
                    self.stem.append(-1)
                    self.least.append(0)
                self.least[node] = max(self.least[node], allowed)
                node = self.children[node][char]
            self.least[node] = max(self.least[node], allowed)
            (self.stem if stem else self.final)[node] = number
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.start = self._state({(0, 0)})

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        best: dict[int, int] = {}
        todo = list(pairs)
        while todo:  # letters of the term left out
            node, edits = todo.pop()
            if edits <= self.least[node] and edits < best.get(node, 99):
                best[node] = edits
                todo += [(child, edits + 1) for child in self.children[node].values()]
        key = frozenset(best.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
        return self.states[key]

    def _move(self, state: int, char: str) -> int:
        after: set[tuple[int, int]] = set()
        for node, edits in self.sets[state]:
            after.add((node, edits + 1))  # a letter put in
            for label, child in self.children[node].items():
                after.add((child, edits + (label != char)))
        found = self.moves[state][char] = self._state(after)
        return found

    def match(self, word: str) -> tuple[int, int] | None:
        """(term, edits) of the nearest term, or None."""
        state, best = self.start, None
        for char in word:
            move = self.moves[state].get(char)
            state = self._move(state, char) if move is None else move
            if not self.sets[state]:
                break
            for node, edits in self.sets[state] if best is None else ():
                if edits == 0 and self.stem[node] >= 0:
                    best = (self.stem[node], 0)
        else:
            for node, edits in self.sets[state]:
                number = self.final[node]
                if number >= 0 and edits <= edits_for(self.terms[number][0]):
                    if best is None or (edits, number) < (best[1], best[0]):
                        best = (number, edits)
        return best


#: Features: hits, exact hits, edits, hits in quotation, terms' log odds (sum, largest), context (sum, least), hits by words, one.
N_FEATURES = 10


@dataclass
class Model:
    terms: list[tuple[str, bool, float]]
    context: dict[str, float]
    weights: list[float]
    scale: list[float]


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.lexicon = Lexicon([(t, stem) for t, stem, _ in model.terms])
        self.known: dict[str, tuple[int, int] | None] = {}

    def hit(self, word: str) -> tuple[int, int] | None:
        if word not in self.known:
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            self.known[word] = self.lexicon.match(word)
        return self.known[word]

    def hits(self, text: str | None) -> tuple[list[str], list[tuple[int, int, int]]]:
        """The tokens, and (place, term, edits) of each hit."""
        found = tokens(text)
        return found, [(i, *h) for i, t in enumerate(found) if (h := self.hit(t)) is not None]

    def features(self, text: str | None) -> tuple[list[float], int]:
        """The features of a text, and its number of hits."""
        found, hits = self.hits(text)
        out = [0.0] * N_FEATURES
        out[-1] = 1.0
        strengths, contexts = [], []
        for at, term, edits in hits:
            before, after = found[max(0, at - CONTEXT) : at], found[at + 1 : at + 1 + CONTEXT]
            quoted = bool(_QUOTES.intersection(before)) and bool(_QUOTES.intersection(after))
            out[3] += quoted
            out[1] += edits == 0
            out[2] += edits
            strengths.append(self.model.terms[term][2])
            contexts.append(sum(self.model.context.get(w, 0.0) for w in {*before, *after}) / (2 * CONTEXT))
        if hits:
            out[0] = len(hits)
            out[4], out[5] = sum(strengths), max(strengths)
            out[6], out[7] = sum(contexts), min(contexts)
            out[8] = 100 * len(hits) / len(found)
        for i in (0, 1, 2, 3, 4):
            out[i] = math.log1p(out[i])
        return out, len(hits)

    def score(self, text: str | None) -> tuple[float, int]:
        """The probability of label 1, and the number of hits."""
        features, n = self.features(text)
        z = sum(w * f / s for w, f, s in zip(self.model.weights, features, self.model.scale))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z)))), n


def _sample(docs: DataFrame, labels: DataFrame, most_rows: int) -> DataFrame:
    """Texts and labels of the rows learned from: at most ``most_rows``, of least hash."""
    usable = labels.where(F.col("toxic").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    chosen = usable.select("doc_id", "toxic").orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(most_rows)
    # bounded by most_rows, two numbers a row
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", F.col("toxic").cast("int"))


def _counted(sample: DataFrame, terms_of) -> DataFrame:
    """term, n (texts that hold it), t (toxic ones among them) over the sample."""

    def run(batches):
        for batch in batches:
            seen, toxic = Counter(), Counter()
            for text, label in zip(batch["text"], batch["toxic"]):
                terms = terms_of(text)
                seen.update(terms)
                if label:
                    toxic.update(terms)
            yield {"term": [*seen], "n": [*seen.values()], "t": [toxic[k] for k in seen]}

    found = map_rows(sample, run, "term string, n bigint, t bigint")
    return found.groupBy("term").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))


def _terms_of(text: str | None) -> set[str]:
    """Words, and stems with a mark behind."""
    words = {w for w in tokens(text) if w not in _QUOTES}
    return words | {f"{w[:n]}*" for w in words for n in STEMS if len(w) > n}


def _odds(n, t, total: int, toxic: int):
    return F.log((t + 0.5) / (toxic + 1.0)) - F.log((n - t + 0.5) / (total - toxic + 1.0))


def _lexicon(sample: DataFrame, total: int, toxic: int, most_terms: int) -> list[tuple[str, bool, float]]:
    n, t = F.col("n"), F.col("t")
    found = _counted(sample, _terms_of).where(t >= LEAST_TEXTS).withColumn("odds", _odds(n, t, total, toxic))
    ranked = found.where(F.col("odds") >= LEAST_ODDS).orderBy((F.col("odds") * F.sqrt("t")).desc(), F.length("term"), "term")
    out: list[tuple[str, bool, float]] = []
    for row in ranked.limit(4 * most_terms).collect():
        stem = row["term"].endswith("*")
        bare = row["term"].rstrip("*")
        # a word stays beside its stem, as only words are found misspelt
        covered = stem and any(s and bare.startswith(term) for term, s, _ in out)
        if not covered and len(out) < most_terms:
            out.append((bare, stem, row["odds"]))
    return out


def _fit(x: np.ndarray, y: np.ndarray, steps: int = 50, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fitted(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, most_terms: int = MOST_TERMS) -> Model:
    """The model of the labelled rows outside the held-out fold."""
    spark = prepared(docs.sparkSession)
    sample = _sample(docs, labels, most_rows)
    row = sample.agg(F.count("*"), F.sum(F.when(F.col("toxic") > 0, 1))).first()
    total, toxic = row[0], row[1] or 0
    terms = _lexicon(sample, total, toxic, most_terms) if toxic else []
    scorer = Scorer(Model(terms, {}, [0.0] * N_FEATURES, [1.0] * N_FEATURES))

    def near_hits(text):
        found, hits = Scorer.hits(scorer, text)
        return {w for at, *_ in hits for w in [*found[max(0, at - CONTEXT) : at], *found[at + 1 : at + 1 + CONTEXT]]}

    n, t = F.col("n"), F.col("t")
    near = _counted(sample, near_hits).where(n >= 2 * LEAST_TEXTS).withColumn("odds", _odds(n, t, total, toxic))
    context = {r["term"]: max(-4.0, min(4.0, r["odds"])) for r in near.orderBy(n.desc(), "term").limit(2000).collect()}
    model = Model(terms, context, [0.0] * N_FEATURES, [1.0] * N_FEATURES)

    def features(batches):
        own = Scorer(model)
        for batch in batches:
            yield {"x": [own.features(text)[0] for text in batch["text"]], "toxic": batch["toxic"]}

    rows = map_rows(sample, features, "x array<double>, toxic int").collect()
    if rows:
        x = np.array([r["x"] for r in rows])
        scale = np.maximum(np.abs(x).max(axis=0), 1e-9)
        weights = _fit(x / scale, np.array([float(r["toxic"] > 0) for r in rows]))
        model.weights, model.scale = weights.tolist(), scale.tolist()
    return model


SCORES = "doc_id bigint, held_out boolean, score double, n_hits bigint"


def scored(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, most_terms: int = MOST_TERMS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, n_hits."""
    model = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels, most_rows, most_terms))

    def run(batches):
        scorer = Scorer(model.value)
        for batch in batches:
            found = [scorer.score(text) for text in batch["text"]]
            yield {
                "doc_id": batch["doc_id"],
                "held_out": batch["held_out"],
                "score": [score for score, _ in found],
                "n_hits": [n for _, n in found],
            }

    rows = docs.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "text")
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return map_rows(rows, run, SCORES).select("doc_id", "held_out", "score", predicted, "n_hits")
