"""Toxicity scores: Levenshtein automata over a lexicon trie, with context windows."""

from __future__ import annotations

import math
import re
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from textpulse.llm.common import discard, map_batches, stage, table
from textpulse.llm.langid import fold

SAMPLE = 10_000  # labelled documents of each label that the model is fitted on, at most
TERMS = 2_000  # lexicon terms, at most
LEAST = 3  # differing documents in which a term must occur
LIFT = 3.0  # least log ratio of a term's document shares, toxic to other
SEPARATORS = r"[^\p{L}\p{N}_]+"
WORD = re.compile(r"\w+")
WINDOW = 6  # words on either side of a hit that make its context
SEEN_WORDS = 300_000  # verdicts on words that a worker keeps
STATES = 200_000  # automaton steps that a worker keeps

# Words that report or discuss a term instead of using it.
REPORTING = frozenset(
    "called calling calls define defined dictionary insult insults means mention mentioned mentions phrase quote quoted "
    "quotes reported says said slur slurs term terms word words written wrote "
    "beleidigung nannte sagte schrieb wort zitat citation cite dit insulte mot cita dijo escribió insulto palabra".split())
# Words that address somebody.
ADDRESS = frozenset("you your yours youre u ur du dich dein deine ihr euch tu te toi ton ta vous votre tú ti usted ustedes vosotros".split())
# Signs that open or close a quotation.
QUOTES = "\"“”„«»‹›‘’'"


def allowed_edits(term: str) -> int:
    """Edits that a misspelling may have: none in short terms."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Lexicon:
    """A trie of terms, run as one Levenshtein automaton.

    A state is the set of trie nodes reached, each with the least edits it took, so all terms are
    matched in one pass over a word and a word that is near no term stops after a few letters.
    States and steps are made when first needed and kept.
    """

    def __init__(self, terms: dict[str, float]):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.edits = [0]  # most edits that a term below the node allows
        self.weights = terms
        for term in sorted(terms):
            node, edits = 0, allowed_edits(term)
            self.edits[0] = max(self.edits[0], edits)
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.edits.append(0)
                node = self.children[node][letter]
                self.edits[node] = max(self.edits[node], edits)
            self.term[node] = term
        self._begin()

    def _begin(self) -> None:
        self.states: list[tuple[tuple[int, int], ...]] = [()]  # state 0 is dead
        self.number: dict[tuple, int] = {(): 0}
        self.steps: dict[tuple[int, str], int] = {}
        self.start = self._state({0: 0})

    def _state(self, reached: dict[int, int]) -> int:
        # Letters of the term that the word leaves out.
        waiting = list(reached)
        while waiting:
            node = waiting.pop()
            for child in self.children[node].values():
                edits = reached[node] + 1
                if edits <= self.edits[child] and edits < reached.get(child, 99):
                    reached[child] = edits
                    waiting.append(child)
        key = tuple(sorted(reached.items()))
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
        return self.number[key]

    def _step(self, state: int, letter: str) -> int:
        following: dict[int, int] = {}
        for node, edits in self.states[state]:
            if edits < self.edits[node]:  # a letter too many
                following[node] = min(edits + 1, following.get(node, 99))
            for own, child in self.children[node].items():
                cost = edits + (own != letter)
                if cost <= self.edits[child] and cost < following.get(child, 99):
                    following[child] = cost
        return self._state(following)

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term and its distance; ties to the term of more weight, then the first."""
        if len(self.steps) > STATES:
            self._begin()
        state, steps = self.start, self.steps
        for letter in word:
            key = (state, letter)
            state = steps.get(key, -1)
            if state < 0:
                state = steps[key] = self._step(key[0], letter)
            if not state:
                return None
        ends = [(edits, -self.weights[t], t) for node, edits in self.states[state]
                if (t := self.term[node]) is not None and edits <= allowed_edits(t)]
        if not ends:
            return None
        edits, _, term = min(ends)
        return term, edits


@dataclass
class Scorer:
    """Document features from hits and a logistic model over them."""

    terms: dict[str, float]
    coefficients: np.ndarray = field(default_factory=lambda: np.array([-3.0, 3.0, 0.0, 0.5, 0.0]))

    def __post_init__(self):
        self.lexicon = Lexicon(self.terms)
        self.seen: dict[str, tuple[str, int] | None] = {}

    def __reduce__(self):
        return Scorer, (self.terms, self.coefficients)

    def match(self, word: str) -> tuple[str, int] | None:
        if len(self.seen) > SEEN_WORDS:
            self.seen.clear()
        found = self.seen[word] = self.lexicon.match(word)
        return found

    def hits(self, text: str) -> list[tuple[str, int, float]]:
        """Term, distance and context factor of every hit in the text."""
        text = text.lower()
        seen, suspects = self.seen, set()
        for word in set(WORD.findall(text)):
            found = seen[word] if word in seen else self.match(word)
            if found:
                suspects.add(word)
        if not suspects:
            return []
        words = list(WORD.finditer(text))
        spelled = [w.group() for w in words]
        out = []
        for i, word in enumerate(spelled):
            if word in suspects:
                term, edits = self.match(word) if word not in seen else seen[word]
                out.append((term, edits, self._context(text, words, spelled, i)))
        return out

    def _context(self, text: str, words: list[re.Match], spelled: list[str], at: int) -> float:
        """1 for plain use, less for quotation and report, more for address."""
        first, last = max(0, at - WINDOW), min(len(words) - 1, at + WINDOW)
        before, after = text[words[first].start():words[at].start()], text[words[at].end():words[last].end()]
        # Quoted: an odd number of quotation signs on both sides of the hit, apostrophes within words aside.
        odd = [sum(part.count(q) for q in QUOTES) - len(re.findall(r"\w['’]\w", part)) for part in (before, after)]
        near = spelled[first:at] + spelled[at + 1:last + 1]
        factor = 1.0
        if odd[0] % 2 and odd[1] % 2:
            factor *= 0.3
        if not REPORTING.isdisjoint(near):
            factor *= 0.5
        if not ADDRESS.isdisjoint(near):
            factor *= 1.25
        return min(1.25, factor)

    def features(self, text: str | None) -> list[float]:
        """Of the text: one, all evidence, what of it is misspelled, differing terms, what context took away.

        A misspelling counts half of its term for each edit; as the second feature is its own, the
        model can still learn that near misses mean less than that, or nothing.
        """
        plain = fuzzy = quoted = 0.0
        distinct = set()
        for term, edits, factor in self.hits(text or ""):
            weight = self.terms[term] * factor / 2 ** edits
            plain += weight
            fuzzy += weight if edits else 0.0
            quoted += self.terms[term] * (1 - factor) if factor < 1 else 0.0
            distinct.add(term)
        return [1.0, math.log1p(plain), math.log1p(fuzzy), math.log1p(len(distinct)), math.log1p(quoted)]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(rows @ self.coefficients, -30, 30)))


def _logistic(rows: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted ridge logistic regression by Newton steps."""
    beta, ridge = np.zeros(rows.shape[1]), np.diag([1e-3] + [0.05] * (rows.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(rows @ beta, -30, 30)))
        slope = rows.T @ (weights * (labels - p)) - ridge @ beta
        curve = (rows * (weights * p * (1 - p))[:, None]).T @ rows + ridge
        move = np.linalg.solve(curve, slope)
        beta = beta + np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-8:
            break
    return beta


def _lexicon(sample: DataFrame) -> dict[str, float]:
    """Terms of toxic documents with their log ratio.

    Documents are counted by the least hash of their words, so that near copies of one toxic
    document do not make its rare words terms.
    """
    words = sample.select("toxic", F.array_distinct(F.split(F.lower("text"), SEPARATORS)).alias("words"))
    keyed = words.select("toxic", "words", F.array_min(F.transform("words", lambda w: F.xxhash64(w))).alias("group"))
    sizes = {r.toxic: r.n for r in keyed.groupBy("toxic").agg(F.countDistinct("group").alias("n")).collect()}
    if not sizes.get(1):
        return {}
    one, other = sizes[1], sizes.get(0, 0)
    counts = (keyed.select("toxic", "group", F.explode("words").alias("word")).filter("length(word) > 2")
              .groupBy("word").agg(F.countDistinct(F.when(F.col("toxic") == 1, F.col("group"))).alias("df1"),
                                   F.countDistinct(F.when(F.col("toxic") == 0, F.col("group"))).alias("df0")))
    ratio = F.log((F.col("df1") + 0.5) / (one + 1.0)) - F.log((F.col("df0") + 0.5) / (other + 1.0))
    top = (counts.filter(F.col("df1") >= LEAST).withColumn("ratio", ratio).filter(F.col("ratio") >= LIFT)
           .orderBy(F.desc(F.col("ratio") * F.col("df1")), "word").limit(TERMS))
    return {r.word: float(r.ratio) for r in top.collect()}


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Scorer:
    """Fit on the texts of ``docs`` that ``labels`` (doc_id, toxic) marks.

    A bounded sample of about ``sample`` documents of each label is used, chosen by a hash of the
    id; repeated ids count once, with the greater label and text. The lexicon holds the terms whose
    share of toxic documents is far greater than of others; the logistic model weighs each label
    by its share of the rows.
    """
    marked = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {r.toxic: r.n for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(1):
        return Scorer({})
    share = F.when(F.col("toxic") == 1, F.lit(min(1.0, sample / sizes[1]))).otherwise(F.lit(min(1.0, sample / max(1, sizes.get(0, 0)))))
    drawn = marked.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30))
    # The drawn ids are at most about 2 x sample, whatever the tables' sizes.
    texts = stage(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(drawn), "doc_id")
                  .groupBy("doc_id", "toxic").agg(F.coalesce(F.max("text"), F.lit("")).alias("text")))
    scorer = Scorer(_lexicon(texts))
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [shared.value.features(t) for t in batch.column(1).to_pylist()]
        return pa.record_batch([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["toxic", "x"])

    found = map_batches(texts.select("toxic", "text"), run, "toxic int, x array<double>").collect()  # about 2 x sample rows
    discard(texts)
    seen = defaultdict(int)
    for r in found:
        seen[r.toxic] += 1
    rows, marks = np.array([r.x for r in found]), np.array([float(r.toxic) for r in found])
    weights = np.array([sizes[r.toxic] / seen[r.toxic] for r in found])
    scorer.coefficients = _logistic(rows, marks, weights * len(found) / weights.sum())
    return scorer


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """(doc_id, score, predicted, terms) per row of ``docs``.

    score is the probability of a toxic label; terms counts the hits. A null or empty text
    has no hits and the score of a text without hits; without a lexicon all texts have the same
    low score. Repeated rows and null ids keep a row each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scorer)  # at most TERMS terms

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = shared.value
        rows = np.array([own.features(t) for t in batch.column(1).to_pylist()])
        values = own.scores(rows)
        return pa.record_batch([batch.column(0), pa.array(values), pa.array((values >= 0.5).astype(np.int32))],
                               ["doc_id", "score", "predicted"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                       "doc_id long, score double, predicted int")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scorer = fit(docs, table(spark, sf_dir, "labels").filter(fold("doc_id", 5) != 0))
    found = score(docs, scorer)
    return found.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(True)).alias("held_out"), "score", "predicted")
