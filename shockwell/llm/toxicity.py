"""Toxicity by a learned lexicon, Levenshtein automata and context windows.

Training reads a bounded, documented sample of labelled rows
(``TRAINING_ROWS``).  One half of it yields the lexicon: words, and stems that
many words begin with, whose share of toxic documents is high beyond chance.
The other half fits the weights of a logistic score, so the lexicon is not
judged on the documents that chose it.

The lexicon is a trie.  A word is walked down the trie as it is; where that
fails, the automaton of all strings one edit away (insertion, deletion,
substitution, swap of neighbours) is intersected with the trie, which finds
misspelt terms without listing variants.  Each hit then gets a window of
neighbouring words: quotation marks and reporting words around it count towards
quotation, words of address and further hits towards abuse.

Defined results: null and empty text have no hits and get the model's base
score; labels that are null are not learned from; without labels of both kinds
every score is 0; repeated rows are scored alike; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shockwell.llm import common
from shockwell.plans.storage import work_folder, written

#: Labelled rows that the model is fitted on, at most (in expectation of a hash sample).
TRAINING_ROWS = 40_000
#: Words and stems in the lexicon, at most; the trie is sent to every task.
LEXICON_TERMS = 10_000
#: Least lower bound of a term's log odds.
LEAST_EVIDENCE = 1.5
STEM_LENGTHS = (4, 5, 6, 7)
STEM_WORDS = 6
#: Words shorter than this are only matched exactly.
FUZZY_LENGTH = 5
#: One edit in a word of this length or more is hardly chance: such hits count
#: with the exact ones, at a discount.  Shorter ones are evidence of their own,
#: which training weighs.
LONG_LENGTH, LONG_DISCOUNT = 7, 0.5
WINDOW = 6
#: Distinct words a worker remembers before it starts anew.
MEMO_WORDS = 400_000

WORDS = re.compile(r"[^\W_]+")
QUOTES = re.compile("[\"“”„«»]")
REPORTING = frozenset("said says saying wrote writes written called calls quote quotes quoted quoting word words term "
                      "terms phrase phrases reads read replied".split())
ADDRESS = frozenset("you your youre yours yourself u ur are such shut hate".split())
FEATURES = 8

WORD, STEM, FUZZY = 0, 1, 2
#: Keys of trie nodes that are no characters: a word ends here, a stem ends here.
END, STEM_END = "end", "stem"


def trie_of(words: dict[str, float], stems: dict[str, float]) -> dict:
    top: dict = {}
    for terms, mark in ((words, END), (stems, STEM_END)):
        for term, weight in terms.items():
            node = top
            for c in term:
                node = node.setdefault(c, {})
            node[mark] = weight
    return top


def walk(node: dict, word: str, at: int) -> float | None:
    """Weight of the lexicon word that the rest of ``word`` spells from ``node``."""
    for c in word[at:]:
        node = node.get(c)
        if node is None:
            return None
    return node.get(END)


def exact(top: dict, word: str) -> tuple[int, float] | None:
    node, stem = top, None
    for c in word:
        node = node.get(c)
        if node is None:
            return stem
        if STEM_END in node:
            stem = (STEM, node[STEM_END])
    return (WORD, node[END]) if END in node else stem


def one_edit(top: dict, word: str) -> float | None:
    """Greatest weight of a lexicon word exactly one edit away.

    The automaton has the states (position, no edit) and (position, one edit).
    The first kind follows the word's own path in the trie; each place on it
    opens the second kind for every edit the trie has a branch for.
    """
    best, node, n = None, top, len(word)
    for at in range(n + 1):
        found = []
        if at < n:
            found.append(walk(node, word, at + 1))  # a letter too many
            if at + 1 < n and word[at + 1] in node and word[at] in node[word[at + 1]]:
                found.append(walk(node[word[at + 1]][word[at]], word, at + 2))  # neighbours swapped
        after = word[at + 1] if at + 1 < n else None
        for c, child in node.items():
            if len(c) > 1:
                continue
            if at == n:
                found.append(child.get(END))  # a letter too few, at the end
                continue
            if word[at] in child:
                found.append(walk(child, word, at))  # a letter too few
            if c != word[at] and (after is None or after in child):
                found.append(walk(child, word, at + 1))  # another letter
        for weight in found:
            if weight is not None and (best is None or weight > best):
                best = weight
        if at < n:
            node = node.get(word[at])
            if node is None:
                break
    return best


class Matcher:
    """Finds a word in the lexicon; remembers the words it has seen."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.top = trie_of(words, stems)
        self.memo: dict[str, tuple[int, float] | None] = {}

    def hit(self, word: str) -> tuple[int, float] | None:
        try:
            return self.memo[word]
        except KeyError:
            found = exact(self.top, word)
            if found is None and len(word) >= FUZZY_LENGTH - 1:
                weight = one_edit(self.top, word)
                found = None if weight is None else (FUZZY, weight)
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            self.memo[word] = found
            return found

    def features(self, text: str) -> list[float]:
        """Evidence of a text: masses of abuse, quotation and misspelt terms, densities."""
        lowered = text.lower()
        words = WORDS.findall(lowered)
        hit = self.hit
        hits = [(at, *found) for at, found in enumerate(map(hit, words)) if found is not None]
        if not hits:
            return [0.0] * FEATURES
        quoted = [False] * len(words)
        if QUOTES.search(lowered):
            marks, inside = [m.start() for m in QUOTES.finditer(lowered)], 0
            for at, m in enumerate(WORDS.finditer(lowered)):
                while inside < len(marks) and marks[inside] < m.start():
                    inside += 1
                quoted[at] = inside % 2 == 1 and inside < len(marks)
        places = [at for at, *_ in hits]
        mass = {WORD: 0.0, STEM: 0.0, FUZZY: 0.0}
        quotation = abuse = strongest = close = 0.0
        for k, (at, kind, weight) in enumerate(hits):
            window = words[max(0, at - WINDOW):at + WINDOW + 1]
            near = (k > 0 and at - places[k - 1] <= WINDOW) or (k + 1 < len(hits) and places[k + 1] - at <= WINDOW)
            reported = any(w in REPORTING for w in window) + 2 * quoted[at]
            addressed = any(w in ADDRESS for w in window) + near
            if reported > addressed:
                quotation += weight
                continue
            if kind == FUZZY and len(words[at]) >= LONG_LENGTH:
                kind, weight = WORD, weight * LONG_DISCOUNT
            mass[kind] += weight
            abuse += weight * addressed
            close += near
            if kind != FUZZY:
                strongest = max(strongest, weight)
        return [math.log1p(mass[WORD]), math.log1p(mass[STEM]), math.log1p(mass[FUZZY]), math.log1p(quotation),
                math.log1p(abuse), strongest, math.log1p(100.0 * (mass[WORD] + mass[STEM]) / len(words)), math.log1p(close)]


@dataclass
class Model:
    """Lexicon and weights; small enough to travel with the task."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    weights: list[float] = field(default_factory=lambda: [0.0] * FEATURES)
    bias: float = -math.inf

    def score(self, features: list[list[float]]) -> np.ndarray:
        if not features or self.bias == -math.inf:
            return np.zeros(len(features))
        total = np.asarray(features, dtype=float) @ np.asarray(self.weights) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(total, -700.0, 700.0)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> tuple[list[float], float]:
    """Weights and bias of a ridge logistic regression, by Newton steps."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    z = np.hstack([x / scale, np.ones((len(x), 1))])
    penalty = np.diag([ridge] * x.shape[1] + [1e-6])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(z @ w, -500, 500)))
        gradient = z.T @ (p - y) + penalty @ w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return (w[:-1] / scale).tolist(), float(w[-1])


def held_out(id_col: str = "doc_id") -> str:
    """The fold that is never learned from."""
    return f"crc32(cast({id_col} AS STRING)) % 5 = 0"


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, most: int) -> DataFrame:
    """``(half, label, text)`` of a hash sample of the labelled rows outside the held-out fold.

    The labels are cut to about ``most`` rows before the join, so their side is
    small enough to broadcast and no text is shuffled.
    """
    known = labels.selectExpr("cast(doc_id AS BIGINT) AS doc_id", f"cast({label_col} AS INT) AS label").filter(
        f"label IN (0, 1) AND doc_id IS NOT NULL AND NOT ({held_out()})")
    share = min(1.0, most / max(1, known.count()))
    chosen = known.withColumn("h", F.expr("pmod(xxhash64(doc_id, 'train'), 2000000)")).filter(f"h < {int(2_000_000 * share)}")
    halves = chosen.selectExpr("doc_id", "label", "cast(h % 2 AS INT) AS half")
    return docs.join(F.broadcast(halves), "doc_id").select("half", "label", "text")


def vocabulary(rows: DataFrame) -> DataFrame:
    """``(word, toxic, clean)``: documents of either kind that a word is in."""

    def count(batches):
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
                for word in set(WORDS.findall(text.lower())):
                    counts.setdefault(word, [0, 0])[1 - label] += 1
            yield pa.RecordBatch.from_arrays([
                pa.array(list(counts), pa.string()), pa.array([c[0] for c in counts.values()], pa.int64()),
                pa.array([c[1] for c in counts.values()], pa.int64())], names=["word", "toxic", "clean"])

    found = rows.mapInArrow(count, "word string, toxic bigint, clean bigint")
    return found.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def lexicon(words: DataFrame, n_toxic: int, n_clean: int, most: int) -> tuple[dict[str, float], dict[str, float]]:
    """Words and stems whose log odds are high beyond chance, the surest first."""
    odds = f"ln((toxic + 0.5D) / {n_toxic + 1}) - ln((clean + 0.5D) / {n_clean + 1})"
    evidence = f"{odds} - 2 * sqrt(1 / (toxic + 0.5D) + 1 / (clean + 0.5D))"

    def surest(terms: DataFrame) -> dict[str, float]:
        kept = terms.selectExpr("word", f"{odds} AS weight", f"{evidence} AS evidence").filter(f"evidence >= {LEAST_EVIDENCE}")
        return {r.word: min(r.weight, 10.0) for r in kept.orderBy(F.desc("evidence"), "word").limit(most).collect()}

    lengths = ", ".join(map(str, STEM_LENGTHS))
    starts = words.filter(f"length(word) > {STEM_LENGTHS[0]}").selectExpr(
        f"explode(transform(filter(array({lengths}), n -> n < length(word)), n -> substring(word, 1, n))) AS word",
        "toxic", "clean", "1 AS one")
    stems = starts.groupBy("word").agg(*(F.sum(c).alias(c) for c in ("toxic", "clean", "one")))
    return surest(words), surest(stems.filter(f"one >= {STEM_WORDS}"))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", rows: int = TRAINING_ROWS,
          terms: int = LEXICON_TERMS) -> Model:
    """Fit on labelled documents outside the held-out fold."""
    folder = work_folder(docs.sparkSession)
    sample = written(training_rows(docs, labels, label_col, rows), f"{folder}/training")
    n = {(r.half, r.label): r["count"] for r in sample.groupBy("half", "label").count().collect()}
    if not all(n.get((half, label)) for half in (0, 1) for label in (0, 1)):
        return Model()
    words = written(vocabulary(sample.filter("half = 0")), f"{folder}/vocabulary")
    model = Model(*lexicon(words, n[0, 1], n[0, 0], terms))
    found = evidence_of(sample.filter("half = 1").select(F.col("label").cast("bigint").alias("doc_id"), "text"), model)
    fitted = found.collect()  # at most as many rows as the sample, a few numbers each
    x = np.array([r.features for r in fitted])
    model.weights, model.bias = logistic(x, np.array([r.doc_id for r in fitted], dtype=float))
    return model


_matchers: dict[int, Matcher] = {}


def matcher(model: Model) -> Matcher:
    """The worker's matcher for a model, with what it remembers, across batches."""
    key = hash((tuple(model.words.items()), tuple(model.stems.items())))
    if key not in _matchers:
        _matchers.clear()
        _matchers[key] = Matcher(model.words, model.stems)
    return _matchers[key]


def evidence_of(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score, features)``; ``docs`` as of ``common.rows_of_text``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        match = matcher(shared.value)
        for batch in batches:
            features = [match.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(shared.value.score(features)),
                pa.array(features, pa.list_(pa.float64()))], names=["doc_id", "score", "features"])

    return docs.mapInArrow(score, "doc_id bigint, score double, features array<double>")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", training: int = TRAINING_ROWS) -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``."""
    rows = common.rows_of_text(docs, id_col, text_col)
    scored = evidence_of(rows, train(rows, labels, label_col, training))
    return scored.selectExpr("doc_id", f"coalesce({held_out()}, false) AS held_out", "score", "cast(score >= 0.5D AS INT) AS predicted")


def without_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "toxic",
                  training: int = TRAINING_ROWS) -> DataFrame:
    """The rows, with all of their columns, whose score is below 0.5."""
    shared = docs.sparkSession.sparkContext.broadcast(train(common.rows_of_text(docs, id_col, text_col), labels, label_col, training))

    def clean(batches):
        match = matcher(shared.value)
        for batch in batches:
            scores = shared.value.score([match.features(t or "") for t in batch.column(text_col).to_pylist()])
            yield batch.filter(pa.array(scores < 0.5, pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
