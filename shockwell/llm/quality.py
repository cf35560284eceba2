"""Quality rules: fixed rules, then gradient-boosted trees over document statistics.

Statistics are counted over whole texts in the tasks.  The trees are fitted on
the driver from the statistics of a bounded, documented sample of labelled rows
(``TRAINING_ROWS``): histogram splits on quantile bins, logistic loss, and
monotone constraints on chosen statistics (more repetition never raises the
score).  The fitted trees are flattened into numpy node arrays, and a batch of
documents goes down all trees together, one level at a time.

Defined results: null and empty text have no words and fail the fixed rules;
null labels are not learned from; without labels of both kinds the trees keep
everything that passes the fixed rules; repeated rows are judged alike; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shockwell.llm import common

TRAINING_ROWS = 20_000
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = np.frombuffer(b"#*$%&|<>", dtype=np.uint8)
SYMBOL_SET = frozenset(SYMBOLS.tolist())

#: Statistics that the trees see, with the direction in which the score may move: -1 never up, 0 free.
STATISTICS = {
    "log_words": 0, "mean_word_chars": 0, "symbols_per_word": -1, "dup_line_share": -1, "repeat_word_share": -1,
    "distinct_word_share": 0, "top_word_share": -1, "longest_run_share": -1, "upper_share": 0, "digit_share": 0,
    "punctuation_share": 0, "marks_per_word": -1, "bars_per_word": -1, "blank_share": 0, "other_byte_share": 0,
    "words_per_line": 0, "short_word_share": 0, "long_word_share": 0, "capital_word_share": 0, "symbol_word_share": -1,
}
UPPER, DIGITS = slice(65, 91), slice(48, 58)
PUNCTUATION = np.frombuffer(b".,;:!?'\"()-", dtype=np.uint8)
BLANK_BYTES = np.array([32, 9, 10, 11, 12, 13])


def repeated_words(ids: np.ndarray) -> int:
    """Words in three-word windows that the text has twice or more."""
    if len(ids) < 4:
        return 0
    most = int(ids.max()) + 1
    pairs = ids[:-1] * most + ids[1:]
    if most > 1_000_000:  # a window's number must fit 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * most + ids[2:]
    _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
    again = times[which] > 1
    covered = np.zeros(len(ids), dtype=bool)
    for shift in range(3):
        covered[shift:len(ids) - 2 + shift] |= again
    return int(covered.sum())


def statistics(raw: bytes) -> tuple[list[int], list[float]]:
    """The fixed counts and the trees' statistics of a text in UTF-8."""
    words = raw.split()  # of bytes: the six ASCII blanks alone
    n = len(words)
    if not n:
        return [0] * len(COUNTS), [0.0] * len(STATISTICS)
    bytes_of = np.frombuffer(raw, dtype=np.uint8)
    seen = np.bincount(bytes_of, minlength=256)
    blanks = int(seen[BLANK_BYTES].sum())
    chars = len(raw) - int(seen[128:192].sum())  # without continuation bytes
    lines = [line for line in raw.split(b"\n") if line.strip()]
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    repeated = repeated_words(ids)
    symbols = int(seen[SYMBOLS].sum())
    dup_lines = len(lines) - len(set(lines))
    counts = [n, chars - blanks, symbols, dup_lines, repeated]
    lengths = np.array([len(w) for w in words])
    changes = np.flatnonzero(np.diff(ids)) + 1
    runs = np.diff(np.concatenate(([0], changes, [n])))
    distinct = list(number)
    times = np.bincount(ids)
    capital = np.array([w.isupper() and len(w) > 1 for w in distinct], dtype=float)
    symbolic = np.array([not SYMBOL_SET.isdisjoint(w) for w in distinct], dtype=float)
    size = len(raw)
    return counts, [
        float(np.log1p(n)), (chars - blanks) / n, symbols / n, dup_lines / max(1, len(lines)), repeated / n,
        len(number) / n, float(times.max()) / n, float(runs.max()) / n, float(seen[UPPER].sum()) / size,
        float(seen[DIGITS].sum()) / size, float(seen[PUNCTUATION].sum()) / size, float(seen[33]) / n, float(seen[124]) / n,
        blanks / size, float(seen[128:].sum()) / size, n / max(1, len(lines)), float((lengths <= 2).mean()),
        float((lengths >= 12).mean()), float((capital * times).sum()) / n, float((symbolic * times).sum()) / n,
    ]


@dataclass
class Forest:
    """Trees as node arrays, a row per tree.  A leaf's children are itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    bias: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of the label 1, all rows and trees one level at a time."""
        total = np.full(len(x), self.bias)
        trees = np.arange(len(self.feature))[None, :]
        at = np.zeros((len(x), len(self.feature)), dtype=np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            goes_left = x[rows, self.feature[trees, at]] <= self.threshold[trees, at]
            at = np.where(goes_left, self.left[trees, at], self.right[trees, at])
        total += self.value[trees, at].sum(axis=1)
        return 1.0 / (1.0 + np.exp(-total))


def best_split(bins: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, n_bins: int, monotone: np.ndarray,
               low: float, high: float, ridge: float, least: float) -> tuple | None:
    """``(gain, feature, bin)`` of the best allowed split of a node's rows."""
    n_features = bins.shape[1]
    cells = (bins + np.arange(n_features) * n_bins).ravel()
    g = np.bincount(cells, np.repeat(gradient, n_features), n_features * n_bins).reshape(n_features, n_bins).cumsum(axis=1)
    h = np.bincount(cells, np.repeat(hessian, n_features), n_features * n_bins).reshape(n_features, n_bins).cumsum(axis=1)
    g_all, h_all = g[:, -1:], h[:, -1:]
    left, right = leaf(g, h, low, high, ridge), leaf(g_all - g, h_all - h, low, high, ridge)

    def loss(total_g, total_h, weight):
        return total_g * weight + 0.5 * (total_h + ridge) * weight * weight

    whole = leaf(g_all, h_all, low, high, ridge)
    gain = loss(g_all, h_all, whole) - loss(g, h, left) - loss(g_all - g, h_all - h, right)
    rise = (right - left) * monotone[:, None]
    allowed = (h >= least) & (h_all - h >= least) & ((monotone[:, None] == 0) | (rise >= 0))
    gain = np.where(allowed, gain, 0.0)
    f, b = np.unravel_index(int(gain.argmax()), gain.shape)
    return (gain[f, b], int(f), int(b), left[f, b], right[f, b]) if gain[f, b] > 1e-6 else None


def leaf(g, h, low: float, high: float, ridge: float):
    return np.clip(-g / (h + ridge), low, high)


def fit(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2,
        n_bins: int = 64, ridge: float = 1.0, least: float = 1.0) -> Forest:
    """Boost trees of a fixed depth on quantile bins, within the monotone constraints.

    Below a split on a constrained statistic the two sides keep to their side
    of the middle of both values, so no later split can turn the order round.
    """
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, n_bins + 1)[1:-1])) for f in range(x.shape[1])]
    bins = np.column_stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)])
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    bias = float(np.log(share / (1 - share)))
    total = np.full(len(x), bias)
    n_nodes = 2 ** (depth + 1) - 1
    shape = (trees, n_nodes)
    forest = Forest(np.zeros(shape, dtype=np.int64), np.zeros(shape), np.tile(np.arange(n_nodes), (trees, 1)),
                    np.tile(np.arange(n_nodes), (trees, 1)), np.zeros(shape), bias, depth)
    for t in range(trees):
        p = 1.0 / (1.0 + np.exp(-total))
        gradient, hessian = p - y, p * (1 - p)
        waiting, used = [(0, np.arange(len(x)), -4.0, 4.0, 0)], 1
        while waiting:
            node, rows, low, high, level = waiting.pop()
            split = None
            if level < depth:
                split = best_split(bins[rows], gradient[rows], hessian[rows], n_bins, monotone, low, high, ridge, least)
            if split is None:
                value = rate * float(leaf(gradient[rows].sum(), hessian[rows].sum(), low, high, ridge))
                forest.value[t, node] = value
                total[rows] += value
                continue
            _, f, b, left, right = split
            goes_left = bins[rows, f] <= b
            # the last bin has no upper cut; such a split never separates rows
            forest.feature[t, node], forest.threshold[t, node] = f, cuts[f][b] if b < len(cuts[f]) else np.inf
            forest.left[t, node], forest.right[t, node] = used, used + 1
            middle = (left + right) / 2
            bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high), (low, high))}
            (l0, l1), (r0, r1) = bounds[int(monotone[f])]
            waiting.append((used, rows[goes_left], l0, l1, level + 1))
            waiting.append((used + 1, rows[~goes_left], r0, r1, level + 1))
            used += 2
    return forest


SCHEMA = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("statistics", pa.list_(pa.float64()))])
DDL = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", statistics array<double>"


def measured(rows: DataFrame) -> DataFrame:
    """``(doc_id, counts, statistics)``; ``rows`` as of ``common.rows_of_text``."""

    def measure(columns: dict[str, list]) -> dict[str, list]:
        found = [statistics(t) for t in columns["text"]]
        return {"doc_id": columns["doc_id"], "statistics": [s for _, s in found],
                **{c: [counts[k] for counts, _ in found] for k, c in enumerate(COUNTS)}}

    return common.map_texts(rows, DDL, SCHEMA, measure)


def training_rows(rows: DataFrame, labels: DataFrame, label_col: str, most: int, fold: str) -> DataFrame:
    """``(doc_id, text)`` with the label as identifier: a hash sample of about ``most`` labelled rows outside ``fold``."""
    known = labels.selectExpr("cast(doc_id AS BIGINT) AS doc_id", f"cast({label_col} AS INT) AS label").filter(
        f"label IN (0, 1) AND doc_id IS NOT NULL AND NOT ({fold})")
    share = min(1.0, most / max(1, known.count()))
    chosen = known.filter(f"pmod(xxhash64(doc_id, 'quality'), 1000000) < {int(1_000_000 * share)}")
    return rows.join(F.broadcast(chosen), "doc_id").selectExpr("cast(label AS BIGINT) AS doc_id", "text")


def train(rows: DataFrame, labels: DataFrame, label_col: str = "quality", most: int = TRAINING_ROWS,
          fold: str = "crc32(cast(doc_id AS STRING)) % 5 = 0") -> Forest | None:
    """Trees fitted on labelled rows outside ``fold``, which is left for judging them; None without both labels."""
    sample = measured(training_rows(rows, labels, label_col, most, fold)).select("doc_id", "statistics").collect()
    y = np.array([r.doc_id for r in sample], dtype=float)
    if len(np.unique(y)) < 2:
        return None
    order = np.lexsort(np.array([[*r.statistics, r.doc_id] for r in sample]).T)  # the same trees however rows arrive
    x = np.array([r.statistics for r in sample])[order]
    return fit(x, y[order], np.array(list(STATISTICS.values())))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
            most: int = TRAINING_ROWS, threshold: float = 0.5) -> DataFrame:
    """One row per input row: the counts, ``base_failed``, ``score`` of the trees, and ``kept``."""
    rows = common.rows_of_text(docs, id_col, text_col)
    forest = docs.sparkSession.sparkContext.broadcast(train(rows, labels, label_col, most))

    def judge(batches):
        for batch in batches:
            x = np.array(batch.column("statistics").to_pylist(), dtype=float).reshape(batch.num_rows, len(STATISTICS))
            score = forest.value.score(x) if forest.value is not None else np.ones(len(x))
            keep = batch.schema.names[:-1]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(score)], names=[*keep, "score"])

    judged = measured(rows).mapInArrow(judge, DDL.replace("statistics array<double>", "score double"))
    failed = f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words"
    return judged.selectExpr("doc_id", *COUNTS, f"({failed}) AS base_failed", f"NOT ({failed}) AND score >= {threshold}D AS kept", "score")
