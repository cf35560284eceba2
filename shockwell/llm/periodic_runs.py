"""Runs of repeated words by internal pattern matching.

A run is a stretch of words with smallest period q (words q apart are equal)
that is at least 2q words long and that no neighbouring word extends.  Blocks
of 2^k words, half a block apart, are looked up inside the text: a run of
period q holds such a block of about two thirds of q, and the block stands
again q words later.  So each block asks for its next occurrences in the window
of three blocks behind it.  Occurrences are places of an interval of the suffix
array, and the first one behind a place is a range successor, answered by a
wavelet tree over the suffix array.  Occurrences less than half a block apart
form arithmetic progressions; one look at the words they share gives a whole
progression at once.  Distances are candidate periods; the words that both
places share to the left and to the right give the run.

A text is never compared with another one: the documents of a batch have
suffix-array intervals of their own, and a text of any length is worked on
whole.  Work grows with n log n, memory with some hundred bytes a word.

Defined results: null, empty or blank text has no words, no runs and the empty
collapsed text; a null identifier stays null; every input row gives one row,
repeated rows as well; an empty table gives an empty result; other columns are
left behind, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shockwell.llm import common

#: Words that are worked on together; a longer text is a batch of its own.
BATCH_WORDS = 200_000

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


# ------------------------------------------------------------- suffix arrays

def group_heads(new_group: np.ndarray, places: np.ndarray) -> np.ndarray:
    return np.maximum.accumulate(np.where(new_group, places, 0))


def suffix_array(symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array, and per k the ranks of all blocks of 2^k symbols.

    A rank is the first place of the suffix array with that block, so equal
    ranks are equal blocks.  ``ends`` is the end of each symbol's text; texts
    have no symbol in common, and a block that a text's end cuts is like no
    other.  Ranks have one more entry, -1, behind the last symbol.  The last
    level has no two equal ranks.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    places = np.arange(n)
    ordered = symbols[order]
    heads = group_heads(np.concatenate(([True], ordered[1:] != ordered[:-1])), places)
    rank = np.full(n + 1, -1, dtype=np.int32)
    rank[order] = heads
    levels, width = [rank], 1
    while True:
        # Only blocks that occur again are sorted further.
        again = heads[1:] == heads[:-1]
        active = np.flatnonzero(np.concatenate((again, [False])) | np.concatenate(([False], again)))
        if not len(active):
            return order, levels
        at = order[active]
        behind = at + width
        second = np.where(behind < ends[at], rank[np.minimum(behind, n)], -1).astype(np.int64)
        key = heads[active] * (n + 2) + second + 1
        by_key = np.argsort(key, kind="stable")
        key, at = key[by_key], at[by_key]
        order[active] = at
        new_heads = group_heads(np.concatenate(([True], key[1:] != key[:-1])), active)
        heads = heads.copy()
        heads[active] = new_heads
        rank = rank.copy()
        rank[at] = new_heads
        levels.append(rank)
        width *= 2


def shared_after(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal symbols from ``a`` and from ``b`` on, ``a < b`` in one text."""
    total = np.zeros(len(a), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        total += (levels[k][a + total] == levels[k][b + total]).astype(np.int64) << k
    return total


def shared_before(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal symbols right before ``a`` and ``b``."""
    total = np.zeros(len(a), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        left = a - total - (1 << k)
        same = (left >= 0) & (levels[k][np.maximum(left, 0)] == levels[k][np.maximum(left + b - a, 0)])
        total += same.astype(np.int64) << k
    return total


class RangeSuccessor:
    """A wavelet tree over a sequence of numbers from 0 on, kept level by level:
    per bit, the number of ones before each place, ones behind zeros."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.levels = []
        for bit in range(self.bits - 1, -1, -1):
            ones = (values >> bit & 1).astype(bool)
            before = np.zeros(len(values) + 1, dtype=np.int32)
            np.cumsum(ones, out=before[1:])
            self.levels.append((bit, before, len(values) - int(before[-1])))
            values = np.concatenate((values[~ones], values[ones]))

    def __call__(self, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The smallest value of at least ``least`` at places low..high-1, or -1."""
        smaller = np.zeros(len(low), dtype=np.int64)
        lo, hi = low, high
        for bit, before, zeros in self.levels:
            lo_ones, hi_ones = before[lo], before[hi]
            one = (least >> bit & 1).astype(bool)
            smaller += np.where(one, (hi - hi_ones) - (lo - lo_ones), 0)
            lo = np.where(one, zeros + lo_ones, lo - lo_ones)
            hi = np.where(one, zeros + hi_ones, hi - hi_ones)
        there = (smaller < high - low) & (least < 1 << self.bits)
        value = np.zeros(len(low), dtype=np.int64)
        lo, hi, skip = low, high, smaller
        for bit, before, zeros in self.levels:
            lo_ones, hi_ones = before[lo], before[hi]
            n_zeros = (hi - hi_ones) - (lo - lo_ones)
            one = skip >= n_zeros
            skip = np.where(one, skip - n_zeros, skip)
            value |= one.astype(np.int64) << bit
            lo = np.where(one, zeros + lo_ones, lo - lo_ones)
            hi = np.where(one, zeros + hi_ones, hi - hi_ones)
        return np.where(there, value, -1)


# ---------------------------------------------------------------------- runs

def first_level(shortest: int) -> int:
    """The largest k such that every run, of at least ``shortest`` symbols, holds
    a block of 2^k on the half-block grid that stands again one period later."""
    k = 0
    while 3 * (1 << k) - 1 <= (shortest + 1) // 2:
        k += 1
    return k


def periods_of(k: int, first: int) -> tuple[int, int]:
    """The periods, from and to, that blocks of 2^k symbols find."""
    return (1 if k == first else 3 * (1 << k) // 2 - 1), 3 * (1 << k) - 2


def repeated_within(levels: list[np.ndarray], k: int, order: np.ndarray) -> tuple:
    """Of the blocks that occur again: where they stand in order, the place
    behind each place of the suffix array among them, and the wavelet tree."""
    rank = levels[k][:-1]
    size = np.bincount(rank, minlength=len(rank))
    again = size[rank[order]] > 1
    places = np.concatenate(([0], np.cumsum(again)))
    at = order[again]
    return np.sort(at), places, at


def candidates(levels: list[np.ndarray], order: np.ndarray, first: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(places, periods)``: a block at the place stands again a period later."""
    if first >= len(levels):
        return
    sorted_at, places, at = repeated_within(levels, first, order)
    if not len(at):
        return
    # The tree holds the numbers of the repeated blocks' places, which are fewer than the places.
    successor = RangeSuccessor(np.searchsorted(sorted_at, at))
    for k in range(first, len(levels)):
        width, rank = 1 << k, levels[k]
        size = np.bincount(rank[:-1], minlength=len(rank))
        block = np.arange(0, len(rank) - 1, max(1, width // 2))
        block = block[size[rank[block]] > 1]
        low, high = places[rank[block]], places[rank[block] + size[rank[block]]]
        shortest, longest = periods_of(k, first)
        before, own = block, True
        while len(block):
            number = successor(low, high, np.searchsorted(sorted_at, before + 1))
            found = np.where(number >= 0, sorted_at[np.maximum(number, 0)], -1)
            near = (found >= 0) & (found - block <= longest)
            block, low, high, before, found = block[near], low[near], high[near], before[near], found[near]
            step = found - before
            regular = 2 * step <= width
            count = np.ones(len(block), dtype=np.int64)
            count[regular] += (shared_after(levels, before[regular], found[regular]) - width) // step[regular]
            last = before + count * step
            # Multiples of the period of the block's own stretch are no smallest periods.
            many = np.ones_like(count) if own else np.minimum(count, (longest - (before - block)) // step)
            offset = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + 1
            period = np.repeat(before - block, many) + offset * np.repeat(step, many)
            place = np.repeat(block, many)
            wanted = (period >= shortest) & (period <= longest)
            yield place[wanted], period[wanted]
            before, own = last, False


def find_runs(symbols: np.ndarray, ends: np.ndarray, shortest: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, period)`` of all runs of at least ``shortest`` symbols, by start, then period.

    ``symbols`` holds several texts without a common symbol one behind the
    other; ``ends`` gives each symbol the end of its text.
    """
    nothing = np.zeros(0, dtype=np.int64)
    if not len(symbols):
        return nothing, nothing, nothing
    order, levels = suffix_array(symbols, ends)
    parts = [(nothing, nothing, nothing)]
    for place, period in candidates(levels, order, first_level(shortest)):
        start = place - shared_before(levels, place, place + period)
        end = place + period + shared_after(levels, place, place + period)
        long_enough = end - start >= np.maximum(shortest, 2 * period)
        parts.append((start[long_enough], end[long_enough], period[long_enough]))
    start, end, period = (np.concatenate(c) for c in zip(*parts))
    # Of a stretch the smallest period counts; the others are its multiples.
    by_stretch = np.lexsort((period, end, start))
    start, end, period = start[by_stretch], end[by_stretch], period[by_stretch]
    first = np.ones(len(start), dtype=bool)
    first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[first], end[first], period[first]
    by_start = np.lexsort((period, start))
    return start[by_start], end[by_start], period[by_start]


def runs_of_texts(texts: list[list[bytes]], shortest: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of lists of words: ``(number of runs per text, start, length, period,
    keep)``; ``keep`` tells of each word whether it lies in no run behind that
    run's first period."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    stops = np.cumsum(lengths)
    words = [w for t in texts for w in t]
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    symbols = np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words))
    text = np.repeat(np.arange(len(texts)), lengths)
    start, end, period = find_runs(text * max(1, len(numbers)) + symbols, np.repeat(stops, lengths), shortest)
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(covered, start + period, 1)
    np.add.at(covered, end, -1)
    of = text[start]
    return (np.bincount(of, minlength=len(texts)), start - (stops - lengths)[of], end - start, period,
            np.cumsum(covered[:-1]) == 0)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 12,
                  rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row per input row: ``doc_id``, ``runs`` (array of ``start, length,
    period`` in words, by start, then period) and ``collapsed``, the words that
    no run drops, joined by one space.

    ``shortest``: words of a run, at least two.  ``rewrite``: words to work on
    instead of the text's own, from identifier and words.
    """
    if shortest < 2:
        raise ValueError("a run has two words at least")
    schema = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])

    def result(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        counts, start, length, period, keep = runs_of_texts(texts, shortest)
        offsets = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
        runs = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(
            [pa.array(c, pa.int64()) for c in (start, length, period)], fields=list(RUN)))
        kept, at = [], 0
        for words in texts:
            kept.append(b" ".join(compress(words, keep[at:at + len(words)].tolist())))
            at += len(words)
        collapsed = pa.array(kept, pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), runs, collapsed], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, n_words = [], [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), common.text_bytes(batch)):
                words = text.split()  # of bytes: the six ASCII blanks
                ids.append(doc_id)
                texts.append(words if rewrite is None else rewrite(doc_id, words))
                n_words += len(texts[-1])
                if n_words >= BATCH_WORDS:
                    yield result(ids, texts)
                    ids, texts, n_words = [], [], 0
            if ids:
                yield result(ids, texts)

    rows = common.rows_of_text(docs, id_col, text_col)
    return rows.mapInArrow(run, "doc_id bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The query's words: by a checksum of the identifier, one text in ten goes
    on repeating a stretch of its own from some word on.  No identifier: as it is."""
    n = len(words)
    h = 1 if doc_id is None else crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def digest(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one (ties: smallest start, then period), and
    checksums of all runs and of the collapsed text."""
    best = "array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))"
    lines = "transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n'))"
    return found.selectExpr("doc_id", "cast(size(runs) AS BIGINT) AS n_runs", f"{best} AS best", f"sha2(array_join({lines}, ''), 256) AS runs_sha256",
                            "sha2(collapsed, 256) AS collapsed_sha256").selectExpr(
        "doc_id", "n_runs", "-best.start AS start", "best.length AS length", "-best.period AS period",
        "best.length * 1000 div -best.period AS exponent_milli", "runs_sha256", "collapsed_sha256")
