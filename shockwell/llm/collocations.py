"""Phrases of words that stand together more often than their parts suggest.

Counting is done by HAT-tries: a trie over word numbers whose leaves are hash
containers.  A container that grows too large bursts: next words with many
phrases get containers of their own, all others go on sharing one; so the trie
is shallow and follows the frequent prefixes.  A
task's trie is bounded: when it holds too many phrases, its largest subtrees
leave it whole, each as a sorted run of phrases with their counts.  Runs are
merged per prefix partition, the phrases of a first word, with large prefixes
cut into cells by a hash of the phrase.

Phrases are counted by length, shortest first.  A phrase is as frequent at most
as the two phrases it holds that are one word shorter, so a pass skips phrases
with a rare one among them.  What is frequent goes to the tasks as a bit filter
of fixed size: it may let rare phrases through, which costs counting them, and
never stops a frequent one, so counts are exact at any size.

Most phrases of the lengths between are rare, so these lengths are counted by
the phrases' 64-bit hashes first, which only makes the filter: a task sends
sorted runs of hashes and counts, a row for each range of hashes, and each
range is added up by itself.  Phrases that share a hash are at least as
frequent by it as each of them is.  The phrases that the filter lets through
are then counted themselves, in the same pass as those one word longer.

A word's hash is taken from the text's bytes, for all words of a batch at once;
only words of phrases that pass the filters get a number and meet a trie.

Defined results: null, empty or blank text has no words; a missing ``lang`` is
``und``; repeated rows count each time; an empty table gives an empty result;
identifiers are not used and may be missing; other columns are left behind,
whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shockwell.llm import common
from shockwell.plans.storage import work_folder, written

#: Phrases and words that all of a task's tries hold at most, and entries of a container before it bursts.
MOST_PHRASES, MOST_WORDS, CONTAINER = 400_000, 1 << 18, 1 << 16
#: Words of a task that are counted together.
BATCH_WORDS = 120_000
#: Parts that the runs of one first word are cut into.
CELLS = 64
#: Numbers for language, prefix and cell; two bytes.
PARTS = 1 << 16
#: Words that start in as many bytes (a power of two) are hashed together; longer ones than ``LONG_WORD`` by themselves.
HASHED_BITS, LONG_WORD = 17, 4096
#: Bits of a phrase's hash that tell its range.
RANGE_BITS = 11

# A-Z to a-z, and all that ends a piece to a full stop.
ENDS = b".,;:!?\n\x0b\x0c\r"
PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + ENDS, b"abcdefghijklmnopqrstuvwxyz" + b"." * len(ENDS))
END = b"."

FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Base of the words' hashes; odd, so its powers have inverses.
BASE = 0xD6E8FEB86659FD93
INVERSE = pow(BASE, -1, 1 << 64)

RUN = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])
RUN_SQL = "lang string, phrase string, n bigint"
HASHES = pa.schema([("hash", pa.int64()), ("n", pa.int64())])
RANGES = pa.schema([("part", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())])
RANGES_SQL = "part int, hashes binary, counts binary"


# ----------------------------------------------------------------- the tries

class Node:
    """Phrases below a prefix: containers of their own for the next words with
    many phrases, and one container that all other next words share.

    A phrase is a number: one digit of ``bits`` bits for each of its words.
    """

    __slots__ = ("digits", "table", "children", "limit", "first", "last")

    def __init__(self, digits: int):
        self.digits, self.table, self.children, self.limit = digits, Counter(), {}, CONTAINER

    def add(self, codes: np.ndarray, bits: int) -> None:
        if self.children:
            codes = np.sort(codes)
            shared = np.ones(len(codes), dtype=bool)
            inner = (1 << bits * (self.digits - 1)) - 1
            for child, a, b in zip(self.children.values(), np.searchsorted(codes, self.first), np.searchsorted(codes, self.last)):
                if a < b:
                    child.add(codes[a:b] & inner, bits)
                    shared[a:b] = False
            codes = codes[shared]
        self.table.update(codes.tolist())
        if len(self.table) > self.limit and self.digits > 1:
            self.burst(bits)

    def burst(self, bits: int) -> None:
        """Next words with a sixteenth of a full container leave for containers of their own."""
        shift = bits * (self.digits - 1)
        codes, counts = from_table(self.table)
        first = codes >> shift
        words, place, sizes = np.unique(first, return_inverse=True, return_counts=True)
        leaves = (sizes >= CONTAINER // 16)[place]
        by_word = np.flatnonzero(leaves)[np.argsort(first[leaves], kind="stable")]
        starts = np.flatnonzero(np.diff(first[by_word], prepend=-1))
        for part in np.split(by_word, starts[1:]) if len(by_word) else []:
            child = self.children[int(first[part[0]])] = Node(self.digits - 1)
            child.table = to_table(codes[part] & (1 << shift) - 1, counts[part])
        self.table = to_table(codes[~leaves], counts[~leaves])
        self.limit = max(CONTAINER, 2 * len(self.table))
        self.bounds(shift)

    def bounds(self, shift: int) -> None:
        words = np.fromiter(self.children, np.int64, len(self.children))
        self.first, self.last = words << shift, words + 1 << shift

    def take(self, word: int | None, bits: int) -> "Node":
        """A subtree, or the shared container (no word), leaves the node whole."""
        if word is None:
            shared = Node(self.digits)
            shared.table, self.table = self.table, shared.table
            return shared
        child = self.children.pop(word)
        self.bounds(bits * (self.digits - 1))
        return child

    def size(self) -> int:
        return len(self.table) + sum(c.size() for c in self.children.values())

    def entries(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """``(codes, counts)`` of everything below."""
        shift = bits * (self.digits - 1)
        parts = [from_table(self.table)]
        for word, child in self.children.items():
            codes, counts = child.entries(bits)
            parts.append((codes | word << shift, counts))
        return tuple(np.concatenate(column) for column in zip(*parts))


def from_table(table: Counter) -> tuple[np.ndarray, np.ndarray]:
    return np.fromiter(table.keys(), np.int64, len(table)), np.fromiter(table.values(), np.int64, len(table))


def to_table(codes: np.ndarray, counts: np.ndarray) -> Counter:
    table = Counter()
    dict.update(table, zip(codes.tolist(), counts.tolist()))
    return table


class Numbers(dict):
    """The number of each word; a new word gets the next one."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Trie:
    """The phrases of ``length`` words of one language that a task has met.

    ``filters``: of frequent words and, for three words and more, of frequent
    phrases one word shorter; none to count everything.  ``with_shorter``: the
    phrases one word shorter that the last filter holds are counted, too.
    """

    def __init__(self, lang: str, length: int, filters: list[np.ndarray], with_shorter: bool = False):
        self.lang, self.length, self.filters = lang, length, filters
        self.lengths = [length, length - 1] if with_shorter else [length]
        self.bits = 63 // length
        self.clear()

    def clear(self) -> None:
        self.words = Numbers()
        self.roots = {length: Node(length) for length in self.lengths}
        self.n_words = 0

    def add(self, tokens: list[bytes], pieces: np.ndarray, hashes: np.ndarray | None, starts: int) -> None:
        """Count the phrases; of the words the first ``starts``, for the rest belongs to the next call."""
        self.n_words += min(starts, len(tokens))
        found = list(zip(self.lengths, places(self.length, pieces, hashes, self.filters, starts)))
        if self.filters:
            used = np.zeros(len(tokens), dtype=bool)
            for length, at in found:
                for j in range(length):
                    used[at + j] = True
            used = np.flatnonzero(used)
            ids = np.zeros(len(tokens), dtype=np.int64)
            ids[used] = np.fromiter(map(self.words.__getitem__, map(tokens.__getitem__, used.tolist())), np.int64, len(used))
        else:
            ids = np.fromiter(map(self.words.__getitem__, tokens), np.int64, len(tokens))
        for length, at in found:
            code = ids[at]
            for j in range(1, length):
                code = code << self.bits | ids[at + j]
            self.roots[length].add(code, self.bits)

    def subtrees(self) -> list[tuple[int, tuple[int, int | None]]]:
        """``(size, (length, first word))`` of what can leave the trie whole; no word: the shared container."""
        return [(size, (length, word)) for length, root in self.roots.items()
                for size, word in [(len(root.table), None), *((child.size(), word) for word, child in root.children.items())]]

    def spill(self, trees: list[tuple[int, int | None]]) -> Iterator[pa.RecordBatch]:
        """Take subtrees out of the trie, as one sorted run for each length."""
        for length, root in self.roots.items():
            shift, parts = self.bits * (length - 1), []
            for word in [word for of, word in trees if of == length]:
                codes, counts = root.take(word, self.bits).entries(self.bits)
                parts.append((codes if word is None else codes | word << shift, counts))
            if parts:
                yield from self.sorted_run(length, *(np.concatenate(column) for column in zip(*parts)))

    def sorted_run(self, length: int, codes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        known = pa.array(list(self.words), pa.binary())
        columns = [known.take(pa.array(codes >> self.bits * j & (1 << self.bits) - 1)) for j in range(length - 1, -1, -1)]
        phrase = columns[0] if len(columns) == 1 else pc.binary_join_element_wise(*columns, b" ")
        order = pc.sort_indices(phrase)
        run = pa.RecordBatch.from_arrays([
            pa.array([self.lang] * len(codes), pa.string()), phrase.take(order).cast(pa.string()),
            pa.array(counts, pa.int64()).take(order)], schema=RUN)
        for start in range(0, len(codes), 20_000):
            yield run.slice(start, 20_000)

    def everything(self) -> Iterator[pa.RecordBatch]:
        """All that is left, and the number of words under the empty phrase."""
        if self.length == 1 and self.n_words:
            yield pa.RecordBatch.from_arrays([pa.array([self.lang]), pa.array([""]), pa.array([self.n_words])], schema=RUN)
        for length, root in self.roots.items():
            yield from self.sorted_run(length, *root.entries(self.bits))
        self.clear()


def spilled(tries: dict[str, Trie], most: int) -> Iterator[pa.RecordBatch]:
    """If the tries hold more than ``most`` phrases, their largest subtrees leave until half of that is left."""
    trees = [(size, lang, tree) for lang, trie in tries.items() for size, tree in trie.subtrees()]
    left, leaving = sum(t[0] for t in trees), {}
    if left <= most:
        return
    for size, lang, tree in sorted(trees, key=lambda t: -t[0]):
        if 2 * left <= most:
            break
        leaving.setdefault(lang, []).append(tree)
        left -= size
    for lang, leave in leaving.items():
        yield from tries[lang].spill(leave)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices, so that copies of its texts are few at a time."""
    for start in range(0, batch.num_rows, 500):
        yield batch.slice(start, 500)


def joined_texts(batches: Iterator[pa.RecordBatch], batch_words: int) -> Iterator[dict[str, bytes]]:
    """The texts of each language, lower-cased, with an end after each; of about ``batch_words`` words together."""
    waiting: dict[str, list[bytes]] = {}
    n_waiting = 0
    for batch in (part for whole in batches for part in slices(whole)):
        for lang, text in zip(batch.column("lang").to_pylist(), common.text_bytes(batch)):
            waiting.setdefault(lang, []).append(text.translate(PLAIN) + END)
            n_waiting += len(text) // 6 + 1
            if n_waiting >= batch_words:
                yield {lang: b"".join(texts) for lang, texts in waiting.items()}
                waiting, n_waiting = {}, 0
    yield {lang: b"".join(texts) for lang, texts in waiting.items()}


def count_phrases(batches: Iterator[pa.RecordBatch], length: int, filters: list[np.ndarray], most_phrases: int = MOST_PHRASES,
                  batch_words: int = BATCH_WORDS, with_shorter: bool = False, hashed: bool = False) -> Iterator[pa.RecordBatch]:
    """Sorted runs of the phrases of ``length`` words of a task's texts, or of their hashes; ``with_shorter`` as in ``Trie``."""
    if hashed:
        yield from count_hashes(batches, length, filters, most_phrases, batch_words)
        return
    tries: dict[str, Trie] = {}
    for texts in joined_texts(batches, batch_words):
        for lang, text in texts.items():
            trie = tries.setdefault(lang, Trie(lang, length, filters, with_shorter))
            limit = min(MOST_WORDS, 1 << trie.bits)
            step = min(batch_words, limit // 2)
            tokens = text.replace(END, b" ").split()
            pieces, hashes = np.zeros(len(tokens), dtype=np.int64), None
            if length > 1:
                firsts, lasts, pieces = word_places(text)
            if filters:
                hashes = hashes_at(text, firsts, lasts, language_seed(lang))
            for start in range(0, len(tokens), step):
                part = slice(start, start + step + length - 1)
                if len(trie.words) + len(tokens[part]) >= limit:
                    yield from trie.everything()
                trie.add(tokens[part], pieces[part], None if hashes is None else hashes[part], step)
        if sum(len(trie.words) for trie in tries.values()) > MOST_WORDS:
            for trie in tries.values():
                yield from trie.everything()
        yield from spilled(tries, most_phrases)
    for trie in tries.values():
        yield from trie.everything()


def count_hashes(batches: Iterator[pa.RecordBatch], length: int, filters: list[np.ndarray],
                 most_phrases: int, batch_words: int) -> Iterator[pa.RecordBatch]:
    """Sorted runs of the hashes of the phrases, each of some times ``most_phrases`` occurrences."""
    waiting, n_waiting = [], 0
    for texts in joined_texts(batches, batch_words):
        for lang, text in texts.items():
            firsts, lasts, pieces = word_places(text)
            hashes = hashes_at(text, firsts, lasts, language_seed(lang))
            at = next(places(length, pieces, hashes, filters, len(pieces)))
            waiting.append(phrase_hashes([hashes[at + j] for j in range(length)]))
            n_waiting += len(at)
        if n_waiting >= 4 * most_phrases:
            yield hashed_run(waiting)
            waiting, n_waiting = [], 0
    if n_waiting:
        yield hashed_run(waiting)


def hashed_run(parts: list[np.ndarray]) -> pa.RecordBatch:
    hashes = np.sort(np.concatenate(parts))
    starts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
    counts = np.diff(starts, append=len(hashes))
    return pa.RecordBatch.from_arrays([pa.array(hashes[starts].view(np.int64)), pa.array(counts)], schema=HASHES)


# ----------------------------------------------------------- words of a text

def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of a plain text begin and end, and the number of the piece that each is in."""
    codes = np.frombuffer(text, dtype=np.uint8)
    ends = codes == END[0]
    inside = np.zeros(len(codes) + 2, dtype=np.int8)
    inside[1:-1] = ~(ends | (codes == 32) | (codes == 9))
    edges = np.flatnonzero(np.diff(inside))
    firsts = edges[::2]
    return firsts, edges[1::2], np.searchsorted(np.flatnonzero(ends), firsts)


def places(length: int, pieces: np.ndarray, hashes: np.ndarray | None, filters: list[np.ndarray], starts: int) -> Iterator[np.ndarray]:
    """Where the phrases within pieces start that hold no rare word or shorter phrase, and then those shorter ones."""
    size = length if len(filters) < 2 else length - 1
    found = pieces[size - 1:] == pieces[:max(len(pieces) - size + 1, 0)]
    if filters:
        known = common.may_hold(filters[0], hashes)
        for j in range(size):
            found &= known[j:j + len(found)]
    found = np.flatnonzero(found)
    if size == length:
        yield found
        return
    found = found[common.may_hold(filters[-1], phrase_hashes([hashes[found + j] for j in range(size)]))]
    kept = np.zeros(len(pieces) + 1, dtype=bool)
    kept[found] = True
    yield found[kept[found + 1]]
    yield found[found < starts]


@lru_cache
def powers(base: int) -> np.ndarray:
    out = np.full((1 << HASHED_BITS) + LONG_WORD, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@lru_cache(maxsize=1000)
def language_seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode()))


def hashes_at(text: bytes, firsts: np.ndarray, lasts: np.ndarray, seeds: np.ndarray | np.uint64) -> np.ndarray:
    """The hash of each word: its bytes as the digits of a number, seeded by its language and mixed."""
    codes, hashes = np.frombuffer(text, dtype=np.uint8), np.empty(len(firsts), dtype=np.uint64)
    blocks = np.flatnonzero(np.diff(firsts >> HASHED_BITS, prepend=-1)).tolist()
    for start, stop in zip(blocks, [*blocks[1:], len(firsts)]):
        first = firsts[start:stop]
        last, base = np.minimum(lasts[start:stop], first + LONG_WORD), first[0]
        block = codes[base:last[-1]] + np.uint64(1)
        sums = np.zeros(len(block) + 1, dtype=np.uint64)
        np.cumsum(block * powers(BASE)[:len(block)], out=sums[1:])
        hashes[start:stop] = (sums[last - base] - sums[first - base]) * powers(INVERSE)[first - base]
    for i in np.flatnonzero(lasts - firsts > LONG_WORD).tolist():
        hashes[i] = xxhash.xxh64_intdigest(text[firsts[i]:lasts[i]])
    hashes += seeds
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        hashes ^= hashes >> np.uint64(33)
        hashes *= np.uint64(factor)
    return hashes ^ hashes >> np.uint64(33)


# ---------------------------------------------------------------- the filter

def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    return hashes_of([lang] * len(words), words)


def hashes_of(langs: list[str], words: list[bytes]) -> np.ndarray:
    lasts = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    firsts = np.append(0, lasts[:-1])[:len(words)]
    return hashes_at(b"".join(words), firsts, lasts, np.fromiter(map(language_seed, langs), np.uint64, len(langs)))


def phrase_hashes(words: list[np.ndarray]) -> np.ndarray:
    return reduce(lambda h, w: h * FACTOR + w, words)


def filter_of(frequent: DataFrame) -> np.ndarray:
    """The bit filter of a table of phrases."""

    def hashes(batch: pa.RecordBatch) -> np.ndarray:
        phrases = [phrase.split(b" ") for phrase in common.text_bytes(batch, "phrase")]
        sizes = np.fromiter(map(len, phrases), np.int64, len(phrases))
        langs = [lang for lang, words in zip(batch.column("lang").to_pylist(), phrases) for _ in words]
        words = hashes_of(langs, [word for phrase in phrases for word in phrase])
        firsts = np.cumsum(sizes) - sizes
        return np.concatenate([np.empty(0, np.uint64), *(
            phrase_hashes([words[firsts[sizes == size] + j] for j in range(size)]) for size in np.unique(sizes))])

    # One pass over a batch: a second function behind the first would keep a second worker per core.
    return common.bit_filter(frequent.select("lang", "phrase"), hashes)


def ranges(run: pa.RecordBatch) -> pa.RecordBatch:
    """A run of hashes with a row for each range of them that it meets."""
    hashes, counts = (run.column(name).to_numpy() for name in ("hash", "n"))
    part = hashes.view(np.uint64) >> np.uint64(64 - RANGE_BITS)
    starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    bounds = np.append(starts, len(hashes)).astype(np.int32)
    packed = [pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds * np.int32(8)), pa.py_buffer(column)])
              for column in (hashes, counts)]
    return pa.RecordBatch.from_arrays([pa.array(part[starts].astype(np.int32)), *packed], schema=RANGES)


def frequent_hashes(rows: pa.Table, least: int) -> pa.Table:
    """The hashes of a range whose counts add up to ``least``."""
    hashes, counts = (np.frombuffer(b"".join(rows.column(name).to_pylist()), dtype=np.int64) for name in ("hashes", "counts"))
    order = np.argsort(hashes)
    hashes = hashes[order]
    starts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
    return pa.table({"hash": hashes[starts][np.add.reduceat(counts[order], starts) >= least]})


# -------------------------------------------------------------------- tables

def counted_runs(texts: DataFrame, length: int, filters: list[np.ndarray], hashed: bool = False, **options) -> DataFrame:
    """The runs of all tasks; ``filters`` of phrases of 1, 2 ... words."""
    wanted = filters[:1] + filters[length - 2:length - 1] if length > 2 else filters[:1]
    known = texts.sparkSession.sparkContext.broadcast(wanted)
    if hashed:
        return texts.mapInArrow(lambda batches: map(ranges, count_phrases(batches, length, known.value, hashed=True, **options)), RANGES_SQL)
    return texts.mapInArrow(lambda batches: count_phrases(batches, length, known.value, **options), RUN_SQL)


def frequent_filter(texts: DataFrame, length: int, filters: list[np.ndarray], least: int, folder: str, **limits: int) -> np.ndarray:
    """A bit filter of the phrases of ``length`` words whose hash occurs ``least`` times at least."""
    runs = counted_runs(texts, length, filters, hashed=True, **limits)
    found = runs.groupBy("part").applyInArrow(lambda rows: frequent_hashes(rows, least), "hash bigint")
    return common.bit_filter(written(found, f"{folder}/hashes_{length}"))


def merged_counts(texts: DataFrame, length: int, filters: list[np.ndarray], **options) -> DataFrame:
    """``(lang, phrase, n)``: counts of phrases of ``length`` words over all tasks; rare ones may be missing."""
    # A small number for language, prefix and cell: it is in every row of the shuffle.
    prefix = f"cast(pmod(xxhash64(lang, substring_index(phrase, ' ', 1), {cell('phrase')}), {PARTS}) AS INT)"
    runs = counted_runs(texts, length, filters, **options).withColumn("part", F.expr(prefix))
    return runs.repartition("part").groupBy("part", "lang", "phrase").agg(F.sum("n").alias("n")).select("lang", "phrase", "n")


def cell(phrase: str) -> str:
    return f"pmod(xxhash64({phrase}), {CELLS})"


def with_counts(cuts: DataFrame, counts: DataFrame, part: str, name: str, folder: str) -> DataFrame:
    """``cuts`` with the count of the phrase in column ``part``; parts of very many cuts are dealt out."""
    uses = cuts.groupBy("lang", part).agg(F.count(F.lit(1)).alias("n_uses"))
    groups = written(uses.join(counts.selectExpr("lang", f"phrase AS {part}", f"n AS {name}"), ["lang", part]), f"{folder}/{name}")
    total = groups.agg(F.coalesce(F.sum("n_uses"), F.lit(0))).first()[0]
    return common.join_to_groups(cuts, groups, ["lang", part], "n_uses", total).drop("n_uses")


def words_from_to(phrase: str, first: str, last: str) -> str:
    """SQL text: the words of a phrase from number ``first`` to ``last``, from 1."""
    return f"array_join(slice(split({phrase}, ' '), {first}, {last} - {first} + 1), ' ')"


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 3, least: int = 10,
    most: int = 2000, covered_percent: int = 50, folder: str | None = None, **limits: int,
) -> DataFrame:
    """Per language the first ``most`` phrases: ``lang, rank, phrase, a, l, r, n, score``.

    Candidates are the phrases of 2 to ``longest`` words that occur ``a >=
    least`` times within pieces of text.  A cut into two parts with ``l`` and
    ``r`` occurrences scores ``floor(1000000 a a / (l r))``; the lowest counts,
    of equal ones the cut with the shortest first part.  A candidate within a
    longer one that has ``covered_percent`` of its occurrences at least is
    dropped.  Ranked by score, then ``a``, then phrase in byte order; ``n`` is
    the number of words of the language.  The work tables go below ``folder``.
    """
    if longest < 2 or least < 1:
        raise ValueError("phrases have two words and one occurrence at least")
    folder = folder or work_folder(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text")).filter("text IS NOT NULL")

    def frequent(length: int, **options) -> DataFrame:
        counts = merged_counts(texts, length, filters, **options, **limits).filter((F.col("n") >= least) | (F.col("phrase") == ""))
        return written(counts, f"{folder}/words_{length}")

    filters: list[np.ndarray] = []
    tables = [frequent(1)]
    filters.append(filter_of(tables[0].filter("phrase <> ''")))
    for length in range(2, longest):
        filters.append(frequent_filter(texts, length, filters, least, folder, **limits))
    # Two lengths in a pass, from the longest down.
    for length in range(longest, 1, -2):
        tables.append(frequent(length, with_shorter=length > 2))
    totals = tables[0].filter("phrase = ''").selectExpr("lang", "n")
    counts = reduce(DataFrame.unionByName, tables).filter("phrase <> ''")
    candidates = reduce(DataFrame.unionByName, tables[1:])

    n_words = "size(split(phrase, ' '))"
    cuts = candidates.selectExpr("lang", "phrase", "n AS a", f"explode(sequence(1, {n_words} - 1)) AS k").selectExpr(
        "*", f"{words_from_to('phrase', '1', 'k')} AS first", f"{words_from_to('phrase', 'k + 1', n_words)} AS rest")
    cuts = written(cuts, f"{folder}/cuts")
    halved = written(with_counts(cuts, counts, "first", "l", folder), f"{folder}/halved")
    # Up to 10^15 occurrences: the products have 38 digits at most, and a score is at most a million.
    wide = {c: f"cast({c} AS DECIMAL(15, 0))" for c in "alr"}
    score = f"cast(cast(1000000 AS DECIMAL(7, 0)) * ({wide['a']} * {wide['a']}) AS DECIMAL(38, 0)) div ({wide['l']} * {wide['r']})"
    scored = with_counts(halved, counts, "rest", "r", folder).selectExpr("lang", "phrase", "a", "k", "l", "r", f"{score} AS score")
    lowest = scored.groupBy("lang", "phrase").agg(F.expr("min(struct(score, k, a, l, r)) AS cut")).select("lang", "phrase", "cut.*")

    within = candidates.filter(f"{n_words} > 2").selectExpr(
        "lang", "n AS longer", "split(phrase, ' ') AS w", f"explode(sequence(2, {n_words} - 1)) AS size").selectExpr(
        "lang", "longer", "explode(transform(sequence(1, size(w) - size + 1), i -> array_join(slice(w, i, size), ' '))) AS phrase")
    covers = within.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    free = lowest.join(covers, ["lang", "phrase"], "left").filter(
        f"longer IS NULL OR cast(100 AS DECIMAL(3, 0)) * longer < cast({covered_percent} AS DECIMAL(3, 0)) * a")
    # Ranked in cells first, whose first rows are few: a language's last sort has CELLS * most rows at most.
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    ranked = free.withColumn("cell", F.expr(cell("phrase")))
    for keys in (["lang", "cell"], ["lang"]):
        ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint"))
        ranked = ranked.filter(F.col("rank") <= most)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
