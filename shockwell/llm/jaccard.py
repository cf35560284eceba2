"""Jaccard join of word-shingle sets by PartEnum signatures.

Two sets link if their intersection has a given share (80 %) of their union.
Sizes are cut into bands so that the smaller set of a linked pair lies in one
band and the larger in the same or the next; each set takes part in its own
band and in the one below.  Per band, linked sets differ by at most k shingles.
The domain of shingles is cut into k + 1 + t parts by a hash, so a linked pair
agrees in t + 1 of them at least.  A signature is a band, a part and the
shingles that the set has there.  Parts where a set has nothing say little, so
only sets with more than t such parts use them: if a pair agrees in empty parts
alone, both sets have more than t.  So linked sets share a signature.

Sets of a signature are not compared in pairs at first: each is compared with
the one of the earliest row, and the links found make components.  Many
signatures have the same sets, so one of those is kept, and pairs are told
apart before anything is compared.  Only signatures of three sets and more that
lie in different components are looked at again: with another center, a
few for all signatures of a group of copies, then all sets of different
components, a large signature block by block in many tasks.  Comparing looks
at sizes and at counts of shingles per 256th of the hashes first, whose
difference is a lower bound.  The sets themselves decide, so links are exact
(shingles are told apart by their 64-bit hashes).

Texts are cut into shingles once; whole sets are made again for those alone
that have a pair to decide about.  Signatures travel with 64 bits of their set's
key; two different sets with the same 64 bits make a pair.

Equal sets are one class from the start.  Nothing is dropped: no cap on a
signature's sets, no sampling.

Defined results: text without words, and null text, has the empty set and is
linked with nothing, its component is its own identifier; fewer words than a
shingle are one shingle; a null identifier never names a component that has
another; repeated rows are rows of one class; an empty table gives an empty
result; other columns are left behind, whatever their names.  Identifiers are
whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shockwell.llm import common
from shockwell.llm.simhash import components
from shockwell.operators.skew import SALT, SkewPolicy, hot_keys, row_counts, split_join, with_salt
from shockwell.plans.storage import work_folder, written

FACTOR = np.uint64(0x9E3779B97F4A7C17)
MIXERS = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
COUNTERS = 256
#: Words whose hashes, and sets whose keys a task remembers.
MOST_WORDS = 1 << 17
#: Sets of one signature that a task compares with each other or with as many others.
BLOCK = 2000
#: Turns of further stars, and how many centers a group of copies should have in a turn.
TURNS, STARS = 1, 8
#: Pairs that a task holds back to tell them apart.
MOST_PAIRS = 500_000
PAIRS = SkewPolicy(rows_per_split=5_000, key_share=20_000)
CENTERS = SkewPolicy(rows_per_split=200_000, key_share=20_000)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIXERS[0]
    x = (x ^ (x >> np.uint64(27))) * MIXERS[1]
    return x ^ (x >> np.uint64(31))


# ---------------------------------------------------------------------- sets

class Shingler:
    """Sets of shingle hashes of texts; remembers the hashes of words."""

    def __init__(self, size: int):
        self.size, self.words = size, {}

    def __call__(self, text: bytes) -> np.ndarray:
        """The distinct shingles' hashes in ascending order."""
        words = text.lower().split()  # of bytes: A-Z and the six ASCII blanks alone
        if not words:
            return np.zeros(0, dtype=np.uint64)
        if len(self.words) > MOST_WORDS:
            self.words = {}
        known = self.words
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(self.size, len(words))
        n = len(words) - size + 1
        total = np.full(n, size, dtype=np.uint64)
        for j in range(size):
            total = total * FACTOR + hashes[j:j + n]
        return np.unique(mixed(total))


def set_key(items: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart, as two signed numbers."""
    high, low = np.frombuffer(xxhash.xxh3_128_digest(items.tobytes()), dtype=">i8")
    return int(high), int(low)


# ---------------------------------------------------------------- signatures

class Bands:
    """Bands of set sizes and their cuts for a similarity in percent."""

    def __init__(self, percent: int):
        if not 50 < percent <= 100:
            raise ValueError("similarity in percent, over 50")
        self.percent, self.tops = percent, [0, 1]

    def band(self, size: int) -> int:
        """Number of the band that holds ``size``, from 1."""
        while self.tops[-1] < size:
            self.tops.append(max(self.tops[-1] + 1, self.tops[-1] * 100 // self.percent))
        return int(np.searchsorted(self.tops, size))

    def cut(self, band: int) -> tuple[int, int]:
        """``(parts, spare)``: parts of the domain, and how many more they are than needed.

        A pair whose smaller set has at most ``top`` shingles differs by at most
        ``top (100 - percent) / percent``.  The spare parts cover the empty ones
        of nearly all sets of the band: their expected number and three
        deviations.
        """
        top = self.tops[band]
        differ = top * (100 - self.percent) // self.percent
        spare = 0
        while True:
            parts = differ + 1 + spare
            empty = parts * np.exp(-(self.tops[band - 1] + 1) / parts)
            if spare >= min(empty + 3 * np.sqrt(empty), differ / 4 + 1):
                return parts, spare
            spare += 1

    def signatures(self, items: np.ndarray) -> np.ndarray:
        """A set's signatures; equal ones in linked sets.  None for the empty set."""
        if not len(items):
            return np.zeros(0, dtype=np.uint64)
        own, found = self.band(len(items)), []
        for band in {own, max(own - 1, 1)}:
            parts, spare = self.cuts(band)
            salt = np.array([band], dtype=np.uint64)
            values = mixed(items + salt * FACTOR)
            part = ((values >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            sums = np.zeros(parts, dtype=np.uint64)
            np.add.at(sums, part, values)
            sizes = np.bincount(part.astype(np.int64), minlength=parts)
            used = sizes > 0
            if parts - np.count_nonzero(used) > spare:
                used[:] = True
            at = np.flatnonzero(used).astype(np.uint64)
            found.append(mixed(mixed(sums[used] + at * MIXERS[0]) ^ mixed(salt + at)))
        return np.concatenate(found)

    def cuts(self, band: int) -> tuple[int, int]:
        known = self.__dict__.setdefault("known", {})
        if band not in known:
            known[band] = self.cut(band)
        return known[band]


def star_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows ``(sig, key)`` in order, with repeats: ``(sig, first, key, several)``.  A signature
    of two keys has a row with both; one of three and more has a row for each key, ``several``."""
    sig = key = np.zeros(0, dtype=np.int64)  # of the last group: two rows at most
    out = False  # whether those have been handed on

    def stars(end: int, head: np.ndarray, several: np.ndarray) -> pa.RecordBatch:
        rows = np.flatnonzero(several[:end] | (head[:end] != np.arange(end)))
        rows = rows[rows >= len(held) * out]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (sig[rows], key[head[rows]], key[rows], several[rows])],
                                          names=["sig", "first", "key", "several"])

    for batch in batches:
        held = sig
        sig, key = (np.concatenate((old, batch.column(c).to_numpy())) for c, old in (("sig", sig), ("key", key)))
        if not len(sig):
            continue
        new = np.concatenate(([True], (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])))
        sig, key = sig[new], key[new]
        starts = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
        sizes = np.diff(np.append(starts, len(sig)))
        several = sizes > 2
        several[0] |= out
        yield stars(len(sig) if several[-1] else starts[-1], np.repeat(starts, sizes), np.repeat(several, sizes))
        rest = [starts[-1], len(sig) - 1][:sizes[-1]]
        sig, key, out = sig[rest], key[rest], bool(several[-1])
    held = sig[:0]
    if len(sig) == 2 and not out:
        yield stars(2, np.zeros(2, dtype=np.int64), np.zeros(2, dtype=bool))


# ------------------------------------------------------------- passes of text

def set_rows(texts: DataFrame, size: int, percent: int) -> DataFrame:
    """``(doc_id, row_id, n_shingles, key, key2, text_key, counts, sigs)``, a row per input row.

    The empty set has no keys; ``sigs`` is null for copies of a set that the task has met just before.
    """
    arrow = pa.schema([*((c, pa.int64()) for c in ("doc_id", "row_id", "n_shingles", "key", "key2", "text_key")),
                       ("counts", pa.binary()), ("sigs", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, bands, seen = Shingler(size), Bands(percent), set()
        for batch in batches:
            if len(seen) > MOST_WORDS:
                seen = set()
            rows, waiting, start = [], 0, 0
            for i, text in enumerate(common.text_bytes(batch), 1):
                items = shingles(text)
                key, counts, sigs = (None, None), None, None
                if len(items):
                    key, counts = set_key(items), counters(items)
                    if key not in seen:
                        seen.add(key)
                        sigs = bands.signatures(items).view(np.int64)
                        waiting += len(sigs)
                rows.append((len(items), *key, counts, sigs))
                if waiting > 200_000 or i == batch.num_rows:
                    n, high, low, counts, sigs = zip(*rows)
                    part = batch.slice(start, len(rows))
                    yield pa.RecordBatch.from_arrays([
                        part.column("doc_id"), part.column("row_id"), pa.array(n, pa.int64()), pa.array(high, pa.int64()),
                        pa.array(low, pa.int64()), part.column("text_key"), pa.array(counts, pa.binary()),
                        pa.array(sigs, pa.list_(pa.int64()))], schema=arrow)
                    rows, waiting, start = [], 0, i

    return texts.withColumn("text_key", F.xxhash64("text")).mapInArrow(
        run, "doc_id bigint, row_id bigint, n_shingles bigint, key bigint, key2 bigint, text_key bigint, counts binary, sigs array<bigint>")


def sets_of(texts: DataFrame, size: int, wanted: DataFrame, folder: str) -> DataFrame:
    """``(node, items)`` of the wanted classes ``(node, key, key2, text_key)``; other texts are passed over by their hash."""
    known = texts.sparkSession.sparkContext.broadcast(common.bit_filter(wanted.select("text_key")))
    arrow = pa.schema([("key", pa.int64()), ("key2", pa.int64()), ("items", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen = Shingler(size), set()
        for batch in batches:
            if len(seen) > MOST_WORDS:
                seen = set()
            rows, waiting = [], 0
            hashes = batch.column("text_key").to_numpy()
            at = np.flatnonzero(common.may_hold(known.value, hashes.view(np.uint64)))
            for text_key, text in zip(hashes[at].tolist(), common.text_bytes(batch.take(pa.array(at)))):
                if text_key in seen:
                    continue
                seen.add(text_key)
                items = shingles(text)
                if len(items):
                    rows.append((*set_key(items), items.tobytes()))
                    waiting += len(items)
                if waiting > 1_000_000:
                    yield set_batch(rows, arrow)
                    rows, waiting = [], 0
            yield set_batch(rows, arrow)

    found = texts.select("text", F.xxhash64("text").alias("text_key")).mapInArrow(run, "key bigint, key2 bigint, items binary")
    one_each = found.join(wanted, ["key", "key2"]).dropDuplicates(["key", "key2"])
    return written(one_each.select("node", "items"), folder)


def set_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def counters(items: np.ndarray) -> bytes:
    """Shingles per 256th of the hashes, 255 at most."""
    return np.minimum(np.bincount((items >> np.uint64(56)).astype(np.int64), minlength=COUNTERS), 255).astype(np.uint8).tobytes()


# ------------------------------------------------------------------ comparing

def may_link(n: np.ndarray, counts: np.ndarray, other_n: np.ndarray, other_counts: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes and counts allow a link; rows against rows, or against one row."""
    differ = np.abs(counts.astype(np.int16) - other_counts).sum(axis=1, dtype=np.int64)
    differ = np.maximum(differ, np.abs(n - other_n))
    return differ * (100 + percent) <= (n + other_n) * (100 - percent)


def groups_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """The rows of each key, of rows that come in the order of the keys."""
    rest = None
    for batch in batches:
        rest = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        columns = columns_of(rest)
        changes = np.flatnonzero(np.any([columns[k][1:] != columns[k][:-1] for k in keys], axis=0)) + 1
        for a, b in zip([0, *changes[:-1]], changes):
            yield {name: c[a:b] for name, c in columns.items()}
        rest = rest.slice(changes[-1]) if len(changes) else rest
    if rest is not None and rest.num_rows:
        yield columns_of(rest)


def columns_of(rows: pa.Table) -> dict[str, np.ndarray]:
    out = {name: rows.column(name).to_numpy() for name in rows.column_names if name != "counts"}
    if rows.num_rows:
        out["counts"] = np.frombuffer(b"".join(rows.column("counts").to_pylist()), np.uint8).reshape(-1, COUNTERS)
    return out


def pair_batch(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a, b = (np.concatenate(c) if c else np.zeros(0, dtype=np.int64) for c in (list(zip(*pairs)) or ((), ())))
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], names=["a", "b"])


def near_by_counts(percent: int):
    """Of pairs with sizes and counts, those that may link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (columns_of(pa.Table.from_arrays([batch.column(f"{c}_{side}") for c in ("node", "n", "counts")],
                                                        names=["node", "n", "counts"])) for side in "ab")
                near = may_link(a["n"], a["counts"], b["n"], b["counts"], percent)
                yield pair_batch([(a["node"][near], b["node"][near])])

    return run


def told_apart(pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The pairs, each once."""
    if not pairs:
        return []
    both = np.sort(np.stack([np.concatenate(c) for c in zip(*pairs)]), axis=0)
    both = both[:, np.lexsort(both)]
    new = np.concatenate(([True], np.any(both[:, 1:] != both[:, :-1], axis=0)))
    return [(both[0, new], both[1, new])]


def across_roots(percent: int):
    """Of rows by ``center, sig, cell``: pairs with different roots that may
    link; in a cell of two blocks, pairs of both.  Signatures with one center
    name much the same pairs, which are told apart before they leave the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, waiting, center = [], 0, None
        for g in groups_of(batches, ["center", "sig", "cell"]):
            if waiting > MOST_PAIRS or (waiting > MOST_PAIRS // 10 and center != g["center"][0]):
                pairs = told_apart(pairs)
                waiting = sum(len(a) for a, _ in pairs)
                if waiting > MOST_PAIRS // 2 or center != g["center"][0]:
                    yield pair_batch(pairs)
                    pairs, waiting = [], 0
            center = g["center"][0]
            # Along the sizes: a set's partners are not much larger than itself.
            order = np.argsort(g["n"], kind="stable")
            g = {c: v[order] for c, v in g.items()}
            end = np.searchsorted(g["n"], g["n"] * 100 // percent, side="right")
            for i in range(len(order) - 1):
                rest = slice(i + 1, end[i])
                other = g["root"][rest] != g["root"][i]
                if g["mixed"][0]:
                    other &= g["block"][rest] != g["block"][i]
                if other.any():
                    near = other & may_link(g["n"][rest], g["counts"][rest], g["n"][i], g["counts"][i], percent)
                    found = g["node"][rest][near]
                    if len(found):
                        pairs.append((np.full(len(found), g["node"][i]), found))
                        waiting += len(found)
        yield pair_batch(told_apart(pairs))

    return run


def attach(pairs: DataFrame, rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Pairs ``(a, b)`` of keys with both sides' columns; a key of very many pairs is repeated for parts of them."""
    for side, other in (("a", "b"), ("b", "a")):
        few = rows.selectExpr(f"{key} AS {side}", *(f"{c} AS {c}_{side}" for c in columns))
        pairs = split_join(pairs, few, side, "inner", other, hot_keys(row_counts(pairs.select(side), side), side, PAIRS), PAIRS)
    return pairs


def near_by_sets(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = np.zeros(batch.num_rows, dtype=bool)
            for i, (a, b) in enumerate(zip(batch.column("items_a"), batch.column("items_b"))):
                a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
                common_items = len(np.intersect1d(a, b, assume_unique=True))
                near[i] = 100 * common_items >= percent * (len(a) + len(b) - common_items)
            yield pa.RecordBatch.from_arrays([pa.array(batch.column(c).to_numpy()[near]) for c in "ab"], names=["a", "b"])

    return run


def linked(pairs: DataFrame, texts: DataFrame, classes: DataFrame, size: int, percent: int, folder: str) -> DataFrame:
    """The pairs ``(a, b)`` of classes that link."""
    pairs = written(pairs.distinct(), f"{folder}/near")
    nodes = pairs.selectExpr("explode(array(a, b)) AS node").distinct()
    wanted = written(classes.select("node", "key", "key2", "text_key").join(nodes, "node", "left_semi"), f"{folder}/wanted")
    sets = sets_of(texts, size, wanted, f"{folder}/sets")
    near = attach(pairs, sets, "node", ["items"]).select("a", "b", "items_a", "items_b")
    return written(near.mapInArrow(near_by_sets(percent), "a bigint, b bigint"), f"{folder}/linked")


# -------------------------------------------------------------------- the join

def several_rows(stars: DataFrame, classes: DataFrame, folder: str) -> DataFrame:
    """``(sig, node, center)`` of signatures of three classes and more, one of those with the same classes."""
    members = stars.filter("several").select("sig", "key")
    hot = hot_keys(row_counts(members, "key"), "key", PAIRS)
    members = written(split_join(members, classes.select("key", "node"), "key", "inner", "sig", hot, PAIRS).select("sig", "node"), f"{folder}/all")
    groups = members.groupBy("sig").agg(
        F.count(F.lit(1)).alias("size"), F.min("node").alias("center"),
        F.expr("bit_xor(xxhash64(node, 1))").alias("hash"), F.expr("bit_xor(xxhash64(node, 2))").alias("hash2"))
    groups = written(groups.groupBy("size", "center", "hash", "hash2").agg(F.min("sig").alias("sig")).select("sig", "size", "center"), f"{folder}/groups")
    total = groups.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    return written(common.join_to_groups(members, groups, ["sig"], "size", total).select("sig", "node", "center"), f"{folder}/members")


def star_pairs(stars: DataFrame, members: DataFrame, classes: DataFrame, percent: int, folder: str) -> DataFrame:
    """Pairs ``(a, b)`` of a signature's center and another of its classes that may link."""
    alike = classes.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    twos = stars.filter("NOT several").selectExpr("first AS a", "key AS b").distinct()
    twos = written(twos.unionByName(alike.selectExpr("key AS a", "key AS b")), f"{folder}/twos")
    twos = attach(twos, classes, "key", ["node", "n", "counts"])
    others = written(members.filter("node <> center").selectExpr("center AS a", "node AS b").distinct(), f"{folder}/others")
    others = attach(others, classes, "node", ["n", "counts"]).withColumns({"node_a": F.col("a"), "node_b": F.col("b")})
    both = twos.unionByName(others).filter("node_a <> node_b")
    return both.mapInArrow(near_by_counts(percent), "a bigint, b bigint")


def open_rows(members: DataFrame, roots: DataFrame, folder: str) -> tuple[DataFrame, int]:
    """``(sig, node, center, root, size)`` of signatures with classes of different components, and the number of rows."""
    rooted = written(members.join(roots, "node", "left").selectExpr("sig", "node", "center", "coalesce(root, node) AS root"), f"{folder}/rooted")
    open_sigs = rooted.groupBy("sig").agg(F.count(F.lit(1)).alias("size"), F.min("root").alias("low"), F.max("root").alias("high"))
    open_sigs = written(open_sigs.filter("low <> high").select("sig", "size"), f"{folder}/open")
    total = open_sigs.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    rows = common.join_to_groups(rooted, open_sigs, ["sig"], "size", total)
    return written(rows.select("sig", "node", "center", "root", "size"), f"{folder}/members"), total


def other_star_pairs(members: DataFrame, classes: DataFrame, roots: DataFrame, percent: int, turn: int, folder: str) -> DataFrame:
    """As ``star_pairs`` of what is open yet, with a few other centers that many signatures have in common."""
    rows, total = open_rows(members, roots, folder)
    order = f"xxhash64(node, pmod(sig, {STARS}), {turn})"
    stars = written(rows.groupBy("sig", "size").agg(F.expr(f"max(struct({order} AS place, node AS other, root AS other_root))").alias("star"))
                    .select("sig", "size", "star.other", "star.other_root"), f"{folder}/stars")
    met = common.join_to_groups(rows.drop("size"), stars, ["sig"], "size", total).filter("root <> other_root")
    pairs = written(met.selectExpr("least(node, other) AS a", "greatest(node, other) AS b").distinct(), f"{folder}/pairs")
    both = attach(pairs, classes, "node", ["n", "counts"]).withColumns({"node_a": F.col("a"), "node_b": F.col("b")})
    return both.mapInArrow(near_by_counts(percent), "a bigint, b bigint")


def later_pairs(members: DataFrame, classes: DataFrame, roots: DataFrame, percent: int, block: int, folder: str) -> DataFrame:
    """Pairs of one signature whose classes are in different components as yet, and may link."""
    rows, _ = open_rows(members, roots, folder)
    rows = rows.withColumn("blocks", F.expr(f"cast(ceil(size / {block}) AS INT)")).drop("size")
    rows = with_salt(rows, "center", "sig", hot_keys(row_counts(rows, "center"), "center", CENTERS), CENTERS).withColumnRenamed(SALT, "part")
    rows = split_join(rows, classes.select("node", "n", "counts"), "node", "inner", "sig", hot_keys(row_counts(rows, "node"), "node", PAIRS), PAIRS)
    # A set of a large signature goes to the cells of its block and each other one.
    rows = rows.withColumn("block", F.expr("cast(pmod(xxhash64(node), blocks) AS INT)")).selectExpr(
        "center", "part", "sig", "node", "root", "n", "counts", "block", "explode(sequence(0, blocks - 1)) AS met", "blocks").selectExpr(
        "center", "part", "sig", "node", "root", "n", "counts", "block", "block <> met AS mixed", "least(block, met) * blocks + greatest(block, met) AS cell")
    rows = rows.repartition("center", "part", "cell").sortWithinPartitions("center", "sig", "cell").drop("part")
    return rows.mapInArrow(across_roots(percent), "a bigint, b bigint")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 5,
                       percent: int = 80, block: int = BLOCK, folder: str | None = None) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``, the smallest
    identifier that chains of links reach, the row's own included.  The work
    tables go below ``folder``."""
    spark = docs.sparkSession
    folder = folder or work_folder(spark)
    texts = common.rows_of_text(docs, id_col, text_col)
    rows = written(set_rows(common.numbered(texts), words_per_shingle, percent), f"{folder}/keys")
    # Repeated rows first, so that a class of very many rows leaves each task as one.
    classes = written(rows.filter("key IS NOT NULL").groupBy("key", "key2").agg(
        F.min("row_id").alias("node"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n_rows"),
        F.min("n_shingles").alias("n"), F.min("text_key").alias("text_key"), F.min("counts").alias("counts")), f"{folder}/classes")
    total = classes.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]

    signatures = rows.selectExpr("explode(sigs) AS sig", "key").repartition("sig").sortWithinPartitions("sig", "key")
    stars = written(signatures.mapInArrow(star_rows, "sig bigint, first bigint, key bigint, several boolean"), f"{folder}/stars")
    members = several_rows(stars, classes, f"{folder}/several")
    near = star_pairs(stars, members, classes, percent, f"{folder}/star_pairs")
    links = linked(near, texts, classes, words_per_shingle, percent, f"{folder}/star_links")
    roots = written(components(links), f"{folder}/roots")
    for turn in range(TURNS):
        again = other_star_pairs(members, classes, roots, percent, turn, f"{folder}/other_pairs-{turn}")
        links = links.unionByName(linked(again, texts, classes, words_per_shingle, percent, f"{folder}/other_links-{turn}"))
        roots = written(components(links), f"{folder}/other_roots-{turn}")
    later = later_pairs(members, classes, roots, percent, block, f"{folder}/later_pairs")
    links = links.unionByName(linked(later, texts, classes, words_per_shingle, percent, f"{folder}/later_links"))
    roots = written(components(links), f"{folder}/all_roots")

    named = common.component_names(classes.select("key", "key2", "node", "least", "n_rows"), "node", "least", roots, f"{folder}/named")
    rows = rows.select("doc_id", "n_shingles", "key", "key2")
    joined = common.join_to_groups(rows.filter("key IS NOT NULL"), named, ["key", "key2"], "n_rows", total)
    return joined.selectExpr("doc_id", "n_shingles", "name AS component_id").unionByName(
        rows.filter("key IS NULL").selectExpr("doc_id", "n_shingles", "doc_id AS component_id"))
