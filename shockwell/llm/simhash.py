"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint has 64 bits; two link if at most three bits differ.  Cut in two
halves, one half of a linked pair then differs by at most one bit.  So each
half is indexed as it is and with one bit deleted (a wildcard), for each of its
32 bits; fingerprints that meet under a key are compared in full.  For a
wildcard key one side has the deleted bit 0 and the other 1, so a pair meets
once per half instead of under every wildcard.

Only distinct fingerprints are indexed; equal ones are one class from the
start, however many documents share it.  Halves that very many different
fingerprints share would compare all of their pairs.  Their keys are cut again
(two quarters of the other half, with wildcards), which loses no pair: the
other half differs by at most three bits, so one of its quarters by at most
one.  Components come from alternating large-star and small-star steps on the
links, each step stored in shared storage.

Defined results: null or blank text has fingerprint zero and links like any
other; fewer words than a shingle are one shingle; a null identifier never
becomes a component's name unless the component has no other; repeated rows are
rows of one class; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shockwell.llm import common
from shockwell.plans.storage import work_folder, written

HALF = 32
SEED = 42
#: A half shared by more distinct fingerprints than this is cut again.
CROWDED = 512


def fingerprint(text: bytes, words_per_shingle: int = 3) -> int:
    """The 64-bit SimHash of a text as an unsigned number."""
    words = text.lower().split()  # of bytes: A-Z and the six ASCII blanks alone
    if not words:
        return 0
    n = max(1, len(words) - words_per_shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:n - 1])).tolist()
    stops = (ends[-n:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops)], dtype=">u8")
    votes = np.zeros(64, dtype=np.int64)
    for start in range(0, n, 65536):
        bits = np.unpackbits(hashes[start:start + 65536].view(np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n).view(">u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3,
                 row_col: str | None = None) -> DataFrame:
    """``(doc_id, row_id, fp)``, a row per input row; ``fp`` holds the 64 bits as a signed bigint."""
    texts = common.rows_of_text(docs, id_col, text_col, row_col)

    def rows(columns: dict[str, list]) -> dict[str, list]:
        found = np.array([fingerprint(t, words_per_shingle) for t in columns["text"]], dtype=np.uint64)
        return {"doc_id": columns["doc_id"], "row_id": columns["row_id"], "fp": found.view(np.int64)}

    arrow = pa.schema([("doc_id", pa.int64()), ("row_id", pa.int64()), ("fp", pa.int64())])
    return common.map_texts(texts if row_col else common.numbered(texts), "doc_id bigint, row_id bigint, fp bigint", arrow, rows)


# Half 0 is the upper one.  A key is the half's number, one more than the
# deleted bit (0: none), and the remaining value, in one bigint.
def half(h: int, fp: str = "fp") -> str:
    return f"(shiftrightunsigned({fp}, {HALF * (1 - h)}) & {(1 << HALF) - 1}L)"


def plain_keys(h: int) -> str:
    return f"array({h << 40}L | {half(h)})"


def wildcard_keys(h: int, bit: int | None = None) -> str:
    """Keys with one bit deleted; only those whose deleted bit has that value."""
    keys = f"sequence(0, {HALF - 1})"
    if bit is not None:
        keys = f"filter({keys}, w -> (shiftright({half(h)}, w) & 1L) = {bit})"
    return f"transform({keys}, w -> {h << 40}L | shiftleft(cast(w + 1 AS BIGINT), {HALF}) | ({half(h)} & ~shiftleft(1L, w)))"


def keyed(classes: DataFrame, bit: int) -> DataFrame:
    """``(key, fp)``: both halves as they are, and the variants with the deleted bit at ``bit``.

    Some 34 rows for each class, while Spark sizes what leaves an explode like
    what goes in: a join of two such tables has to say that it is no broadcast.
    """
    parts = [k for h in (0, 1) for k in (plain_keys(h), wildcard_keys(h, bit))]
    return classes.selectExpr("fp", f"explode(concat({', '.join(parts)})) AS key")


def crowded_keys(classes: DataFrame, limit: int) -> DataFrame:
    """Keys below which a half with more than ``limit`` distinct fingerprints falls."""
    values = classes.selectExpr("fp", f"explode(array({half(0)}, {half(1) } | {1 << HALF}L)) AS v")
    many = values.groupBy("v").count().filter(F.col("count") > limit)
    keys = f"""concat(array(shiftleft(shiftright(v, {HALF}), 40) | (v & {(1 << HALF) - 1}L)),
        transform(sequence(0, {HALF - 1}), w -> shiftleft(shiftright(v, {HALF}), 40)
            | shiftleft(cast(w + 1 AS BIGINT), {HALF}) | (v & {(1 << HALF) - 1}L & ~shiftleft(1L, w))))"""
    return many.selectExpr(f"explode({keys}) AS key").distinct()


def quarter_keys() -> str:
    """Of the half that the key does not hold: its two quarters, plain and with
    a bit deleted, each with the bit that was deleted (plain: -1)."""
    other = f"(shiftrightunsigned(fp, cast(if(shiftright(key, 40) = 0, 0, {HALF}) AS INT)) & {(1 << HALF) - 1}L)"
    parts = []
    for q in (0, 1):
        value = f"(shiftright({other}, {16 * q}) & 65535L)"
        parts.append(f"array(struct({q << 40}L | {value} AS quarter, -1L AS bit))")
        parts.append(f"""transform(sequence(0, 15), w -> struct(
            {q << 40}L | shiftleft(cast(w + 1 AS BIGINT), 16) | ({value} & ~shiftleft(1L, w)) AS quarter,
            shiftright({value}, w) & 1L AS bit))""")
    return f"concat({', '.join(parts)})"


def links(classes: DataFrame, distance: int = 3, crowded: int = CROWDED) -> DataFrame:
    """``(a, b)`` with ``a < b``: all pairs of distinct fingerprints at most
    ``distance`` (three at most) bits apart.  ``classes`` has each ``fp`` once
    and should be stored."""
    if not 0 <= distance <= 3:
        raise ValueError("two halves with one deleted bit find up to three differing bits")
    near = f"bit_count(l.fp ^ r.fp) <= {distance} AND l.fp <> r.fp"
    low, high = keyed(classes, 0), keyed(classes, 1)
    many = written(crowded_keys(classes, crowded), f"{work_folder(classes.sparkSession)}/crowded")
    is_crowded = not many.isEmpty()
    if is_crowded:
        low, high = low.join(many, "key", "left_anti"), high.join(many, "key", "left_anti")
    pair = ("least(l.fp, r.fp) AS a", "greatest(l.fp, r.fp) AS b")
    found = low.alias("l").hint("merge").join(high.alias("r"), F.expr(f"l.key = r.key AND {near}")).selectExpr(*pair)
    if is_crowded:
        cut = [keyed(classes, bit).join(many, "key", "left_semi").selectExpr("fp", "key", f"inline({quarter_keys()})")
               for bit in (0, 1)]
        again = cut[0].alias("l").hint("merge").join(cut[1].alias("r"), F.expr(
            f"l.key = r.key AND l.quarter = r.quarter AND (l.bit = -1 OR l.bit <> r.bit) AND {near}"))
        found = found.unionByName(again.selectExpr(*pair))
    return found.distinct()


def components(pairs: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``pairs(a, b)``; the root is the component's smallest node.

    Alternates large-star (larger neighbours move to the smallest of the
    neighbourhood) and small-star (smaller ones do) until the links no longer
    change; the number of rounds grows with the logarithm of the size.
    """
    folder = work_folder(pairs.sparkSession)
    edges = written(pairs.selectExpr("greatest(a, b) AS u", "least(a, b) AS v").filter("u <> v").distinct(), f"{folder}/links-0")

    def state(e: DataFrame) -> tuple:
        return tuple(e.selectExpr("count(1)", "bit_xor(xxhash64(u, v))", "sum(cast(xxhash64(v, u) AS DECIMAL(38, 0)))").first())

    before, step = state(edges), 0
    while True:
        step += 1
        both = edges.unionByName(edges.selectExpr("v AS u", "u AS v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
        large = both.filter("v > u").join(least, "u").selectExpr("v AS u", "m AS v").filter("u <> v").distinct()
        large = written(large, f"{folder}/large-{step}")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").selectExpr("explode(array(struct(v AS u, m AS v), struct(u AS u, m AS v))) AS e")
        edges = written(small.select("e.*").filter("u <> v").distinct(), f"{folder}/links-{step}")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.selectExpr("u AS node", "v AS root").unionByName(edges.selectExpr("v AS node", "v AS root").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3,
                    distance: int = 3, crowded: int = CROWDED, row_col: str | None = None) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint, component_id, kept``, and
    with ``row_col``, a number of each row, also ``row_id``.

    ``component_id`` is the smallest identifier that chains of links reach, the
    row's own included.  One row of each component is ``kept``: the one with
    that identifier, of several the one with the smallest row number.
    """
    folder = work_folder(docs.sparkSession)
    rows = written(fingerprints(docs, id_col, text_col, words_per_shingle, row_col), f"{folder}/fingerprints")
    classes = written(rows.groupBy("fp").agg(F.expr("min(struct(doc_id IS NULL AS unnamed, doc_id, row_id))").alias("least"), F.count(F.lit(1)).alias("n_rows")), f"{folder}/classes")
    found = written(links(classes, distance, crowded), f"{folder}/pairs")
    roots = components(found)
    in_component = classes.join(roots, classes.fp == roots.node, "left").selectExpr("fp", "n_rows", "least", "coalesce(root, fp) AS root")
    named = in_component.groupBy("root").agg(F.min("least").alias("first"))
    groups = written(in_component.join(named, "root").select("fp", "n_rows", "first"), f"{folder}/groups")
    total = groups.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
    joined = common.join_to_groups(rows, groups, ["fp"], "n_rows", total)
    return joined.selectExpr("doc_id", "lower(lpad(hex(fp), 16, '0')) AS fingerprint", "first.doc_id AS component_id",
                             "row_id = first.row_id AS kept", *(["row_id"] if row_col else []))
