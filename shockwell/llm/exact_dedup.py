"""Exact duplicates by Patricia-trie owners.

Texts are equal when their bytes are, after lower-casing A-Z alone.  Byte
strings go into compressed radix tries whose terminal nodes own the text: they
hold the identifier that stays and the number of rows.

Two rounds.  First every input partition puts its own rows into a trie, so a
text that a third of all rows share leaves each partition as one row.  Then the
owners are dealt out by length and content hash and meet in the tries of the
second round.  A trie past its memory limit spills a whole subtree: the
terminals below one first byte leave as owners found so far, and a sum per text
(by length and SHA-256) joins what was spilled with what came later.

Defined results: null text counts as empty; a null identifier ranks below all
others; of rows that repeat both identifier and text exactly one stays; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shockwell.llm import common
from shockwell.plans.storage import delete, work_folder, written

#: Bytes of distinct text that one trie may hold before it spills a subtree.
TRIE_BYTES = 64 << 20


def shared_prefix(a: bytes, b: bytes, start: int) -> int:
    """How many bytes of ``a`` equal those of ``b`` from ``start`` on."""
    most = min(len(a), len(b) - start)
    if b.startswith(a[:most], start):
        return most
    low = 0
    while most - low > 1:
        middle = (low + most) // 2
        if b.startswith(a[low:middle], start + low):
            low = middle
        else:
            most = middle
    return low


class Node:
    __slots__ = ("edge", "children", "owner")

    def __init__(self, edge: bytes):
        self.edge, self.children, self.owner = edge, {}, None


class Patricia:
    """Compressed trie of byte strings.  A terminal's owner is a list
    ``[best, rows, extra]``: the greatest rank put there, the number of rows,
    and what came along with that rank."""

    def __init__(self) -> None:
        self.top: dict[int, Node] = {}
        self.empty: list | None = None
        self.held: dict[int, int] = {}

    @property
    def size(self) -> int:
        return sum(self.held.values())

    def put(self, text: bytes, best: tuple, rows: int, extra) -> None:
        if not text:
            self.empty = merged(self.empty, best, rows, extra)
            return
        at, level, first = 0, self.top, text[0]
        while True:
            node = level.get(text[at])
            if node is None:
                node = level[text[at]] = Node(text[at:])
                self.held[first] = self.held.get(first, 0) + len(text) - at + 200
                break
            common_bytes = shared_prefix(node.edge, text, at)
            if common_bytes < len(node.edge):
                lower = node
                node = level[text[at]] = Node(lower.edge[:common_bytes])
                lower.edge = lower.edge[common_bytes:]
                node.children[lower.edge[0]] = lower
                self.held[first] += 200
            at += common_bytes
            if at == len(text):
                break
            level = node.children
        node.owner = merged(node.owner, best, rows, extra)

    def take(self, first: int) -> Iterator[tuple[bytes, list]]:
        """Remove the subtree below a first byte and yield its texts and owners."""
        self.held.pop(first, None)
        stack = [(b"", self.top.pop(first))]
        while stack:
            before, node = stack.pop()
            text = before + node.edge
            if node.owner:
                yield text, node.owner
            stack.extend((text, child) for child in node.children.values())

    def spill(self, limit: int) -> Iterator[tuple[bytes, list]]:
        """Remove the largest subtrees until at most ``limit`` bytes are held."""
        while self.held and self.size > limit:
            yield from self.take(max(self.held, key=self.held.get))

    def rest(self) -> Iterator[tuple[bytes, list]]:
        if self.empty:
            yield b"", self.empty
            self.empty = None
        for first in list(self.top):
            yield from self.take(first)


def merged(owner: list | None, best: tuple, rows: int, extra) -> list:
    if owner is None:
        return [best, rows, extra]
    if best > owner[0]:
        owner[0], owner[2] = best, extra
    owner[1] += rows
    return owner


def rank(doc_id: int | None, row_id: int, largest: bool) -> tuple:
    """Greatest for the row that stays; the first row of equal identifiers."""
    known = doc_id is not None
    value = doc_id if known else 0
    return (known, value if largest else -value, -row_id)


FOUND = pa.schema([
    ("part", pa.string()), ("row_id", pa.int64()), ("doc_id", pa.int64()), ("sha256", pa.string()),
    ("n_bytes", pa.int64()), ("n_rows", pa.int64()), ("content", pa.binary()),
])
FOUND_DDL = "part string, row_id bigint, doc_id bigint, sha256 string, n_bytes bigint, n_rows bigint, content binary"


def found_batches(columns: list[list]) -> Iterator[pa.RecordBatch]:
    if columns[0]:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, FOUND)], schema=FOUND)


def owner_batches(owners: Iterator[tuple[bytes, list]], with_text: bool, step: int = 500) -> Iterator[pa.RecordBatch]:
    """Owners as rows of FOUND, in small batches."""
    columns: list[list] = [[] for _ in FOUND]
    for text, (best, rows, extra) in owners:
        row = ("owner", -best[2], extra[0], extra[1], len(text), rows, text if with_text else None)
        for column, value in zip(columns, row):
            column.append(value)
        if len(columns[0]) == step:
            yield from found_batches(columns)
            columns = [[] for _ in FOUND]
    yield from found_batches(columns)


def local_owners(largest: bool, limit: int):
    """First round: a row for every document, and the partition's owners with their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Patricia()
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                rows = ([], [], [], [], [])
                for doc_id, row_id, raw in zip(part.column("doc_id").to_pylist(), part.column("row_id").to_pylist(),
                                               common.text_bytes(part)):
                    text = raw.lower()  # of bytes: A-Z alone
                    sha = hashlib.sha256(text).hexdigest()
                    trie.put(text, rank(doc_id, row_id, largest), 1, (doc_id, sha))
                    for column, value in zip(rows, (row_id, doc_id, sha, len(text), 1)):
                        column.append(value)
                n = len(rows[0])
                yield from found_batches([["row"] * n, *map(list, rows), [None] * n])
                if trie.size > limit:
                    yield from owner_batches(trie.spill(limit // 2), with_text=True)
        yield from owner_batches(trie.rest(), with_text=True)

    return run


def met_owners(largest: bool, limit: int):
    """Second round: owners of one length and content hash meet in one trie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Patricia()
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                columns = (part.column(c).to_pylist() for c in ("content", "doc_id", "row_id", "n_rows", "sha256"))
                for text, doc_id, row_id, n_rows, sha in zip(*columns):
                    trie.put(text, rank(doc_id, row_id, largest), n_rows, (doc_id, sha))
                if trie.size > limit:
                    yield from owner_batches(trie.spill(limit // 2), with_text=False)
        yield from owner_batches(trie.rest(), with_text=False)

    return run


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest",
                trie_bytes: int = TRIE_BYTES, row_col: str | None = None) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``,
    and with ``row_col``, a number of each row, also ``row_id``.

    ``keep`` tells whether the row with the largest or the smallest identifier
    of a group of equal texts stays.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is largest or smallest")
    largest = keep == "largest"
    folder = work_folder(docs.sparkSession)
    rows = common.rows_of_text(docs, id_col, text_col, row_col)
    rows = rows if row_col else common.numbered(rows)
    found = written(rows.mapInArrow(local_owners(largest, trie_bytes), FOUND_DDL), f"{folder}/found", ("part",))
    local = found.filter("part = 'owner'").withColumn("content_hash", F.xxhash64("content"))
    met = local.repartition("n_bytes", "content_hash").mapInArrow(met_owners(largest, trie_bytes), FOUND_DDL)
    sign = "" if largest else "-"
    order = f"struct(doc_id IS NOT NULL AS known, {sign}doc_id AS ranked, -row_id AS earlier, doc_id AS id)"
    owners = met.groupBy("sha256", "n_bytes").agg(
        F.expr(f"max({order})").alias("best"), F.sum("n_rows").alias("group_size")
    ).selectExpr("sha256", "n_bytes", "best.id AS keep_id", "-best.earlier AS keep_row", "group_size")
    owners = written(owners, f"{folder}/owners")
    delete(docs.sparkSession, f"{folder}/found/part=owner")  # texts that are not read again
    members = found.filter("part = 'row'").select("row_id", "doc_id", "sha256", "n_bytes")
    joined = common.join_to_groups(members, owners, ["sha256", "n_bytes"], "group_size", members.count())
    return joined.selectExpr("doc_id", "keep_id", "group_size", "row_id = keep_row AS kept", "sha256 AS text_sha256",
                             *(["row_id"] if row_col else []))
