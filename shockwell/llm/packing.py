"""Packing by vector bin packing with the dot-product heuristic.

A sequence has three limits: tokens, segments and loss-bearing tokens.  It is
filled one example at a time: of the waiting examples that still fit, the one
whose demand has the greatest dot product with the remaining room, both as
shares of the limits and weighted by how much of each limit the waiting
examples ask for.

Every task packs the rows of its own input partition from a pool of waiting
examples, so packing needs no shuffle and no task holds more than its pool;
sequence ids carry the partition's number.

``pack_examples`` keeps examples whole (instruction data must not be cut).
``pack_documents`` may cut: what no waiting piece fills is filled by cutting
one, and a partition's last, short sequence is cut at powers of two, which need
no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shockwell.llm import common, tokens

#: Examples waiting in a task's pool before sequences are closed, and those
#: kept waiting for the next rows.
POOL, KEPT = 4096, 1024
#: Ids of the pieces that a task hands on together.
BATCH_IDS = 1 << 18
#: Demand of an example that is placed: more than any limit.
PLACED = 1e18
#: Bits of a sequence id below the partition's number.
LOCAL_BITS = 36


@dataclass(frozen=True)
class Limits:
    """Most tokens, segments and loss-bearing tokens of one sequence."""

    tokens: int = 2048
    segments: int = 64
    loss_tokens: int = 2048

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.segments, self.loss_tokens], dtype=np.float64)


class Pool:
    """Waiting examples of one task: their demands and what belongs to them."""

    def __init__(self, limits: Limits):
        self.limit = limits.vector()
        self.demands, self.items = np.zeros((0, 3)), []

    def add(self, demands: np.ndarray, items: list) -> None:
        self.demands = np.vstack([self.demands, demands])
        self.items.extend(items)

    def weights(self) -> np.ndarray:
        asked = (self.demands / self.limit).sum(axis=0)
        return asked / max(asked.max(), 1e-12)

    def sequences(self, keep: int, cut=None):
        """Fill sequences until at most ``keep`` examples wait; yields the items of each.

        ``cut(item, n)`` splits an item of ``n`` tokens or more into the first
        ``n`` and the rest; with it, sequences are filled up exactly.
        """
        if len(self.items) <= keep:
            return
        pull = self.weights() / self.limit ** 2  # both as shares of the limits
        # A column per limit; an example that is placed asks for more than there can be.
        columns = [np.ascontiguousarray(c) for c in self.demands.T]
        tokens_, segments, loss = columns
        waiting = len(self.items)
        while waiting > keep:
            room, chosen = self.limit.tolist(), []
            while True:
                score = self.scores(columns, pull, room)
                score[(tokens_ > room[0]) | (segments > room[1]) | (loss > room[2])] = -1.0
                best = int(score.argmax())
                if score[best] < 0:
                    break
                chosen.append(self.items[best])
                room = [r - float(c[best]) for r, c in zip(room, columns)]
                tokens_[best] = PLACED
                waiting -= 1
            gap = int(min(room[0], room[2]))
            if cut and waiting and gap >= 1 and room[1] >= 1:
                best = int(np.where(tokens_ == PLACED, -1.0, self.scores(columns, pull, room)).argmax())
                first, self.items[best] = cut(self.items[best], gap)
                tokens_[best] -= gap
                loss[best] -= gap
                chosen.append(first)
            yield chosen
            if 2 * waiting < len(tokens_):
                there = tokens_ < PLACED
                columns = tokens_, segments, loss = [c[there] for c in columns]
                self.items = [self.items[k] for k in np.flatnonzero(there).tolist()]
        there = tokens_ < PLACED
        self.demands = np.column_stack(columns)[there]
        self.items = [self.items[k] for k in np.flatnonzero(there).tolist()]

    @staticmethod
    def scores(columns: list[np.ndarray], pull: np.ndarray, room: list[float]) -> np.ndarray:
        """Dot product of each demand with the remaining room."""
        total = columns[0] * (pull[0] * room[0])
        for c, p, r in zip(columns[1:], pull[1:], room[1:]):
            total += c * (p * r)
        return total


def first_sequence() -> int:
    return TaskContext.get().partitionId() << LOCAL_BITS


def pack_examples(examples: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id",
                  tokens_col: str = "n_tokens", loss_col: str = "n_loss_tokens") -> DataFrame:
    """Whole examples: ``(doc_id, n_tokens, n_loss_tokens, sequence_id, offset, fits)``.

    An example beyond a limit of its own cannot be placed: ``fits`` is false
    and it has no sequence.  Null counts are 0; an example without tokens still
    uses a segment.
    """
    rows = examples.select(F.col(id_col).cast("bigint").alias("doc_id"), *(
        F.coalesce(F.col(c).cast("bigint"), F.lit(0)).alias(n) for c, n in ((tokens_col, "n_tokens"), (loss_col, "n_loss_tokens"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool, sequence = Pool(limits), first_sequence()

        def packed(keep: int) -> list[tuple]:
            nonlocal sequence
            out = []
            for chosen in pool.sequences(keep):
                offset = 0
                for doc_id, n, loss in chosen:
                    out.append((doc_id, n, loss, sequence, offset, True))
                    offset += n
                sequence += 1
            return out

        for batch in batches:
            for start in range(0, batch.num_rows, POOL):
                part = batch.slice(start, POOL)
                items = list(zip(*(part.column(c).to_pylist() for c in ("doc_id", "n_tokens", "n_loss_tokens"))))
                demands = np.array([(n, 1, loss) for _, n, loss in items], dtype=float)
                fits = (demands <= pool.limit).all(axis=1).tolist()
                pool.add(demands[fits], [i for i, ok in zip(items, fits) if ok])
                unplaced = [(*i, None, None, False) for i, ok in zip(items, fits) if not ok]
                yield from batches_of(unplaced + packed(KEPT), EXAMPLES)
        yield from batches_of(packed(0), EXAMPLES)

    return rows.mapInArrow(run, "doc_id bigint, n_tokens bigint, n_loss_tokens bigint, sequence_id bigint, "
                                "offset bigint, fits boolean")


EXAMPLES = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_loss_tokens", pa.int64()),
                      ("sequence_id", pa.int64()), ("offset", pa.int64()), ("fits", pa.bool_())])
PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                    ("ids", pa.binary())])
PIECES_DDL = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
              "offset bigint, ids binary")


def powers_of_two(n: int, least: int) -> list[int]:
    """``n`` cut into falling powers of two; what is below ``least`` stays one piece."""
    out = []
    while n >= least:
        out.append(1 << (n.bit_length() - 1))
        n -= out[-1]
    return out + [n] if n else out


def batches_of(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def in_batches(pieces: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows of PIECES as they come, some at a time."""
    waiting, n = [], 0
    for row in pieces:
        waiting.append(row)
        n += row[2]
        if n >= BATCH_IDS:
            yield from batches_of(waiting, PIECES)
            waiting, n = [], 0
    yield from batches_of(waiting, PIECES)


def piece(item: tuple, sequence: int, offset: int) -> tuple:
    """A row of PIECES from an item ``(doc_id, doc_tokens, start, ids)``."""
    doc_id, n, start, ids = item
    return doc_id, start, len(ids) // 4, zlib.crc32(ids), n, sequence, offset, bytes(ids)


def cut(item: tuple, n: int) -> tuple[tuple, tuple]:
    doc_id, doc_tokens, start, ids = item
    return (doc_id, doc_tokens, start, ids[:4 * n]), (doc_id, doc_tokens, start + n, ids[4 * n:])


def in_powers(items: list[tuple], least: int) -> Iterator[list[tuple]]:
    """The items of a short sequence as sequences whose lengths are powers of two."""
    sizes = powers_of_two(sum(len(i[3]) // 4 for i in items), least)
    chosen, room = [], sizes.pop(0)
    for item in items:
        while len(item[3]) // 4 >= room:
            first, item = cut(item, room)
            yield chosen + [first]
            chosen, room = [], sizes.pop(0) if sizes else 1
        if item[3]:
            chosen.append(item)
            room -= len(item[3]) // 4


#: A piece has one token at least, so short texts never close a sequence of documents early.
DOCUMENT_LIMITS = Limits(segments=Limits.tokens)


def pack_documents(docs: DataFrame, limits: Limits = DOCUMENT_LIMITS, tokenizer: str | None = None, end_id: int = 1,
                   id_col: str = "doc_id", text_col: str = "text", least_power: int = 1) -> DataFrame:
    """Texts, encoded and cut freely, in sequences: a row per piece with its ids.

    Every token of a document bears loss, its end id included.  Null text is
    empty: the document is its end id alone.  Repeated rows are packed each for
    themselves; an empty table gives an empty result.  Ids of a piece are in
    ``ids``, little-endian unsigned 32-bit.  Lengths of sequences are padded to
    the limit unless they are powers of two; a partition's last sequence is cut
    into powers down to ``least_power``.
    """
    path = tokenizer or tokens.default_path()
    end = np.array([end_id], dtype="<u4").tobytes()
    if min(limits.tokens, limits.segments, limits.loss_tokens) < 1:
        raise ValueError("limits are at least 1")
    most = min(limits.tokens, limits.loss_tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool, sequence = Pool(limits), first_sequence()

        def pieces(sequences) -> Iterator[tuple]:
            nonlocal sequence
            for chosen in sequences:
                offset = 0
                for item in chosen:
                    yield piece(item, sequence, offset)
                    offset += len(item[3]) // 4
                sequence += 1

        def add(doc_ids: list, texts: list[str]) -> Iterator[tuple]:
            """Full sequences from within long documents at once; remainders to the pool."""
            rest = []
            for doc_id, ids in zip(doc_ids, tokens.encode_slices(path, texts, special_as_text=False)):
                item = (doc_id, len(ids) // 4 + 1, 0, memoryview(ids + end))  # cut without copying the rest
                while len(item[3]) // 4 >= most:
                    first, item = cut(item, most)
                    yield from pieces([[first]])
                if item[3]:
                    rest.append((*item[:3], bytes(item[3])))
            lengths = np.array([len(i[3]) // 4 for i in rest], dtype=float)
            pool.add(np.column_stack([lengths, np.ones(len(rest)), lengths]), rest)

        for batch in batches:
            for start in range(0, batch.num_rows, POOL):
                part = batch.slice(start, POOL)
                yield from in_batches(add(part.column("doc_id").to_pylist(), part.column("text").to_pylist()))
                yield from in_batches(pieces(pool.sequences(KEPT, cut)))
        for chosen in pool.sequences(0, cut):
            full = sum(len(i[3]) // 4 for i in chosen) == most
            yield from batches_of(list(pieces([chosen] if full else in_powers(chosen, least_power))), PIECES)

    return common.rows_of_text(docs, id_col, text_col).mapInArrow(run, PIECES_DDL)
