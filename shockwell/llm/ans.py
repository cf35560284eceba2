"""Token ids in a binary format: static range asymmetric numeral systems (rANS).

One table of frequencies, counted over all ids, serves every block, so blocks
are independent of each other.  Within a block, lane ``i`` takes the ids at
places ``i, i + lanes, ...``; numpy steps all lanes at once.  A block starts
with checkpoints, the lanes' states and the place in the word stream at regular
steps, each with a checksum of the ids up to the next one, so that the parts
of a block can be decoded apart from each other and in parallel.

A block in bytes, all numbers little-endian:

    magic "RANS", version u16, scale bits u16, table id u32, lanes u32, steps per checkpoint u32,
    checkpoints u32, ids u64, words u64, CRC-32 of all that follows u32,
    per checkpoint: first word u64, CRC-32 of its ids u32; per checkpoint and lane: state u64; words u32 each

Files are tables of blocks (``part, block, first_place, doc_ids, lengths,
payload``) in ascending order of identifiers; a block holds whole documents.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shockwell.llm import common, tokens
from shockwell.plans.storage import delete, work_folder, written

HEADER = struct.Struct("<4sHHIIIIQQI")
MAGIC, VERSION = b"RANS", 1
SCALE_BITS = 20
LANES = 4096
STEPS_PER_CHECKPOINT = 128
#: Ids after which a block is closed; the document that reaches the number is still in it.
BLOCK_IDS = 1 << 20
LOWEST = np.uint64(1 << 31)
WORD_BITS = np.uint64(32)


@dataclass
class Table:
    """Shared frequencies: ``2 ** bits`` slots over the ids, each id that occurs with one at least."""

    frequency: np.ndarray
    bits: int = SCALE_BITS

    def __post_init__(self):
        self.frequency = np.asarray(self.frequency, dtype=np.uint32)
        self.id = zlib.crc32(self.frequency.tobytes())
        self.f = self.frequency.astype(np.uint64)
        self.start = np.concatenate(([0], np.cumsum(self.f)[:-1])).astype(np.uint64)
        self._slots: np.ndarray | None = None

    @property
    def slots(self) -> np.ndarray:
        """The id of each slot; only decoding needs it."""
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.f), dtype=np.uint32), self.frequency)
        return self._slots

    @classmethod
    def of(cls, counts: np.ndarray, bits: int = SCALE_BITS) -> Table:
        """Counts scaled to the slots, at least one for an id that occurs; what rounding leaves goes to the commonest."""
        counts = np.asarray(counts, dtype=np.int64)
        there, slots = counts > 0, 1 << bits
        if there.sum() > slots:
            raise ValueError("more ids than slots; use more bits")
        if not there.any():
            return cls(np.zeros(len(counts)), bits)
        spare = slots - int(there.sum())
        scaled = np.floor(counts * (spare / counts.sum())).astype(np.int64) + there
        scaled[int(scaled.argmax())] += slots - int(scaled.sum())
        return cls(scaled, bits)


def encode(ids: np.ndarray, table: Table, lanes: int = LANES, steps_per_checkpoint: int = STEPS_PER_CHECKPOINT) -> bytes:
    """A block of ids as bytes."""
    n = len(ids)
    lanes = max(1, min(lanes, n))
    steps = -(-n // lanes)
    state = np.full(lanes, LOWEST, dtype=np.uint64)
    if n and not table.f[ids].all():
        raise ValueError("an id that the table has no slot for")
    shift, bits = np.uint64(63 - table.bits), np.uint64(table.bits)
    words, counts = [], np.zeros(steps, dtype=np.int64)
    states = []
    for s in range(steps - 1, -1, -1):
        here = ids[s * lanes:(s + 1) * lanes]
        fs = table.f[here]
        x = state[:len(fs)]
        full = np.flatnonzero(x >= (fs << shift))
        out = x[full]
        words.append(out.astype(np.uint32))
        counts[s] = len(out)
        x[full] = out >> WORD_BITS
        q = x // fs
        # (q << bits) + x % fs + start, with one division
        x += (q << bits) - q * fs
        x += table.start[here]
        if s % steps_per_checkpoint == 0:
            states.append(state.copy())
    words.reverse()
    states.reverse()
    stream = np.concatenate(words).astype("<u4") if words else np.zeros(0, dtype="<u4")
    before = np.concatenate(([0], np.cumsum(counts)))
    span = steps_per_checkpoint * lanes
    raw = np.ascontiguousarray(ids, dtype="<u4")
    index = b"".join(struct.pack("<QI", int(before[k * steps_per_checkpoint]), zlib.crc32(raw[k * span:(k + 1) * span]))
                     for k in range(len(states)))
    body = index + b"".join(s.astype("<u8").tobytes() for s in states) + stream.tobytes()
    return HEADER.pack(MAGIC, VERSION, table.bits, table.id, lanes, steps_per_checkpoint, len(states), n, len(stream),
                       zlib.crc32(body)) + body


class Block:
    """A block's bytes, checked, with its parts ready to be decoded."""

    def __init__(self, payload: bytes | memoryview, table: Table):
        magic, version, bits, table_id, self.lanes, self.steps, self.checkpoints, self.n, n_words, crc = HEADER.unpack_from(payload)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a block of this format")
        if bits != table.bits or table_id != table.id:
            raise ValueError("the block belongs to another table")
        body = memoryview(payload)[HEADER.size:]
        if zlib.crc32(body) != crc:
            raise ValueError("the block's checksum does not match")
        self.table = table
        self.index = [struct.unpack_from("<QI", body, 12 * k) for k in range(self.checkpoints)]
        at = 12 * self.checkpoints
        self.states = np.frombuffer(body, "<u8", self.checkpoints * self.lanes, at).reshape(self.checkpoints, self.lanes)
        self.words = np.frombuffer(body, "<u4", n_words, at + 8 * self.checkpoints * self.lanes)

    def part(self, k: int) -> np.ndarray:
        """Ids from checkpoint ``k`` up to the next, checked against their checksum."""
        span = self.steps * self.lanes
        n = min(span, self.n - k * span)
        out = np.empty(n, dtype=np.uint32)
        x_all, at = self.states[k].astype(np.uint64), self.index[k][0]
        bits, mask, slots = np.uint64(self.table.bits), np.uint64((1 << self.table.bits) - 1), self.table.slots
        f, start = self.table.f, self.table.start
        for first in range(0, n, self.lanes):
            x = x_all[:min(self.lanes, n - first)]
            slot = x & mask
            ids = slots.take(slot)
            out[first:first + len(x)] = ids
            x >>= bits
            x *= f.take(ids)
            x += slot
            x -= start.take(ids)
            short = np.flatnonzero(x < LOWEST)
            x[short] = (x[short] << WORD_BITS) | self.words[at:at + len(short)]
            at += len(short)
        if zlib.crc32(out.astype("<u4", copy=False)) != self.index[k][1]:
            raise ValueError("the part's checksum does not match")
        return out

    def ids(self) -> np.ndarray:
        return np.concatenate([self.part(k) for k in range(self.checkpoints)]) if self.checkpoints else np.zeros(0, np.uint32)


TOKENS = pa.schema([("kind", pa.string()), ("part", pa.int32()), ("block", pa.int32()), ("first_place", pa.int64()),
                    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("payload", pa.binary())])
TOKENS_DDL = ("kind string, part int, block int, first_place bigint, doc_ids array<bigint>, lengths array<bigint>, "
              "payload binary")


def token_blocks(docs: DataFrame, path: str, end_id: int, block_ids: int) -> DataFrame:
    """Blocks of raw ids (``kind = 'ids'``) in ascending order of identifiers,
    and per task how often each id occurs in them (``kind = 'counts'``, the ids in
    ``doc_ids`` and their numbers in ``lengths``).

    Identifiers are dealt out by range; text and row number come after them in
    the order, so rows of one identifier can be dealt to several tasks too.
    """
    end = np.array([end_id], dtype="<u4").tobytes()
    order = ["doc_id", "tie", "row_id"]
    ordered = common.numbered(docs).withColumn("tie", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order)

    def row_of(*values) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, TOKENS)], schema=TOKENS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, place = TaskContext.get().partitionId(), 0, 0
        doc_ids, found, waiting = [], [], 0
        seen = np.zeros(0, dtype=np.int64)

        def closed() -> pa.RecordBatch:
            nonlocal block, place, doc_ids, found, waiting, seen
            lengths = [len(f) // 4 for f in found]
            ids = np.frombuffer(b"".join(found), "<u4")
            times = np.bincount(ids, minlength=len(seen))
            times[:len(seen)] += seen
            seen = times
            row = row_of("ids", part, block, place, doc_ids, lengths, packed(ids))
            block, place, doc_ids, found, waiting = block + 1, place + waiting, [], [], 0
            return row

        for batch in batches:
            encoded = tokens.encode_slices(path, batch.column("text").to_pylist(), special_as_text=False)
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded):
                doc_ids.append(doc_id)
                found.append(ids + end)
                waiting += len(ids) // 4 + 1
                if waiting >= block_ids:
                    yield closed()
        if doc_ids:
            yield closed()
        if len(seen):
            there = np.flatnonzero(seen)
            yield row_of("counts", part, None, None, there.tolist(), seen[there].tolist(), None)

    return ordered.select("doc_id", "text").mapInArrow(run, TOKENS_DDL)


def packed(ids: np.ndarray) -> bytes:
    """Raw ids between the passes: a width in bytes, then the ids."""
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    return bytes([width]) + ids.astype(f"<u{width}").tobytes()


def unpacked(buffer) -> np.ndarray:
    raw = memoryview(buffer)
    return np.frombuffer(raw[1:], f"<u{raw[0]}")


def counts_of(counted: DataFrame) -> np.ndarray:
    """How often each id occurs in all blocks; the driver sees a row per id of the vocabulary.

    A task adds up the counts of all the writing tasks it reads before it hands them on.
    """

    def add(batches):
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for ids, times in zip(batch.column("doc_ids"), batch.column("lengths")):
                ids, times = ids.values.to_numpy(), times.values.to_numpy()
                if len(ids) and ids[-1] >= len(total):
                    total = np.concatenate((total, np.zeros(ids[-1] + 1 - len(total), dtype=np.int64)))
                total[ids] += times
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["id", "n"])

    pairs = counted.select("doc_ids", "lengths").mapInArrow(add, "id bigint, n bigint")
    rows = pairs.groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(max((r.id for r in rows), default=-1) + 1, dtype=np.int64)
    for r in rows:
        out[r.id] = r.n
    return out


def on_payload(change):
    """A function over batches that changes only the payload column, row by row."""

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("payload")
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                payload = pa.array([change(row.column(at)[0].as_buffer())], pa.binary())
                yield pa.RecordBatch.from_arrays([*(c if i != at else payload for i, c in enumerate(row.columns))], names=batch.schema.names)

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 0, id_col: str = "doc_id",
                 text_col: str = "text", block_ids: int = BLOCK_IDS) -> Table:
    """Encode texts and write ``path/blocks`` and ``path/table``; returns the table.

    Every document ends with ``end_id``.  Null text is empty: the document is
    its end id alone.  Null identifiers come first; repeated rows are written
    each; an empty table writes no blocks.
    """
    spark = docs.sparkSession
    raw_path = f"{path}/raw"
    raw = written(token_blocks(common.rows_of_text(docs, id_col, text_col), tokenizer or tokens.default_path(), end_id, block_ids),
                  raw_path, ("kind",))
    table = Table.of(counts_of(raw.filter("kind = 'counts'")))
    raw = raw.filter("kind = 'ids'")
    write_table(spark, table, f"{path}/table")
    shared = spark.sparkContext.broadcast(table.frequency)  # as long as the vocabulary
    bits = table.bits

    def compress(buffer) -> bytes:
        return encode(unpacked(buffer), table_of(shared.value, bits))

    written(raw.mapInArrow(on_payload(compress), TOKENS_DDL), f"{path}/blocks", compression="uncompressed")
    delete(spark, raw_path)
    return table


_tables: dict[int, Table] = {}


def table_of(frequency: np.ndarray, bits: int) -> Table:
    """The worker's table for given frequencies."""
    key = zlib.crc32(frequency.tobytes())
    if key not in _tables:
        _tables.clear()
        _tables[key] = Table(frequency, bits)
    return _tables[key]


def write_table(spark: SparkSession, table: Table, path: str) -> None:
    """A single row: a table has a slot count per id of the vocabulary."""
    spark.createDataFrame([(table.bits, table.frequency.astype("<u4").tobytes())], "bits int, frequency binary").coalesce(1).write.parquet(path)


def read_table(spark: SparkSession, path: str) -> Table:
    row = spark.read.parquet(path).first()
    return Table(np.frombuffer(row.frequency, "<u4"), row.bits)


def decoder(spark: SparkSession, path: str) -> Callable[[pa.Buffer], np.ndarray]:
    """A function that tasks can use: ids of a block's bytes."""
    table = read_table(spark, f"{path}/table")
    shared, bits = spark.sparkContext.broadcast(table.frequency), table.bits
    return lambda buffer: Block(memoryview(buffer), table_of(shared.value, bits)).ids()


def stored_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOKENS_DDL).parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with their payload decoded to raw ids, little-endian unsigned 32-bit."""
    decode = decoder(spark, path)
    expand = on_payload(lambda buffer: decode(buffer).astype("<u4", copy=False).tobytes())
    return stored_blocks(spark, path).mapInArrow(expand, TOKENS_DDL)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the decoded blocks."""
    decode = decoder(spark, path)
    schema = pa.schema([("part", pa.int32()), ("place", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("part", "first_place", "doc_ids", "lengths")), batch.column("payload")):
                part, first, doc_ids, lengths, payload = row
                raw = memoryview(decode(payload.as_buffer()).astype("<u4", copy=False)).cast("B")
                ends = np.cumsum(lengths)
                begins = ends - lengths
                sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                columns = ([part] * len(doc_ids), begins + first, doc_ids, lengths, sums)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    found = stored_blocks(spark, path).mapInArrow(run, "part int, place bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint")
    return found.join(F.broadcast(part_starts(spark, path)), "part").selectExpr(
        "doc_id", "part_start + place AS start", "n_tokens", "ids_crc32")


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """Where each part starts among all ids: a row per part, of which a file set has as many as the writing job had tasks."""
    totals = stored_blocks(spark, path).groupBy("part").agg(F.expr("max_by(first_place + aggregate(lengths, 0L, (a, n) -> a + n), block)").alias("n"))
    rows, start = [], 0
    for r in sorted(totals.collect(), key=lambda r: r.part):
        rows.append((r.part, start))
        start += r.n
    return spark.createDataFrame(rows, "part int, part_start bigint")


def round_trip(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the documents' ids, read the files back, and tell each document's place, length and checksum from them."""
    spark = docs.sparkSession
    path = f"{work_folder(spark)}/tokens"
    write_tokens(docs, path, tokenizer, end_id, id_col, text_col)
    return read_documents(spark, path)
