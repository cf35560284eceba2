"""Token counts from flat, unindexed token files.

A flat file is nothing but ids, one document after the other, each closed by an
end-of-document id.  It is cut into blocks of any size without regard to
documents.  Each block is searched for the end id with numpy; what a block
cannot know, where its first document began and the number of its first
document, comes from a prefix scan over block summaries.

The scan has two levels, so no task sees all blocks of a file: first within
runs of consecutive blocks, then over one row per run.

Defined results: ids after a file's last end id are a document that is not
``terminated``; two end ids in a row close an empty document; blocks may be
empty; a file without ids has no documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shockwell.llm import common, tokens
from shockwell.plans.storage import work_folder, written

#: Ids per block and consecutive blocks per run of the prefix scan.
BLOCK_IDS = 1 << 20
RUN_BLOCKS = 4096
WIDTHS = {2: "<u2", 4: "<u4"}

SUMMARY = pa.schema([("file", pa.string()), ("block", pa.int64()), ("n_ids", pa.int64()), ("ends", pa.binary())])


def end_places(blocks: DataFrame, end_id: int, width: int) -> DataFrame:
    """``(file, block, n_ids, ends)``: places of the end id within the block, as little-endian 32-bit numbers."""
    kind = WIDTHS[width]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                raw = row.column("data")[0].as_buffer()
                ids = np.frombuffer(raw, kind) if raw is not None else np.zeros(0, kind)
                places = np.flatnonzero(ids == end_id).astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays([
                    row.column("file"), row.column("block"), pa.array([len(ids)], pa.int64()), pa.array([places], pa.binary()),
                ], schema=SUMMARY)

    return blocks.select("file", F.col("block").cast("bigint"), "data").mapInArrow(
        search, "file string, block bigint, n_ids bigint, ends binary")


def scanned(places: DataFrame) -> DataFrame:
    """With what lies before each block of its file: ``ids_before``, ``ends_before``,
    and ``open_from``, the place behind the last end before it.

    ``places`` is read twice and should be stored.
    """
    first_of = "PARTITION BY file, run ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    runs_of = "PARTITION BY file ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    # the last four bytes, turned round to be read as a number
    last = "conv(hex(reverse_bytes), 16, 10)"
    summary = places.selectExpr(
        "file", "block", f"block div {RUN_BLOCKS} AS run", "n_ids", "cast(octet_length(ends) div 4 AS BIGINT) AS n_ends",
        "CASE WHEN octet_length(ends) > 0 THEN substring(ends, octet_length(ends) - 3, 4) END AS last_bytes",
    ).selectExpr("file", "block", "run", "n_ids", "n_ends", f"cast({last.replace('reverse_bytes', turned('last_bytes'))} AS BIGINT) AS last_end")
    inner = summary.selectExpr(
        "*", f"coalesce(sum(n_ids) OVER ({first_of}), 0) AS ids_in_run", f"coalesce(sum(n_ends) OVER ({first_of}), 0) AS ends_in_run",
    ).selectExpr("*", f"max(ids_in_run + last_end + 1) OVER ({first_of}) AS open_in_run")
    runs = summary.groupBy("file", "run").agg(F.sum("n_ids").alias("run_ids"), F.sum("n_ends").alias("run_ends"))
    tails = inner.groupBy("file", "run").agg(F.expr("max(ids_in_run + last_end + 1)").alias("run_open"))
    before = runs.join(tails, ["file", "run"]).selectExpr(
        "file", "run", "run_open", f"coalesce(sum(run_ids) OVER ({runs_of}), 0) AS ids_to_run", f"coalesce(sum(run_ends) OVER ({runs_of}), 0) AS ends_to_run",
    ).selectExpr("file", "run", "ids_to_run", "ends_to_run", f"max(ids_to_run + run_open) OVER ({runs_of}) AS open_to_run")
    found = inner.join(before, ["file", "run"]).selectExpr(
        "file", "block", "n_ids", "n_ends", "ids_to_run + ids_in_run AS ids_before", "ends_to_run + ends_in_run AS ends_before",
        "coalesce(ids_to_run + open_in_run, open_to_run, 0L) AS open_from", "last_end")
    return places.select("file", "block", "ends").join(found, ["file", "block"])


def turned(name: str) -> str:
    """SQL: four bytes in the opposite order."""
    return f"concat({', '.join(f'substring({name}, {k}, 1)' for k in (4, 3, 2, 1))})"


def count_tokens(blocks: DataFrame, end_id: int, width: int = 2) -> DataFrame:
    """``(file, ordinal, start, n_tokens, terminated)`` of every document in flat token files.

    ``blocks`` has ``file``, ``block`` (from 0, consecutive) and ``data``, the
    file's bytes cut at whole ids of ``width`` bytes.  ``start`` is the
    document's place in its file; the end id is not counted.
    """
    folder = work_folder(blocks.sparkSession)
    stored = written(scanned(written(end_places(blocks, end_id, width), f"{folder}/ends")), f"{folder}/scanned")
    schema = pa.schema([("file", pa.string()), ("ordinal", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("terminated", pa.bool_())])

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, ends, before, ordinal, opened in zip(*(batch.column(c).to_pylist() for c in ("file", "ends", "ids_before", "ends_before", "open_from"))):
                places = np.frombuffer(ends, "<u4").astype(np.int64) + before
                if not len(places):
                    continue
                starts = np.concatenate(([opened], places[:-1] + 1))
                n = len(places)
                yield pa.RecordBatch.from_arrays([
                    pa.array([file] * n), pa.array(np.arange(ordinal, ordinal + n)), pa.array(starts),
                    pa.array(places - starts), pa.array([True] * n)], schema=schema)

    closed = stored.select("file", "ends", "ids_before", "ends_before", "open_from").mapInArrow(
        stitch, "file string, ordinal bigint, start bigint, n_tokens bigint, terminated boolean")
    ends = stored.groupBy("file").agg(F.expr("max(ids_before + n_ids)").alias("n"), F.expr("max(ends_before + n_ends)").alias("ordinal"),
                                      F.expr("max(greatest(open_from, coalesce(ids_before + last_end + 1, 0L)))").alias("start"))
    left_over = ends.filter("start < n").selectExpr("file", "ordinal", "start", "n - start AS n_tokens", "false AS terminated")
    return closed.unionByName(left_over)


FLAT = pa.schema([("kind", pa.string()), ("file", pa.string()), ("block", pa.int64()), ("data", pa.binary()), ("doc_ids", pa.list_(pa.int64()))])
FLAT_DDL = "kind string, file string, block bigint, data binary, doc_ids array<bigint>"


def write_flat(docs: DataFrame, path: str, end_id: int, tokenizer: str | None = None, width: int = 2, block_ids: int = BLOCK_IDS,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Flat token files, one per input partition, as blocks (``kind = 'ids'``).

    The rows of ``kind = 'order'`` tell which documents went into a file, in
    order and without any place: ``block`` is the number of the first.
    """
    name = tokenizer or tokens.default_path()
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, block, written_docs = f"part-{TaskContext.get().partitionId():06d}", 0, 0
        buffer = bytearray()

        def row(kind: str, number: int, data: bytes | None, doc_ids: list | None) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((kind, file, number, data, doc_ids), FLAT)], schema=FLAT)

        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                doc_ids = part.column("doc_id").to_pylist()
                yield row("order", written_docs, None, doc_ids)
                written_docs += len(doc_ids)
                # The end id may be a special token's: its content within a text must not end the document.
                for ids in tokens.encode_slices(name, part.column("text").to_pylist(), special_as_text=True):
                    whole = np.frombuffer(ids + end, "<u4")
                    if width == 2 and whole.max() > 65535:
                        raise ValueError("an id beyond two bytes; use a width of 4")
                    buffer += whole.astype(WIDTHS[width]).tobytes()
                    while len(buffer) >= block_ids * width:
                        yield row("ids", block, bytes(buffer[:block_ids * width]), None)
                        del buffer[:block_ids * width]
                        block += 1
        if buffer:
            yield row("ids", block, bytes(buffer), None)

    return written(common.rows_of_text(docs, id_col, text_col).mapInArrow(run, FLAT_DDL), path, ("kind",), compression="zstd")


def counted_documents(docs: DataFrame, end_id: int = 50256, tokenizer: str | None = None, width: int = 2, block_ids: int = BLOCK_IDS,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write documents as flat token files, count them by the separators, and name the documents again.

    ``doc_id, file, ordinal, start, n_tokens, terminated``, one row per input
    row; null text is empty; repeated rows count each.
    """
    flat = write_flat(docs, f"{work_folder(docs.sparkSession)}/flat", end_id, tokenizer, width, block_ids, id_col, text_col)
    counted = count_tokens(flat.filter("kind = 'ids'"), end_id, width)
    named = flat.filter("kind = 'order'").selectExpr("file", "block", "posexplode(doc_ids) AS (k, doc_id)").selectExpr(
        "file", "block + k AS ordinal", "doc_id")
    return named.join(counted, ["file", "ordinal"]).select("doc_id", "file", "ordinal", "start", "n_tokens", "terminated")
