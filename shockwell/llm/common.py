"""Helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shockwell.plans.storage import settled, written

#: A key is hot if it has more than one in HOT_SHARE of all rows, so there are
#: fewer than HOT_SHARE hot keys whatever the data size.
HOT_SHARE = 10_000

#: Bits of a filter of hashes: 8 MB, whatever the data.
FILTER_BITS = 26
SPREAD = (np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rows_of_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """``(doc_id bigint, text string)``, null text as empty; other columns are
    left behind, so their names cannot clash with the operator's own.  With
    ``row_col`` also ``row_id bigint``, a number the caller gave each row."""
    row = [F.col(row_col).cast("bigint").alias("row_id")] if row_col else []
    return df.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"), *row,
    )


def numbered(df: DataFrame) -> DataFrame:
    """With ``row_id``, which tells repeated rows apart.

    Only valid within the one job that stores it: the number depends on how
    the source is cut into partitions.
    """
    return df.withColumn("row_id", F.monotonically_increasing_id())


def keyed(docs: DataFrame) -> DataFrame:
    """``(row_key, source)``: every row whole, with a number of its own.

    The number comes from the file and the place in it, so it is the same in
    every job, unlike one that counts within partitions.  A table that is not
    read from files is stored first.
    """
    try:
        meta = docs.metadataColumn("_metadata")
        docs.select(meta)
    except AnalysisException:
        docs = settled(docs, "rows")
        meta = docs.metadataColumn("_metadata")
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    return docs.select(F.xxhash64(meta["file_path"], meta["row_index"]).alias("row_key"), whole.alias("source"))


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 of a text column, without a detour over Python strings."""
    column = batch.column(name)
    if not pa.types.is_binary(column.type) and not pa.types.is_large_binary(column.type):
        column = column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary())
    return column.to_pylist()


def map_texts(df: DataFrame, schema: str, arrow: pa.Schema,
              rows: Callable[[dict[str, list]], dict[str, list]], step: int = 1000) -> DataFrame:
    """Apply ``rows`` to slices of at most ``step`` rows, given and returned as
    columns; text columns arrive as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                columns = {n: text_bytes(part, n) if pa.types.is_string(part.schema.field(n).type)
                           or pa.types.is_large_string(part.schema.field(n).type)
                           else part.column(n).to_pylist() for n in part.schema.names}
                out = rows(columns)
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def join_to_groups(rows: DataFrame, groups: DataFrame, key: list[str], size: str, total: int) -> DataFrame:
    """Rows joined to the one row of their group, hot groups apart.

    ``groups`` has a row for each key and its number of ``rows`` in ``size``.
    A group with more than one in ``HOT_SHARE`` of all rows is hot: there are
    at most ``HOT_SHARE`` of those, so they are broadcast and their rows never
    meet in one task.  All others join by shuffle.  Both sides are read twice,
    so they should be stored.  Keys must not be null.
    """
    limit = max(total // HOT_SHARE, 1000)
    hot = F.broadcast(groups.filter(F.col(size) > limit))
    cold = groups.filter(F.col(size) <= limit)
    spread = rows.join(hot.select(*key), key, "left_anti").join(cold, key)
    return rows.join(hot, key).unionByName(spread)


def filter_places(hashes: np.ndarray) -> list[np.ndarray]:
    """The two bits of each hash."""
    return [(hashes * odd) >> np.uint64(64 - FILTER_BITS) for odd in SPREAD]


def may_hold(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the filter, as 64-bit words, holds both bits of each hash.  A hash that went in is always held."""
    return reduce(np.logical_and, [
        (words[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool) for place in filter_places(hashes)])


def bit_filter(rows: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray] = lambda batch: batch.column(0).to_numpy().view(np.uint64)) -> np.ndarray:
    """A filter, as 64-bit words, of the ``hashes`` of a table's batches; by default its first column is ``hash bigint``.

    At most ``2 ** FILTER_BITS / 64`` rows come to the driver, whatever the table's size.
    """
    arrow = pa.schema([("word", pa.int64()), ("mask", pa.int64())])

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.concatenate(filter_places(hashes(batch)))
            mask = np.left_shift(np.uint64(1), place & np.uint64(63))
            word = (place >> np.uint64(6)).astype(np.int64)
            by_word = np.argsort(word, kind="stable")
            word, mask = word[by_word], mask[by_word]
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            merged = np.bitwise_or.reduceat(mask, starts) if len(starts) else mask
            yield pa.RecordBatch.from_arrays([pa.array(word[starts]), pa.array(merged.view(np.int64))], schema=arrow)

    bits = rows.mapInArrow(places, "word bigint, mask bigint")
    rows = bits.groupBy("word").agg(F.expr("bit_or(mask) AS mask")).toArrow()
    words = np.zeros(1 << FILTER_BITS - 6, dtype=np.uint64)
    words[rows.column("word").to_numpy()] = rows.column("mask").to_numpy().view(np.uint64)
    return words


def component_names(classes: DataFrame, node: str, least: str, roots: DataFrame, folder: str) -> DataFrame:
    """``classes`` with ``name``, the smallest ``least`` of the component.

    ``roots(node, root)`` has the classes with links.  A component's classes are
    added up before they meet, and a component of very many classes is dealt out.
    """
    found = classes.join(roots.withColumnRenamed("node", node), node, "left").withColumn("_root", F.expr(f"coalesce(root, {node})")).drop("root")
    found = written(found, f"{folder}/rooted")
    names = written(found.groupBy("_root").agg(F.min(least).alias("name"), F.count(F.lit(1)).alias("_size")), f"{folder}/names")
    total = names.agg(F.coalesce(F.sum("_size"), F.lit(0))).first()[0]
    return written(join_to_groups(found, names, ["_root"], "_size", total).drop("_root", "_size"), f"{folder}/classes")
