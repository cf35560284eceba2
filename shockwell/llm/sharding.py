"""Shards by fixed virtual slots.

Records hash into thousands of virtual slots, a number that never changes.  A
stored, versioned map tells the shard of each slot; only the map is edited when
shards grow apart or are added, and only the edited slots' rows move.

Two laws:

* ``bytes``: version 1 deals slots out in turn; version 2 is that map after the
  moves and swaps that bring the shards' bytes together.  The bytes per slot are
  added up by Spark; the driver sees one row per slot and salt
  (``VIRTUAL_SLOTS * SALTS`` rows at most, however large the data).
* ``key``: the map depends on the number of shards alone.  Adding a shard edits
  the map by giving the new shard an even share of slots from the others.

A slot that many rows of one identifier fill is split by salt, a hash of the
row's own number, under the ``bytes`` law; placing rows within a shard is split
that way under both.

Defined results: null text has no bytes and the checksum of nothing; rows
without identifier hash by their text's checksum; repeated rows are placed each
for themselves; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shockwell.llm import common
from shockwell.plans.storage import work_folder, written

VIRTUAL_SLOTS = 4096
SALTS = 16
#: Shards count as even when the largest exceeds the smallest by no more than this share of the mean.
TOLERANCE = 0.0005
#: A slot with more than this share of a shard's fair part is split by salt.
HOT_SLOT = 0.25


def key_map(shards: int, slots: int = VIRTUAL_SLOTS) -> list[int]:
    """Shard of each slot for a number of shards, grown one shard at a time."""
    owner = [0] * slots
    held = {0: list(range(slots))}
    for new in range(1, shards):
        held[new] = []
        for _ in range(slots // (new + 1)):
            giver = max(range(new), key=lambda s: (len(held[s]), -s))
            slot = held[giver].pop()
            owner[slot] = new
            held[new].append(slot)
    return owner


def even_out(owner: dict, load: dict, shards: int, tolerance: float = TOLERANCE) -> dict:
    """Edit a map ``unit -> shard`` until the shards' loads are even.

    Each edit moves a unit from the fullest shard to the emptiest, or swaps two
    of theirs, whichever halves the gap best; it ends when the gap is within
    tolerance or no edit makes it smaller.
    """
    owner = dict(owner)
    total = [0] * shards
    held: list[list[tuple]] = [[] for _ in range(shards)]
    for unit, shard in owner.items():
        total[shard] += load[unit]
        held[shard].append((load[unit], unit))
    for units in held:
        units.sort()
    allowed = tolerance * sum(total) / shards
    while True:
        high = max(range(shards), key=lambda s: (total[s], -s))
        low = min(range(shards), key=lambda s: (total[s], s))
        gap = total[high] - total[low]
        if gap <= allowed:
            return owner
        best = None
        for give in held[high]:
            # What comes back should leave half of the gap; nothing coming back is a plain move.
            wanted = give[0] - gap / 2
            at = bisect_left(held[low], (wanted,))
            for back in (None, *held[low][max(0, at - 1):at + 1]):
                shift = give[0] - (back[0] if back else 0)
                miss = abs(gap / 2 - shift)
                if 0 < shift < gap and (best is None or miss < best[0]):
                    best = (miss, give, back)
        if best is None:
            return owner
        for unit, source, target in ((best[1], high, low), (best[2], low, high)):
            if unit:
                held[source].remove(unit)
                insort(held[target], unit)
                owner[unit[1]] = target
                total[source] -= unit[0]
                total[target] += unit[0]


def placed(docs: DataFrame, id_col: str, text_col: str, slots: int) -> DataFrame:
    """``(doc_id, size, text_crc32, virtual_slot, salt)``, without the text."""
    rows = common.numbered(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    return rows.selectExpr(
        "doc_id", "coalesce(octet_length(text), 0) + 1L AS size",
        "crc32(coalesce(cast(text AS BINARY), cast('' AS BINARY))) AS text_crc32", "row_id",
    ).selectExpr(
        "*", f"cast(pmod(xxhash64(doc_id, if(doc_id IS NULL, text_crc32, NULL)), {slots}) AS INT) AS virtual_slot",
        f"cast(pmod(xxhash64(row_id), {SALTS}) AS INT) AS salt")


def versions(cells: list, law: str, shards: int, slots: int, tolerance: float) -> list[tuple[int, int, int, int]]:
    """``(version, virtual_slot, salt, shard)`` of every cell for each version of the map.

    ``cells`` are rows of (virtual_slot, salt, bytes); cells of a slot share its
    shard unless the slot is hot.
    """
    if law == "key":
        now, grown = key_map(shards, slots), key_map(shards + 1, slots)
        return [(v, c.virtual_slot, c.salt, m[c.virtual_slot]) for v, m in ((1, now), (2, grown)) for c in cells]
    per_slot: dict[int, int] = {}
    for c in cells:
        per_slot[c.virtual_slot] = per_slot.get(c.virtual_slot, 0) + c.bytes
    hot = HOT_SLOT * sum(per_slot.values()) / shards
    unit = {(c.virtual_slot, c.salt): (c.virtual_slot, c.salt if per_slot[c.virtual_slot] > hot else -1) for c in cells}
    load: dict[tuple, int] = {}
    for c in cells:
        u = unit[c.virtual_slot, c.salt]
        load[u] = load.get(u, 0) + c.bytes
    first = {u: u[0] % shards for u in load}
    even = even_out(first, load, shards, tolerance)
    return [(v, c.virtual_slot, c.salt, m[unit[c.virtual_slot, c.salt]]) for v, m in ((1, first), (2, even)) for c in cells]


def stored_map(spark: SparkSession, path: str, rows: list[tuple]) -> DataFrame:
    """The versioned map as a table: a version is added by its rows, none is ever changed."""
    table = spark.createDataFrame(rows, "version int, virtual_slot int, salt int, shard int")
    return written(table.coalesce(1), path, ("version",)).select("version", "virtual_slot", "salt", "shard")


def shard(docs: DataFrame, shards: int = 16, law: str = "bytes", id_col: str = "doc_id", text_col: str = "text",
          slots: int = VIRTUAL_SLOTS, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, law, shard, slot,
    grown_shard, virtual_slot``; ``slot`` counts the shard's rows from 0."""
    if law not in ("bytes", "key"):
        raise ValueError("the law is bytes or key")
    spark = docs.sparkSession
    folder = work_folder(spark)
    rows = written(placed(docs, id_col, text_col, slots), f"{folder}/placed")
    # At most slots * SALTS rows.
    cells = rows.groupBy("virtual_slot", "salt").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
    cells.sort(key=lambda c: (c.virtual_slot, c.salt))
    all_versions = versions(cells, law, shards, slots, tolerance)
    slot_map = stored_map(spark, f"{folder}/slot_map", all_versions)
    current = slot_map.filter(F.col("version") == (1 if law == "key" else 2)).drop("version")
    grown = slot_map.filter("version = 2").selectExpr("virtual_slot", "salt", "shard AS grown_shard").filter(F.lit(law == "key"))
    chosen = {(s, a): h for v, s, a, h in all_versions if v == (1 if law == "key" else 2)}
    first, filled = [], [0] * shards
    for c in cells:
        h = chosen[c.virtual_slot, c.salt]
        first.append((c.virtual_slot, c.salt, filled[h]))
        filled[h] += c.n
    starts = spark.createDataFrame(first, "virtual_slot int, salt int, first_place bigint")
    cell = ["virtual_slot", "salt"]
    mapping = current.join(starts, cell).join(grown, cell, "left")
    within = "row_number() OVER (PARTITION BY virtual_slot, salt ORDER BY doc_id, row_id) - 1"
    return rows.withColumn("place", F.expr(within)).join(F.broadcast(mapping), cell).selectExpr(
        "doc_id", "size", "text_crc32", f"'{law}' AS law", "shard", "first_place + place AS slot", "grown_shard", "virtual_slot")
