"""Shards by fixed virtual slots and a versioned slot-to-shard map."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .text import keep

# Fixed for the life of a corpus: what bounds the map and the work of the driver.
SLOTS = 4096
MAP_SCHEMA = "version int, slot int, shard int, bytes long, rows long, place long"


class Slot(NamedTuple):
    slot: int
    bytes: int
    rows: int


def with_slots(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", slots: int = SLOTS) -> DataFrame:
    """One row for each document: ``doc_id, size, text_crc32, virtual_slot``.

    The size is the UTF-8 bytes of the text plus 1; a null text has none.  Id and text decide the slot, so copies
    under ids of their own, or many texts under one id or none, spread over all slots.  Rows that repeat both and are
    together larger than a mean slot are dealt out over all slots by their number; sizes and numbers are stored first,
    so that every later step sees the same ones.
    """
    rows = keep(docs, doc_id=id_column, text=text_column)
    text = F.coalesce("text", F.lit(""))
    sized = rows.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("number"),
    )
    sized = cut_lineage(sized, "sizes")
    fair = (sized.agg(F.sum("size")).first()[0] or 0) / slots
    repeats = sized.groupBy("doc_id", "text_crc32").agg(F.sum("size").alias("held"), F.count(F.lit(1)).alias("times"))
    # Groups larger than a mean slot are fewer than the slots, so this broadcast has at most ``slots`` rows.
    heavy = repeats.where((F.col("times") > 1) & (F.col("held") > fair)).select(
        F.col("doc_id").alias("heavy_id"), F.col("text_crc32").alias("heavy_text"), F.lit(True).alias("heavy")
    )
    same = sized["doc_id"].eqNullSafe(heavy["heavy_id"]) & (sized["text_crc32"] == heavy["heavy_text"])
    spread = F.when(F.col("heavy"), F.xxhash64("doc_id", "text_crc32", "number")).otherwise(F.xxhash64("doc_id", "text_crc32"))
    return sized.join(F.broadcast(heavy), same, "left").select(
        "doc_id", "size", "text_crc32", F.pmod(spread, F.lit(slots)).cast("int").alias("virtual_slot")
    )


def slot_sizes(slotted: DataFrame) -> DataFrame:
    """Bytes and rows of each slot; summed in the map tasks first, at most one row for each slot."""
    return slotted.groupBy(F.col("virtual_slot").alias("slot")).agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")
    )


def initial_map(slots: int, shards: int) -> list[int]:
    """Version 1: slot after slot to shard after shard."""
    return [slot % shards for slot in range(slots)]


def rebalance(shard_of: Sequence[int], sizes: Sequence[Slot], shards: int) -> list[int]:
    """Edit a map so that shards hold nearly equal bytes, moving few slots.

    The fullest shard gives the emptiest one the slot, or swaps with it the pair of slots, that brings both
    nearest to each other, until no such edit brings them nearer.  A new shard starts empty and is filled the
    same way.  Works on the slot sums only, whose number is fixed.
    """
    result = list(shard_of)
    weight = [0] * len(result)
    for s in sizes:
        weight[s.slot] = s.bytes
    load = [0] * shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(result):
        load[shard] += weight[slot]
        held[shard].append((weight[slot], slot))
    for part in held:
        part.sort()
    while True:
        full = max(range(shards), key=lambda s: (load[s], -s))
        spare = min(range(shards), key=lambda s: (load[s], s))
        gap = load[full] - load[spare]
        best = (gap, None, None)
        empty = (0, -1)
        for back in [empty, *held[spare]]:
            place = bisect_left(held[full], (back[0] + gap // 2, -1))
            for given in held[full][max(0, place - 1) : place + 1]:
                moved = given[0] - back[0]
                if 0 < moved < gap and abs(gap - 2 * moved) < best[0]:
                    best = (abs(gap - 2 * moved), given, back)
        _, given, back = best
        if given is None:
            return result
        _move(given, held[full], held[spare])
        result[given[1]] = spare
        if back is not empty:
            _move(back, held[spare], held[full])
            result[back[1]] = full
        load[full] -= given[0] - back[0]
        load[spare] += given[0] - back[0]


def _move(part: tuple[int, int], source: list[tuple[int, int]], target: list[tuple[int, int]]) -> None:
    source.remove(part)
    insort(target, part)


def map_rows(version: int, shard_of: Sequence[int], sizes: Sequence[Slot], shards: int) -> list[tuple]:
    """Rows of a stored map; ``place`` is where the rows of a slot begin inside its shard."""
    by_slot = {s.slot: s for s in sizes}
    place = [0] * shards
    rows = []
    for slot, shard in enumerate(shard_of):
        size = by_slot.get(slot, Slot(slot, 0, 0))
        rows.append((version, slot, shard, size.bytes, size.rows, place[shard]))
        place[shard] += size.rows
    return rows


def slot_maps(slotted: DataFrame, shards: int, slots: int = SLOTS) -> DataFrame:
    """The stored map in two versions: 1 by rule, 2 rebalanced by the bytes of the slots."""
    sizes = [Slot(*row) for row in slot_sizes(slotted).collect()]  # at most ``slots`` rows
    first = initial_map(slots, shards)
    second = rebalance(first, sizes, shards)
    rows = map_rows(1, first, sizes, shards) + map_rows(2, second, sizes, shards)
    return cut_lineage(slotted.sparkSession.createDataFrame(rows, MAP_SCHEMA), "slot-map")


def assign_shards(slotted: DataFrame, maps: DataFrame, version: int = 2) -> DataFrame:
    """Shard of each row under one version of the map, and its place there, gapless from 0.

    Adds ``shard, slot, map_version``.  The map has one row for each slot and is broadcast; rows are numbered inside
    their virtual slot only, so no task sorts a shard.  Rows alike in everything are numbered in any order.
    """
    chosen = maps.where(F.col("version") == version).select(
        F.col("slot").alias("virtual_slot"), "shard", "place", F.col("version").alias("map_version")
    )
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    numbered = slotted.withColumn("inside", F.row_number().over(inside).cast("long") - 1)
    return numbered.join(F.broadcast(chosen), "virtual_slot").withColumn("slot", F.col("place") + F.col("inside"))


def shard_documents(
    docs: DataFrame, shards: int = 16, id_column: str = "doc_id", text_column: str = "text", slots: int = SLOTS
) -> DataFrame:
    """Shards with nearly equal bytes.

    Every row is kept, repeated ones too.  Null and empty texts have size 1.  An empty table gives no rows.
    One document larger than a shard's share makes its shard larger.
    """
    slotted = with_slots(docs, id_column, text_column, slots)
    return assign_shards(slotted, slot_maps(slotted, shards, slots)).select(
        "doc_id", "size", "text_crc32", "shard", "slot", "virtual_slot", "map_version"
    )
