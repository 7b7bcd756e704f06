"""Benchmark decontamination: rare n-gram seeds and local alignment of the words around them.

An item is held where a local alignment reaches ``least_points``.  Seeds are pairs of neighbouring words of an item;
in a text the two may have one word between them.  What an alignment lacks to its full score bounds how many of an
item's pairs it can break: a changed or missing word costs 3 and breaks two at most, a word cut off at an end costs 2
and breaks one, and two words put in at one place cost 2 and break one.  So two thirds of what is lacking may be
broken, and all other pairs of the item stand in the text, within twice its length.  Half of these may be left out of
the search, and an item leaves out its most frequent ones; the others are enough to lose no alignment.  (With a ``least`` below a
third of the words an alignment may leave no pair standing; one pair is asked for then.)
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from ..session import cut_lineage
from .text import Words, keep, runs, shingles, slices, utf8, words

SEED_WORDS = 2
# Share of an item's words, in alignment score, from which on a document is taken to hold the item.
LEAST_SCORE = 0.5
# Matching words whose score an alignment has at least, or those of the whole item if it has fewer.
LEAST_WORDS = 5
MATCH, MISMATCH, GAP = 2, -1, 1
# Words of items that are looked for in one scan: what a task holds of the benchmark, whatever its size.
BLOCK_WORDS = 1 << 20
# Bits that say which seeds are worth a search, as a power of two.
_FILTER_BITS = 22


def least_points(length: int, least: float = LEAST_SCORE) -> float:
    """Alignment score from which on a text holds an item of ``length`` words."""
    return max(least * MATCH * length, MATCH * min(length, LEAST_WORDS))


def item_words(items: DataFrame) -> DataFrame:
    """``item_id, item_words`` (hashes), one row for each different pair; items without words are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = words(*utf8(batch.column("text")))
            lists = _lists(found.hash.view(np.int64), found.first)
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), lists], ["item_id", "item_words"])

    kind = items.schema["item_id"].dataType.simpleString()
    listed = items.mapInArrow(run, f"item_id {kind}, item_words array<long>")
    return listed.where(F.size("item_words") > 0).distinct()


def pairs_of(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of pairs of words with at most one word between them, and the index of the first word of each."""
    near, at = shingles(found, SEED_WORDS)
    far = [], []
    if len(found.hash) > SEED_WORDS:
        # Shingles over every other word: the even ones, then the odd ones.
        order = np.concatenate([np.arange(0, len(found.hash), 2), np.arange(1, len(found.hash), 2)])
        apart = Words(found.text[order], found.start, found.end, found.hash[order], found.first)
        seeds, places = shingles(apart, SEED_WORDS)
        whole = order[places + 1] == order[places] + 2
        far = seeds[whole], order[places[whole]]
    return np.concatenate([near, np.asarray(far[0], np.uint64)]), np.concatenate([at, np.asarray(far[1], np.int64)])


class SeedIndex:
    """Items of one block, and the items that each of their seeds leads to.

    ``files`` gives the number of texts with each of ``all_seeds``; until it is known every seed is looked up.
    """

    def __init__(self, ids: list, texts: list[np.ndarray], least: float = LEAST_SCORE):
        self.ids, self.texts = ids, texts
        sizes = np.array([len(t) for t in texts], np.int64)
        self.points = np.array([least_points(n, least) for n in sizes.tolist()])
        # Pairs of an item that stand in any text that holds it.
        lacking = np.floor(MATCH * sizes - self.points + 1e-9).astype(np.int64)
        self.standing = np.maximum(1, sizes - 1 - lacking * 2 // 3)
        # Words of a text that an alignment covers at most.
        self.reach = sizes + lacking
        of = np.repeat(np.arange(len(texts)), sizes)
        hashes = np.concatenate(texts).view(np.uint64)
        self.seeds, at = shingles(Words(of, of, of, hashes, of), SEED_WORDS)
        self.item = of[at]
        self.all_seeds = np.unique(self.seeds)
        self.needed = self.standing
        self._look_up(np.ones(len(self.seeds), bool))

    def leave_out_frequent(self, files: np.ndarray) -> None:
        """Look for the rarest seeds only: each item leaves out half of those that must stand in a text anyway."""
        often = files[np.searchsorted(self.all_seeds, self.seeds)]
        order = np.lexsort((-often, self.item))
        bounds = runs(self.item[order])
        rank = np.arange(len(order)) - np.repeat(bounds[:-1], np.diff(bounds))
        left_out = self.standing // 2
        kept = np.zeros(len(order), bool)
        kept[order] = rank >= left_out[self.item[order]]
        self.needed = self.standing - left_out
        self._look_up(kept)

    def _look_up(self, kept: np.ndarray) -> None:
        order = np.lexsort((self.item[kept], self.seeds[kept]))
        seeds, items = self.seeds[kept][order], self.item[kept][order]
        other = np.ones(len(seeds), bool)
        other[1:] = (seeds[1:] != seeds[:-1]) | (items[1:] != items[:-1])
        self.items = items[other]
        self.first = runs(seeds[other])
        self.keys = seeds[other][self.first[:-1]]
        self.bits = np.zeros(1 << _FILTER_BITS, bool)
        self.bits[self.keys >> np.uint64(64 - _FILTER_BITS)] = True

    def hits(self, found: Words) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of keys that stand in texts, and the words where they do."""
        seeds, at = pairs_of(found)
        likely = self.bits[seeds >> np.uint64(64 - _FILTER_BITS)]
        seeds, at = seeds[likely], at[likely]
        number = np.minimum(np.searchsorted(self.keys, seeds), len(self.keys) - 1)
        same = self.keys[number] == seeds
        return number[same], at[same]

    def stretches(self, found: Words) -> Iterator[tuple[int, int, int, int]]:
        """Text, item, and first and end word of what may hold the item.

        There are as many seeds as an alignment leaves standing, as near to one another as it leaves them.
        """
        number, at = self.hits(found)
        count = self.first[number + 1] - self.first[number]
        at = np.repeat(at, count)
        place = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.first[number], count)
        item = self.items[place]
        group = found.text[at] * len(self.ids) + item
        order = np.lexsort((at, group))
        group, at, item = group[order], at[order], item[order]
        other = np.ones(len(at), bool)
        other[1:] = (group[1:] != group[:-1]) | (at[1:] != at[:-1])
        group, at, item = group[other], at[other], item[other]
        last = np.arange(len(at)) + self.needed[item] - 1
        inside = last < len(at)
        first, last = np.flatnonzero(inside), last[inside]
        near = (group[first] == group[last]) & (at[last] - at[first] <= self.reach[item[first]])
        first, last = first[near], last[near]
        text, item, group = found.text[at[first]], item[first], group[first]
        begin = np.maximum(found.first[text], at[first] - self.reach[item])
        end = np.minimum(found.first[text + 1], at[last] + SEED_WORDS + 1 + self.reach[item])
        bounds = np.ones(len(first), bool)
        bounds[1:] = (group[1:] != group[:-1]) | (begin[1:] > end[:-1])
        opens = np.flatnonzero(bounds)
        closes = np.append(opens[1:], len(first))[: len(opens)] - 1
        for a, b in zip(opens.tolist(), closes.tolist()):
            if self.may_hold(found, int(item[a]), int(begin[a]), int(end[b])):
                yield int(text[a]), int(item[a]), int(begin[a]), int(end[b])

    def may_hold(self, found: Words, item: int, begin: int, end: int) -> bool:
        """Whether enough words of the item and all its pairs that must stand are there."""
        held = np.isin(self.texts[item].view(np.uint64), found.hash[begin:end])
        if MATCH * held.sum() < self.points[item]:
            return False
        part = np.zeros(end - begin, np.int64)
        seeds, _ = pairs_of(Words(part, part, part, found.hash[begin:end], part))
        a, b = np.searchsorted(self.item, [item, item + 1])
        return np.isin(self.seeds[a:b], seeds).sum() >= self.standing[item]


def item_blocks(items: DataFrame, least: float = LEAST_SCORE, limit: int = BLOCK_WORDS) -> Iterator[SeedIndex]:
    """All items of two words and more, ``limit`` words at a time or a longer item alone."""
    ids, texts, held = [], [], 0
    for row in items.where(F.size("item_words") >= SEED_WORDS).toLocalIterator():
        if texts and held + len(row.item_words) > limit:
            yield SeedIndex(ids, texts, least)
            ids, texts, held = [], [], 0
        ids.append(row.item_id)
        texts.append(np.array(row.item_words, np.int64))
        held += len(row.item_words)
    if texts:
        yield SeedIndex(ids, texts, least)


def seed_files(docs: DataFrame, index: SeedIndex) -> np.ndarray:
    """Number of texts with each of a block's seeds, over all texts; tasks send sums."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        files = np.zeros(len(index.keys), np.int64)
        for batch in batches:
            for part in slices(batch):
                found = words(*utf8(part.column("text")))
                number, at = index.hits(found)
                once = np.unique(found.text[at] * len(files) + number)
                files += np.bincount(once % len(files), minlength=len(files))
        some = np.flatnonzero(files)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(files[some], pa.int64())], ["number", "files"])

    counted = docs.select("text").mapInArrow(run, "number long, files long").groupBy("number").agg(F.sum("files").alias("files"))
    rows = counted.toPandas()
    files = np.zeros(len(index.keys), np.int64)
    files[rows["number"].to_numpy(np.int64)] = rows["files"].to_numpy(np.int64)
    return files


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best Smith-Waterman score of two sequences of words, and where it ends in the passage (exclusive).

    Rows are worked out whole: a gap along the row is a running maximum.
    """
    steps = np.arange(len(passage) + 1) * GAP
    row = np.zeros(len(passage) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        direct = np.zeros(len(passage) + 1, np.int64)
        np.maximum(row[:-1] + np.where(passage == word, MATCH, MISMATCH), row[1:] - GAP, out=direct[1:])
        np.maximum(direct, 0, out=direct)
        row = np.maximum.accumulate(direct + steps) - steps
        place = int(row.argmax())
        if row[place] > best:
            best, end = int(row[place]), place
    return best, end


def aligned(docs: DataFrame, index: SeedIndex, kind: DataType) -> DataFrame:
    """Texts that hold items of a block: ``doc_id, text_key, item_id, score, first_word, last_word``.

    The score is that of the alignment divided by that of the whole item; words are counted from 0.  Only stretches
    with enough seeds are aligned, in the task that has the text; equal stretches of a slice are aligned once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for part in slices(batch):
                found = words(*utf8(part.column("text")))
                seen, held = {}, []
                for text, item, begin, end in index.stretches(found):
                    passage = found.hash[begin:end].view(np.int64)
                    key = item, passage.tobytes()
                    if key not in seen:
                        seen[key] = _alignment(index.texts[item], passage, index.points[item])
                    if seen[key]:
                        best, first, last = seen[key]
                        start = begin - int(found.first[text])
                        held.append((text, item, best / (MATCH * len(index.texts[item])), start + first, start + last))
                if held:
                    of, item, score, first, last = zip(*held)
                    take = pa.array(of, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").take(take), part.column("text_key").take(take), pa.array([index.ids[i] for i in item], item_type), pa.array(score, pa.float64()), pa.array(first, pa.int64()), pa.array(last, pa.int64())],
                        ["doc_id", "text_key", "item_id", "score", "first_word", "last_word"],
                    )

    item_type = to_arrow_type(kind)
    doc_kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {doc_kind}, text_key long, item_id {kind.simpleString()}, score double, first_word long, last_word long")


def _alignment(item: np.ndarray, passage: np.ndarray, points: float) -> tuple[int, int, int] | None:
    best, end = align(item, passage)
    if best < points:
        return None
    _, back = align(item[::-1], passage[:end][::-1])
    return best, end - back, end - 1


def text_number(text: str = "text"):
    """What tells texts of one id, or of none, apart."""
    return F.xxhash64(F.col(text))


def held_items(docs: DataFrame, benchmark: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """Test items in each text: ``doc_id, text_key, item_id, score, first_word, last_word``, with the best alignment.

    Every text with an alignment of ``least_points`` is found.  Documents are scanned twice for each block of
    ``BLOCK_WORDS`` words of the benchmark: to count seeds, and to align the stretches around rare ones; only what is
    held is shuffled.  Items of up to ``LEAST_WORDS`` words must stand whole; those of one word are not looked for,
    as a word alone is no copy.  Null and empty texts hold nothing; empty tables give no rows.
    """
    rows = keep(docs, doc_id="doc_id", text="text").withColumn("text_key", text_number())
    items = cut_lineage(item_words(keep(benchmark, item_id="item_id", text="text")), "benchmark-items")
    kind = items.schema["item_id"].dataType
    blocks = []
    for index in item_blocks(items, least):
        index.leave_out_frequent(seed_files(rows, index))
        blocks.append(aligned(rows, index, kind))
    if not blocks:
        none = rows.where(F.lit(False)).select("doc_id", "text_key", F.lit(None).cast(kind).alias("item_id"))
        blocks.append(none.select("*", F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("first_word"), F.lit(0).cast("long").alias("last_word")))
    best = reduce(DataFrame.union, blocks).groupBy("doc_id", "text_key", "item_id").agg(_best())
    return best.select("doc_id", "text_key", "item_id", "b.score", "b.first_word", "b.last_word")


def _best():
    return F.max(F.struct("score", -F.col("first_word"), "first_word", "last_word")).alias("b")


def find_contamination(docs: DataFrame, benchmark: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """Test items that whole documents hold, also edited: ``doc_id, item_id, score, first_word, last_word``.

    As ``held_items``, but rows with one id, or without one, count as one document.
    """
    best = held_items(docs, benchmark, least).groupBy("doc_id", "item_id").agg(_best())
    return best.select("doc_id", "item_id", "b.score", "b.first_word", "b.last_word")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The documents, with all their columns, that hold no test item.  Each row is judged by its own text."""
    number, key = "__contaminated_id", "__contaminated_text"
    found = held_items(docs, benchmark, least).select(F.col("doc_id").alias(number), F.col("text_key").alias(key)).distinct()
    same = docs["doc_id"].eqNullSafe(found[number]) & (text_number() == found[key])
    return docs.join(found, same, "left_anti")


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.asarray(bounds, np.int32)), pa.array(values))

