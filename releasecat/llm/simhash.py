"""SimHash near-duplicates: fingerprints meet at the words of a covering code, their anchors."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .neardup import components
from .text import keep, partitions, utf8


class Block(NamedTuple):
    """Bits of a fingerprint that a perfect code covers: bits, check bits, covering radius, generator polynomial."""

    bits: int
    checks: int
    radius: int
    generator: int


# Perfect codes, fixed values: two binary Golay codes, and Hamming codes of 15 and 3 bits.  64 bits together; each
# word of a block has exactly one code word within the radius.
CODE = (Block(23, 11, 3, 0b101011100011), Block(23, 11, 3, 0b101011100011), Block(15, 4, 1, 0b10011), Block(3, 2, 1, 0b111))

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


class SimHash(NamedTuple):
    """Words of a shingle, seed of its hash, greatest distance of a link, up to how many fingerprints are compared at
    one anchor, and bytes of text that are cut into words at once."""

    shingle: int = 3
    seed: int = 42
    threshold: int = 2
    together: int = 32
    piece: int = 1 << 17


def hashes_of(words: list[bytes], count: int, size: int, seed: int) -> np.ndarray:
    """Hashes of the first ``count`` runs of ``size`` words, joined by spaces."""
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends])[:count].tolist()
    stops = (ends[size - 1 : size - 1 + count] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], seed) for a, b in zip(starts, stops)], np.uint64)


def shingle_hashes(text: bytes, rule: SimHash) -> Iterator[np.ndarray]:
    """Hashes of all shingles of a text, piece by piece.  Words are what ASCII white space divides; A-Z count as a-z."""
    held, some, at = [], False, 0
    while at < len(text):
        stop = _SPACE.search(text, at + rule.piece)
        end = stop.start() if stop else len(text)
        words = held + text[at:end].lower().split()
        count, at = len(words) - rule.shingle + 1, end
        if count > 0:
            yield hashes_of(words, count, rule.shingle, rule.seed)
            some = True
        held = words[max(count, 0) :]
    if held and not some:
        yield hashes_of(held, 1, len(held), rule.seed)


def fingerprint(text: bytes, rule: SimHash) -> int:
    """A bit is set if it is set in more than half of the shingles' hashes; a text without words has no bit set."""
    total, counts = 0, np.zeros(64, np.int64)
    for hashes in shingle_hashes(text, rule):
        total += len(hashes)
        counts += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    bits = np.packbits(counts * 2 > total)
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, rule: SimHash) -> DataFrame:
    """``doc_id, print``: fingerprints as longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = utf8(batch.column("text"))
            texts = memoryview(data)
            prints = [fingerprint(bytes(texts[a:b]), rule) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.int64())], ["doc_id", "print"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, print long")


def remainders(words: np.ndarray, block: Block) -> np.ndarray:
    """Syndromes: remainders of the words as polynomials over two elements."""
    left = words.astype(np.int64)
    for bit in range(block.bits - 1, block.checks - 1, -1):
        left = np.where(left >> bit & 1, left ^ (block.generator << (bit - block.checks)), left)
    return left


@cache
def patterns(block: Block, weight: int) -> tuple[np.ndarray, np.ndarray]:
    """Error patterns of a weight in order of their syndrome, and where the patterns of each syndrome begin."""
    each = np.array([sum(1 << i for i in places) for places in combinations(range(block.bits), weight)], np.int64)
    syndromes = remainders(each, block)
    order = np.argsort(syndromes, kind="stable")
    return each[order], np.searchsorted(syndromes[order], np.arange((1 << block.checks) + 1))


@cache
def nearest(block: Block) -> np.ndarray:
    """Of each syndrome the pattern that leads to the only code word within the radius."""
    table = np.zeros(1 << block.checks, np.int64)
    for weight in range(1, block.radius + 1):
        errors, starts = patterns(block, weight)
        some = np.flatnonzero(np.diff(starts))
        table[some] = errors[starts[some]]
    return table


def block_words(prints: np.ndarray) -> list[tuple[Block, int, np.ndarray]]:
    """Each block with its lowest bit and its bits of the fingerprints."""
    found, low = [], 0
    for block in CODE:
        found.append((block, low, (prints.view(np.uint64) >> np.uint64(low) & np.uint64((1 << block.bits) - 1)).astype(np.int64)))
        low += block.bits
    return found


def shifted(words: np.ndarray, low: int) -> np.ndarray:
    return words.astype(np.uint64) << np.uint64(low)


def home_anchors(prints: np.ndarray) -> np.ndarray:
    """The anchor of each fingerprint: in every block the code word within the covering radius."""
    anchors = np.zeros(len(prints), np.uint64)
    for block, low, words in block_words(prints):
        anchors |= shifted(words ^ nearest(block)[remainders(words, block)], low)
    return anchors.view(np.int64)


def anchors_in_reach(prints: np.ndarray, beyond: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of fingerprints, and all anchors that are within the covering radius of every block but for ``beyond``
    bits in all, which may be 0 or 1."""
    home = home_anchors(prints)
    rows, anchors = [np.arange(len(prints))], [home]
    if beyond:
        for block, low, words in block_words(prints):
            errors, starts = patterns(block, block.radius + 1)
            syndrome = remainders(words, block)
            counts = starts[syndrome + 1] - starts[syndrome]
            row = np.repeat(np.arange(len(prints)), counts)
            place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts[syndrome], counts)
            other = home.view(np.uint64)[row] & ~shifted(np.int64((1 << block.bits) - 1), low)
            rows.append(row)
            anchors.append((other | shifted(words[row] ^ errors[place], low)).view(np.int64))
    return np.concatenate(rows), np.concatenate(anchors)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def at_anchors(prints: DataFrame, rule: SimHash) -> DataFrame:
    """``anchor, print``: every fingerprint at all anchors where a link of it may meet its other end.

    Of two fingerprints that differ in two bits, a third is one bit from both; its anchor is within the covering
    radius of it.  So each end finds that anchor within the radius plus one: half of the threshold for each end.
    """
    beyond = (rule.threshold + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("print").to_numpy(zero_copy_only=False)
            rows, anchors = anchors_in_reach(own, beyond)
            yield pa.RecordBatch.from_arrays([pa.array(anchors), pa.array(own[rows])], ["anchor", "print"])

    return prints.mapInArrow(run, "anchor long, print long")


def links_at(groups: DataFrame, rule: SimHash) -> DataFrame:
    """Links ``a, b`` among the few fingerprints of each anchor: ``prints`` are at most ``rule.together``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("prints")
            values, sizes = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            found = []
            # Places of a pair within its list: all lists long enough are compared at once.
            for far in range(1, int(sizes.max(initial=0))):
                for near in range(far):
                    at = starts[sizes > far]
                    a, b = values[at + near], values[at + far]
                    close = distances(a, b) <= rule.threshold
                    found.append(np.stack([a[close], b[close]]))
            pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    return groups.select("prints").mapInArrow(run, "a long, b long")


def midpoints(crowded: DataFrame, rule: SimHash) -> DataFrame:
    """``middle, print``: words within half of the threshold of a fingerprint whose anchor is the row's own.

    At most 65 fingerprints are within one bit of a word, and any two of them are linked: nothing is left to compare.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = np.concatenate([np.zeros(1, np.uint64), np.uint64(1) << np.arange(64, dtype=np.uint64)])
        flips = flips[: 65 if rule.threshold > 1 else 1]
        for batch in batches:
            own, anchor = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("print", "anchor"))
            for low in range(0, len(own), 4096):
                some = own[low : low + 4096]
                middles = (some.view(np.uint64)[:, None] ^ flips).view(np.int64).ravel()
                stay = home_anchors(middles) == np.repeat(anchor[low : low + 4096], len(flips))
                columns = [pa.array(middles[stay]), pa.array(np.repeat(some, len(flips))[stay])]
                yield pa.RecordBatch.from_arrays(columns, ["middle", "print"])

    return crowded.select("anchor", "print").mapInArrow(run, "middle long, print long")


def fingerprint_links(prints: DataFrame, rule: SimHash) -> DataFrame:
    """Links ``a, b`` that connect all different fingerprints within ``rule.threshold`` bits.

    Anchors with a single fingerprint are left after they have been counted.  Fingerprints of an anchor with up to
    ``rule.together`` are compared with each other; those of a crowded one meet at the words between them instead.
    """
    placed = cut_lineage(at_anchors(prints, rule), "anchors")
    counts = placed.groupBy("anchor").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    shared = cut_lineage(placed.join(counts, "anchor"), "shared")
    few = shared.where(F.col("held") <= rule.together).groupBy("anchor").agg(F.collect_list("print").alias("prints"))
    met = midpoints(shared.where(F.col("held") > rule.together), rule)
    stars = met.groupBy("middle").agg(F.collect_list("print").alias("prints")).where(F.size("prints") > 1)
    centred = stars.select(F.array_min("prints").alias("a"), F.explode("prints").alias("b")).where("a != b")
    return links_at(few.repartition(partitions(prints)), rule).union(centred).distinct()


def simhash_components(
    docs: DataFrame, rule: SimHash = SimHash(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document.

    Fingerprints link if they differ in at most ``rule.threshold`` bits (0 to 2); a component is what a chain of links
    connects, its id the least id in it.  Null and empty texts and texts without words have the fingerprint zero,
    which is linked like any other.  Rows with one id keep their own fingerprints; rows without an id are in components
    too, whose id is null if none has one; an empty table gives no rows.  Equal fingerprints are collapsed before they
    are placed at anchors, so copies cost nothing there.
    """
    if not 0 <= rule.threshold <= 2:
        raise ValueError("Links of up to two differing bits can be found")
    table = cut_lineage(fingerprints(keep(docs, doc_id=id_column, text=text_column), rule), "fingerprints")
    firsts = cut_lineage(table.groupBy("print").agg(F.min("doc_id").alias("first_id")), "prints")
    labels = components(fingerprint_links(firsts.select("print"), rule))
    named = firsts.join(labels.select(F.col("key").alias("print"), "component"), "print", "left").select(
        "print", "first_id", F.coalesce("component", "print").alias("component")
    )
    named = cut_lineage(named, "named")
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_print = named.join(least, "component").select("print", "component_id")
    return table.join(of_print, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
