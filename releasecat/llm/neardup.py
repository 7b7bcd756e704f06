"""Near-duplicate classes by ProbMinHash signatures, banding and verification.

A shingle that stands ``times`` times in a text weighs ``1 + ln(times)``.  Two texts are linked if the probability
Jaccard similarity of their weighted shingles is high enough, or the Jaccard similarity of their sets of shingles, to
which weights of repeated lines do nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, run_together
from .text import keep, mix, partitions, shingles, slices, utf8, words


# A small table is written by few tasks, of up to so many rows each: a file for each shuffle partition, most of them
# with hardly a row, would hide from Spark that the table is small enough to be broadcast.
ROWS_A_TASK = 50_000
FEW_TASKS = 16


class NearDup(NamedTuple):
    """Words of a shingle, least similarity of two texts, the bands of a signature and their rows, and up to how many
    texts of a bucket that are apart from its pivot one task compares with each other.

    A pair with a similarity of 0.8, weighted or of sets, shares no band with a chance of 1 in 20,000.
    """

    shingle: int = 5
    least: float = 0.8
    bands: int = 25
    rows: int = 5
    together: int = 512

    @property
    def size(self) -> int:
        return self.bands * self.rows


def weighted_shingles(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: number of the text, hash, and weight, ``1 + ln(times)``.

    A text with fewer words than a shingle has one shingle of all its words; a text without words has none.
    """
    found = words(*utf8(column))
    hashes, at = shingles(found, size)
    text = found.text[at]
    counts = np.diff(found.first)
    short = np.flatnonzero((counts > 0) & (counts < size))
    for number in short.tolist():
        own = found.hash[found.first[number] : found.first[number + 1]]
        value = mix(np.array([hash_all(own)], np.uint64))
        hashes, text = np.append(hashes, value), np.append(text, number)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    start = np.flatnonzero(new)
    times = np.diff(np.append(start, len(hashes)))
    return text[start], hashes[start], 1.0 + np.log(times)


def hash_all(values: np.ndarray) -> int:
    total = len(values)
    for value in values.tolist():
        total = (total * 0x9E3779B97F4A7C15 + value) & 0xFFFFFFFFFFFFFFFF
    return total


def signatures(text: np.ndarray, hashes: np.ndarray, weights: np.ndarray, texts: int, size: int) -> np.ndarray:
    """ProbMinHash signatures, one row of ``size`` hashes for each text.

    Every shingle sends arrivals of a Poisson process with its weight as the rate; each arrival falls on a random
    component of the text's signature, and the component keeps the shingle whose arrival is earliest.  Arrivals are
    drawn in rounds; a shingle stops as soon as its next arrival is later than the latest component of its text.  Two
    signatures agree in a component with the probability Jaccard similarity of their weighted shingles.
    """
    earliest = np.full(texts * size, np.inf)
    owner = np.zeros(texts * size, np.uint64)
    state, time, live = hashes.copy(), np.zeros(len(hashes)), np.arange(len(hashes))
    latest = np.full(texts, np.inf)
    while len(live):
        state[live] += np.uint64(0x9E3779B97F4A7C15)
        drawn = mix(state[live])
        uniform = ((drawn >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52
        time[live] -= np.log(uniform) / weights[live]
        live_now = time[live] < latest[text[live]]
        live, drawn = live[live_now], drawn[live_now]
        place = text[live] * size + (mix(drawn ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(size)).astype(np.int64)
        np.minimum.at(earliest, place, time[live])
        won = earliest[place] == time[live]
        owner[place[won]] = hashes[live[won]]
        latest = earliest.reshape(texts, size).max(1)
        live = live[time[live] < latest[text[live]]]
    return owner.reshape(texts, size)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash for each band of each signature; different bands never share a value by their position."""
    keys = np.zeros((len(signature), bands), np.uint64)
    parts = signature.reshape(len(signature), bands, rows)
    for row in range(rows):
        keys = mix(keys * np.uint64(0xD1342543DE82EF95) + parts[:, :, row])
    return mix(keys + np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def text_key(text: str = "text"):
    """128 bits of the text's SHA-256; null and empty texts are alike."""
    return F.unhex(F.substring(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256), 1, 32))


def band_table(docs: DataFrame, rule: NearDup) -> DataFrame:
    """``doc_id, key, bands``: of each row the key of its text and its band hashes, none for a text without words.

    The bands are those of the weighted signature.  A text whose weights differ has those of the signature with equal
    weights as well, which is that of its set; for all other texts the two signatures are the same.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                text, hashes, weights = weighted_shingles(part.column("text"), rule.shingle)
                some = np.bincount(text, minlength=len(part)) > 0
                uneven = uneven_texts(text, weights, len(part))
                also = uneven[text]
                both = np.cumsum(uneven) - 1
                sets = signatures(both[text[also]], hashes[also], np.ones(also.sum()), int(uneven.sum()), rule.size)
                weighted = signatures(text, hashes, weights, len(part), rule.size)[some]
                owner = np.concatenate([np.flatnonzero(some), np.flatnonzero(uneven)])
                keys = band_keys(np.concatenate([weighted, sets]), rule.bands, rule.rows)[np.argsort(owner, kind="stable")]
                bounds = np.concatenate([[0], np.cumsum((some + 1 * uneven) * rule.bands)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(keys.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("key"), lists], ["doc_id", "key", "bands"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select("doc_id", "text", text_key().alias("key"))
    return keyed.mapInArrow(run, f"doc_id {kind}, key binary, bands array<long>")


def uneven_texts(text: np.ndarray, weights: np.ndarray, texts: int) -> np.ndarray:
    """Which texts have shingles of different weight."""
    least, most = np.full(texts, np.inf), np.zeros(texts)
    np.minimum.at(least, text, weights)
    np.maximum.at(most, text, weights)
    return most > least


class Shingles(NamedTuple):
    """Sorted hashes of a text's shingles, their weights, and whether the weights differ."""

    hashes: np.ndarray
    weights: np.ndarray
    uneven: bool


def each_text(column: pa.Array, size: int) -> list[Shingles]:
    text, hashes, weights = weighted_shingles(column, size)
    cuts = np.searchsorted(text, np.arange(1, len(column)))
    parts = zip(np.split(hashes, cuts), np.split(weights, cuts), uneven_texts(text, weights, len(column)).tolist())
    return [Shingles(*part) for part in parts][: len(column)]


def jaccard(a: Shingles, b: Shingles) -> tuple[float, float]:
    """Jaccard similarity of the sets, and probability Jaccard similarity of the weighted shingles.

    The latter is, summed over the shared shingles d, ``1 / sum over all d' of max(a[d'] / a[d], b[d'] / b[d])``.  With
    the shared shingles in order of ``a / b`` the first term is the greater for all from d on, the second for all
    before d.  Texts without shingles are alike to each other only.
    """
    if not len(a.hashes) or not len(b.hashes):
        return (float(len(a.hashes) == len(b.hashes)),) * 2
    _, at_a, at_b = np.intersect1d(a.hashes, b.hashes, assume_unique=True, return_indices=True)
    sets = len(at_a) / (len(a.hashes) + len(b.hashes) - len(at_a))
    if not (a.uneven or b.uneven):
        return sets, sets
    x, y = a.weights[at_a], b.weights[at_b]
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    from_here = a.weights.sum() - (np.cumsum(x) - x)
    before = b.weights.sum() - y.sum() + np.cumsum(y) - y
    return sets, float((1 / (from_here / x + before / y)).sum())


def similarities(pairs: DataFrame, texts: DataFrame, rule: NearDup) -> DataFrame:
    """Exact similarities of pairs of text keys: ``key, pivot, similarity, weighted``.  ``texts`` has ``key`` and ``text``."""
    left = texts.select("key", F.col("text").alias("text_key"))
    right = texts.select(F.col("key").alias("pivot"), F.col("text").alias("text_pivot"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [each_text(batch.column(name), rule.shingle) for name in ("text_key", "text_pivot")]
            found = np.array([jaccard(a, b) for a, b in zip(*sides)]).reshape(-1, 2)
            columns = [batch.column("key"), batch.column("pivot"), pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "pivot", "similarity", "weighted"])

    # Few texts are pivots of many pairs, so the rows to compare are left as the join by the other text deals them out.
    joined = pairs.select("key", "pivot").join(right, "pivot").join(left, "key").select("key", "pivot", "text_key", "text_pivot")
    return joined.mapInArrow(run, "key binary, pivot binary, similarity double, weighted double")


def stored_small(df: DataFrame, label: str, rows: int) -> DataFrame:
    """Store a table of at most ``rows`` rows, by few tasks if they are few."""
    return cut_lineage(df.coalesce(max(FEW_TASKS, -(-rows // ROWS_A_TASK))), label)


def components(links: DataFrame) -> DataFrame:
    """Component of every key in ``links (a, b)``: ``key, component``, the least key of the component.

    Each step takes the least label among a key's neighbours and then the label of that label; a step is stored, and
    the steps end when no label changes.  Only counts reach the driver.
    """
    return _components(cut_lineage(links.select("a", "b").distinct(), "links"))


def _components(links: DataFrame) -> DataFrame:
    """``components`` of stored links."""
    rows = 2 * links.count()
    both = links.select("a", "b").union(links.select("b", "a"))
    first = both.groupBy(F.col("a").alias("key")).agg(F.least(F.min("b"), F.first("a")).alias("component"))
    labels = stored_small(first, "labels", rows)
    while True:
        seen = both.join(labels.select(F.col("key").alias("b"), "component"), "b").groupBy(F.col("a").alias("key"))
        least = seen.agg(F.min("component").alias("near"))
        stepped = labels.join(least, "key").select("key", F.col("component").alias("old"), F.least("component", "near").alias("new"))
        jump = labels.select(F.col("key").alias("new"), F.col("component").alias("beyond"))
        moved = stepped.join(jump, "new").select("key", "old", F.least("new", "beyond").alias("component"))
        moved = stored_small(moved, "labels", rows)
        labels = moved.select("key", "component")
        if moved.where(F.col("old") != F.col("component")).isEmpty():
            return labels


def extended(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components ``labels`` with further stored links; only the components that these join are worked out again."""
    of_a = labels.select(F.col("key").alias("a"), F.col("component").alias("of_a"))
    of_b = labels.select(F.col("key").alias("b"), F.col("component").alias("of_b"))
    ends = links.join(of_a, "a", "left").join(of_b, "b", "left").select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    rows = links.count()
    ends = stored_small(ends.where(F.col("a") != F.col("b")).distinct(), "links", rows)
    if ends.isEmpty():
        return labels
    moved = _components(ends)
    beyond = moved.select(F.col("key").alias("component"), F.col("component").alias("beyond"))
    known = labels.join(beyond, "component", "left").select("key", F.coalesce("beyond", "component").alias("component"))
    return stored_small(known.union(moved.join(labels, "key", "left_anti")), "labels", labels.count() + 2 * rows)


def find_links(bands: DataFrame, docs: DataFrame, rule: NearDup) -> DataFrame:
    """Links ``a, b`` between different texts that connect all texts linked through a shared band."""
    return link_texts(bands, docs, rule)[0]


def link_texts(bands: DataFrame, docs: DataFrame, rule: NearDup) -> tuple[DataFrame, DataFrame]:
    """Links ``a, b`` between different texts that connect all texts linked through a shared band, and the ``components``
    of these links.

    ``bands`` has ``key, band`` rows.  In each bucket every text is compared with one pivot, the text that is in the
    most and largest buckets.  A text left in another component than its pivot is compared with the pivot's component
    unless it is too far from the pivot for a link: Jaccard distance is a metric, that of sets and the weighted one.
    What is still apart is compared in one task if it is little, else where rare shingles allow a link; no text takes a
    turn of its own.  So a bucket is connected rightly without its pairs being listed.
    """
    sizes = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    buckets = cut_lineage(bands.join(sizes, "band"), "buckets")
    score = stored_small(buckets.groupBy("key").agg(F.sum("n").alias("score")), "scores", buckets.count())
    every = docs.select(text_key().alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    # The keys grow with the input, so they are hashed where the texts are dealt out, however small their files look.
    needed = every.join(score.hint("shuffle_hash"), "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    scored = buckets.select("band", "key").join(score, "key")
    texts, members = run_together([lambda: cut_lineage(needed, "bucket-texts"), lambda: cut_lineage(scored, "members")])

    pivots = members.groupBy("band").agg(F.max(F.struct("score", "key")).alias("p")).select("band", F.col("p.key").alias("pivot"))
    placed = cut_lineage(members.join(pivots, "band"), "placed")
    pairs = placed.where(F.col("key") != F.col("pivot")).select("key", "pivot").distinct()
    spokes = cut_lineage(similarities(pairs, texts, rule), "similarities")
    near = spokes.where(F.greatest("similarity", "weighted") >= rule.least).select(F.col("key").alias("a"), F.col("pivot").alias("b"))
    links = stored_small(near, "links", spokes.count())
    labels = _components(links)
    spokes = _split(spokes, labels)
    while (extra := _fringe_links(spokes, texts, rule)) is not None:
        links, labels = links.union(extra), extended(labels, extra)
        spokes = _split(spokes, labels)
    apart = cut_lineage(_apart(placed, labels), "apart")
    counts = apart.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    counts = stored_small(counts, "counts", apart.count())
    if counts.isEmpty():
        return links, labels
    few = apart.join(counts.where(F.col("n") <= rule.together), "band", "left_semi").select(F.col("band").cast("string"), "key")
    many = counts.where(F.col("n") > rule.together)
    if not many.isEmpty():
        few = few.union(_bundles(apart.join(many, "band", "left_semi").select("key").distinct(), texts, rule))
    within = cut_lineage(linked_together(few, texts, rule), "within")
    return links.union(within), extended(labels, within)


def rare_shared_shingles(keys: DataFrame, texts: DataFrame, rule: NearDup) -> DataFrame:
    """``shingle, key``: the rarest shingles of each text of ``keys`` that others of them have as well, as many as any two
    linked texts need to have one in common.

    Linked texts share at least ``rule.least`` of either's shingles, or of either's weight.  With the shingles of all
    texts in one order, the first one that two linked texts share therefore has at least so much of each text at or
    behind it.  The rarest come first, so that a text seldom meets another one by what many have.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                text, hashes, weights = weighted_shingles(part.column("text"), rule.shingle)
                number = 1 / np.bincount(text, minlength=len(part))[text]
                weight = weights / np.bincount(text, weights, len(part))[text]
                columns = [pa.array(hashes.view(np.int64)), part.column("key").take(pa.array(text)), pa.array(number), pa.array(weight)]
                yield pa.RecordBatch.from_arrays(columns, ["shingle", "key", "number", "weight"])

    every = texts.join(keys, "key", "left_semi").select("key", "text")
    held = cut_lineage(every.mapInArrow(run, "shingle long, key binary, number double, weight double"), "shingles")
    times = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("times")).where(F.col("times") > 1)
    # What a text alone has stands before all this.
    behind = Window.partitionBy("key").orderBy(F.desc("times"), F.desc("shingle")).rowsBetween(Window.unboundedPreceding, 0)
    reach = {c: F.sum(c).over(behind) for c in ("number", "weight")}
    shared = held.join(times, "shingle").withColumns(reach)
    return shared.where((F.col("number") >= rule.least - 1e-6) | (F.col("weight") >= rule.least - 1e-4)).select("shingle", "key")


def _bundles(keys: DataFrame, texts: DataFrame, rule: NearDup) -> DataFrame:
    """Buckets ``band, key`` of at most about ``rule.together`` texts, in which any two linked texts of ``keys`` meet.

    Texts that are connected by ``rare_shared_shingles`` are one bundle, the others are linked to nothing.  A larger
    bundle is dealt out over slots, and any two slots are a bucket.
    """
    rare = cut_lineage(rare_shared_shingles(keys, texts, rule), "rare")
    hubs = rare.groupBy("shingle").agg(F.min("key").alias("a"))
    met = rare.join(hubs, "shingle").where(F.col("key") != F.col("a")).select("a", F.col("key").alias("b"))
    bundles = components(met)
    half = max(1, rule.together // 2)
    slots = F.when(F.col("n") > rule.together, F.ceil(F.col("n") / half)).otherwise(1)
    sizes = bundles.groupBy("component").agg(F.count(F.lit(1)).alias("n")).select("component", slots.cast("int").alias("slots"))
    slot = F.pmod(F.xxhash64("key"), F.col("slots")).cast("int")
    dealt = bundles.join(sizes, "component").withColumn("slot", slot)
    others = F.filter(F.sequence(F.lit(0), F.col("slots") - 1), lambda other: (F.col("slots") == 1) | (other != F.col("slot")))
    tiles = dealt.withColumn("other", F.explode(others))
    tile = F.concat_ws(":", F.hex("component"), F.least("slot", "other"), F.greatest("slot", "other"))
    return tiles.select(tile.alias("band"), "key")


def linked_together(buckets: DataFrame, texts: DataFrame, rule: NearDup) -> DataFrame:
    """Links ``a, b`` that connect what is linked inside small buckets ``band, key``.

    A bucket's texts are compared in one task, whose number ``rule.together`` bounds; buckets of the same texts are
    compared once.
    """
    lists = buckets.groupBy("band").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    once = lists.groupBy(F.sha2(F.array_join(F.transform("keys", F.hex), ""), 256).alias("bucket")).agg(F.first("keys").alias("keys"))
    rows = once.select("bucket", F.explode("keys").alias("key")).join(texts, "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in _groups(batches, "bucket"):
            links = connect(compare_block(pa.array(bucket["text"], pa.string()), rule.shingle), rule.least)
            columns = [pa.array([bucket["key"][link[end]] for link in links], pa.binary()) for end in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    dealt = rows.select("bucket", "key", "text").repartition(partitions(buckets), "bucket").sortWithinPartitions("bucket", "key")
    return dealt.mapInArrow(run, "a binary, b binary")


class Block(NamedTuple):
    """The shingles of a few texts, exact similarity of each two of their sets, and what their weighted similarity is at
    most: the share of either text's weight that is on shared shingles.  Where no weights differ it is known: 0 here.
    """

    texts: list[Shingles]
    similarity: np.ndarray
    most: np.ndarray

    def left_open(self, least: float) -> np.ndarray:
        """Pairs that only their weights may link."""
        return (self.similarity < least) & (self.most >= least - 1e-4)

    def weighted(self, a: int, b: int) -> float:
        return jaccard(self.texts[a], self.texts[b])[1]


def compare_block(column: pa.Array, size: int) -> Block:
    """Compare a few texts by products of blocks of the table of shared shingles."""
    texts = each_text(column, size)
    held = np.array([len(t.hashes) for t in texts], float)
    text = np.repeat(np.arange(len(texts)), held.astype(int))
    hashes = np.concatenate([np.zeros(0, np.uint64), *[t.hashes for t in texts]])
    share = np.concatenate([np.zeros(0), *[t.weights / t.weights.sum() for t in texts]])
    uneven = np.array([t.uneven for t in texts], bool)
    _, column_of, times = np.unique(hashes, return_inverse=True, return_counts=True)
    shared = times[column_of] > 1
    text, share, column_of = text[shared], share[shared], (np.cumsum(times > 1) - 1)[column_of[shared]]
    order = np.argsort(column_of, kind="stable")
    text, share, column_of = text[order], share[order], column_of[order]
    both, mass = np.zeros((2, len(held), len(held)))
    for low in range(0, int(column_of.max(initial=-1)) + 1, 4096):
        a, b = np.searchsorted(column_of, [low, low + 4096])
        table = np.zeros((len(held), 4096), np.float32)
        table[text[a:b], column_of[a:b] - low] = 1
        both += table @ table.T
        if uneven.any():
            weight = np.zeros((len(held), 4096), np.float32)
            weight[text[a:b], column_of[a:b] - low] = share[a:b]
            mass += weight @ table.T
    np.fill_diagonal(both, held)
    either = held[:, None] + held[None, :] - both
    similarity = np.where(either > 0, both / np.maximum(either, 1), 1.0)
    return Block(texts, similarity, np.where(uneven[:, None] | uneven[None, :], np.minimum(mass, mass.T), 0))


def connect(block: Block, least: float) -> list[tuple[int, int]]:
    """Links that connect the components of a block: those by sets first, then those by weights between what is apart."""
    links = spanning_tree(block.similarity >= least)
    part = np.arange(len(block.texts))
    for a, b in links:
        part[part == part[b]] = part[a]
    for a, b in np.argwhere(np.triu(block.left_open(least), 1)).tolist():
        if part[a] != part[b] and block.weighted(a, b) >= least:
            links.append((a, b))
            part[part == part[b]] = part[a]
    return links


def spanning_tree(near: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect the components of a relation, none that closes a circle."""
    left = np.ones(len(near), bool)
    links = []
    for first in range(len(near)):
        if not left[first]:
            continue
        left[first] = False
        waiting = [first]
        while waiting:
            at = waiting.pop()
            reached = np.flatnonzero(near[at] & left)
            left[reached] = False
            links += [(at, int(other)) for other in reached]
            waiting += reached.tolist()
    return links


def _apart(placed: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets in another component than the pivot: ``band, key``."""
    return _with_component(placed, labels).where(~F.col("together")).select("band", "key")


def _split(spokes: DataFrame, labels: DataFrame) -> DataFrame:
    """``key, pivot, similarity, weighted`` of compared texts, with ``inside``, whether the text is in the pivot's component,
    and ``joined``, whether it was not when ``spokes`` were split before."""
    was = F.col("inside") if "inside" in spokes.columns else F.lit(False)
    both = _with_component(spokes, labels).withColumn("joined", F.col("together") & ~was)
    return cut_lineage(both.select("key", "pivot", "similarity", "weighted", F.col("together").alias("inside"), "joined"), "spokes")


def _with_component(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """``together``: whether ``key`` and ``pivot`` are in one component."""
    of_key = labels.select("key", F.col("component").alias("own"))
    of_pivot = labels.select(F.col("key").alias("pivot"), F.col("component").alias("pivots"))
    both = pairs.join(of_key, "key", "left").join(of_pivot, "pivot", "left")
    return both.withColumn("together", F.coalesce("own", "key") == F.coalesce("pivots", "pivot"))


def _fringe_links(spokes: DataFrame, texts: DataFrame, rule: NearDup) -> DataFrame | None:
    """A link ``a, b`` for each text apart from its pivot that is linked to a text of the pivot's component; None if there
    is none.

    Left out are texts farther from the pivot, by sets and by weights, than the component's farthest text and a link
    together reach.  The others are compared with the texts of the component, in a later turn with those that
    ``joined`` it (pairs of a text and a pivot: a text may join one pivot and stay apart from another), in blocks of at
    most about ``rule.together`` texts: a task works out a block as a product of matrices and returns one link for a
    text.
    """
    inner, outer = spokes.where("joined"), spokes.where("NOT inside")
    measures = ("similarity", "weighted")
    by_sets, by_weights = [F.col(c) >= F.col(f"farthest_{c}") - (1 - rule.least) - 1e-9 for c in measures]
    farthest = [F.min(c).alias(f"farthest_{c}") for c in measures]
    sizes = inner.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), *farthest)
    blocks = outer.join(sizes, "pivot").where(by_sets | by_weights).groupBy("pivot", "n", *[f"farthest_{c}" for c in measures])
    half = rule.together / 2
    blocks = blocks.agg(F.ceil(F.count(F.lit(1)) / half).alias("rows")).withColumn("columns", F.ceil(F.col("n") / half))
    blocks = stored_small(blocks.drop("n"), "blocks", spokes.count())
    if blocks.isEmpty():
        return None

    def dealt(side: DataFrame, own: str, other: str, is_outer: bool):
        part = F.pmod(F.xxhash64("key"), F.col(own))
        each = side.withColumn(own, part)
        each = each.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)))
        return each.select("pivot", "rows", "columns", "key", F.lit(is_outer).alias("outer"))

    outer, inner = outer.join(blocks, "pivot").where(by_sets | by_weights), inner.join(blocks, "pivot")
    rows = dealt(outer, "rows", "columns", True).union(dealt(inner, "columns", "rows", False)).join(texts, "key")
    rows = rows.select(F.concat_ws(":", F.hex("pivot"), "rows", "columns").alias("block"), "key", "outer", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _groups(batches, "block"):
            keys, outside = block["key"], np.array(block["outer"])
            compare = compare_block(pa.array(block["text"], pa.string()), rule.shingle)
            inside, found = np.flatnonzero(~outside), []
            near, unknown = compare.similarity >= rule.least, compare.left_open(rule.least)
            for one in np.flatnonzero(outside).tolist():
                links = inside[near[one, inside]].tolist()
                weighed = (other for other in inside[unknown[one, inside]].tolist() if compare.weighted(one, other) >= rule.least)
                other = links[0] if links else next(weighed, None)
                if other is not None:
                    found.append((keys[one], keys[other]))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.binary()) for k in (0, 1)], ["a", "b"])

    spread = rows.repartition(partitions(spokes), "block").sortWithinPartitions("block", "key", "outer")
    links = cut_lineage(spread.mapInArrow(run, "a binary, b binary"), "fringe")
    return None if links.isEmpty() else links


def _groups(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[dict[str, list]]:
    """Rows of each value of a sorted column, as lists by column."""
    held: dict[str, list] = {}
    for batch in batches:
        names = batch.schema.names
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if held and held[by][-1] != row[names.index(by)]:
                yield held
                held = {}
            for name, value in zip(names, row):
                held.setdefault(name, []).append(value)
    if held:
        yield held


def near_duplicate_classes(
    docs: DataFrame, rule: NearDup = NearDup(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Class of every document: ``doc_id, class_id, text_key``; the class id is the least id in the class.

    Texts are in one class if a chain of links leads from one to the other; a link is a similarity of at least
    ``rule.least`` between their word shingles, weighted or as sets, or an equal text.  Copies are collapsed before anything is
    compared.  Null texts are empty; texts without words are linked to equal texts only; rows with one id keep their
    own classes; a class of rows without an id has a null id; an empty table gives no rows.
    """
    rows = keep(docs, doc_id=id_column, text=text_column)
    table = cut_lineage(band_table(rows, rule), "bands")
    # Equal texts have equal bands.
    firsts = cut_lineage(table.groupBy("key").agg(F.min("doc_id").alias("first_id"), F.first("bands").alias("bands")), "firsts")
    bands = firsts.select("key", F.explode(F.array_distinct("bands")).alias("band"))
    _, labels = link_texts(bands, rows, rule)
    by_text = cut_lineage(firsts.join(labels, "key", "left").select("key", "first_id", F.coalesce("component", "key").alias("component")), "texts")
    classes = by_text.groupBy("component").agg(F.min("first_id").alias("class_id"))
    of_text = by_text.join(classes, "component").select("key", "class_id")
    return table.select("doc_id", "key").join(of_text, "key").select("doc_id", "class_id", F.col("key").alias("text_key"))


def keep_one_of_each(docs: DataFrame, rule: NearDup = NearDup()) -> DataFrame:
    """The documents, with all their columns, whose id is the least of their class; of equal rows one.

    Rows without an id stay only where their class has no id at all, one of each text.
    """
    number, key = "__number", "__text_key"
    none = F.lit(-(1 << 63))
    classes = near_duplicate_classes(docs, rule).where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    first = classes.select(F.coalesce("doc_id", none).alias(number), F.col("text_key").alias(key)).distinct()
    keyed = docs.withColumns({number: F.coalesce(F.col("doc_id").cast("long"), none), key: text_key()})
    kept = keyed.join(first, [number, key], "left_semi")
    # The join has put equal rows together, so numbering them moves nothing.
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    turn = F.row_number().over(Window.partitionBy(number, key).orderBy(F.xxhash64(*others)))
    return kept.withColumn("__turn", turn).where("__turn = 1").select(*[F.col(f"`{c}`") for c in docs.columns])
