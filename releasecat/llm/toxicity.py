"""Toxicity by a weighted lexicon, matched in folded text by an Aho-Corasick automaton."""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .text import keep, partitions, shingles, utf8, words

# Characters that are drawn like a Latin letter, and digits and signs that are typed in place of one.
LOOKALIKES = str.maketrans("аеоркхсуіјѕԁһмтвнαεοικνρτυχ", "aeopkxcyijsdhmtbhaeoiknptux")
DIGITS = dict(zip("0134578@$", "oieastbas"))
# Words that stand for no label at all: the lexicon where nothing can be learned.
SEED = ("idiot", "moron", "scum", "stupid", "worthless")
# Phrases in which a word of the lexicon is meant otherwise.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "pathetic fallacy", "stupid mistake of mine", "sore loser bracket")

# Similarity from which on two labelled texts count as one.
COPY_SHARE = 0.8

_TABLE = bytearray(b" " * 256)
for _code in range(256):
    if chr(_code).isascii() and chr(_code).isalpha():
        _TABLE[_code] = ord(chr(_code).lower())
    elif _code >= 128:
        _TABLE[_code] = _code
for _sign, _letter in DIGITS.items():
    _TABLE[ord(_sign)] = ord(_letter)
_TABLE = bytes(_TABLE)


class Lexicon(NamedTuple):
    """Patterns, each with a space before its first letter (and after its last one if only the whole word counts),
    their weights, and the weight of a text without any."""

    patterns: tuple[str, ...]
    weights: tuple[float, ...]
    bias: float
    exceptions: tuple[str, ...] = EXCEPTIONS


class Fit(NamedTuple):
    """How a lexicon is learned.

    ``rows`` bounds the labelled rows it is fitted to (all if there are fewer); a pattern must be in ``least_rows``
    of the toxic ones and in ``least_share`` of them and have ``least_weight``, and a toxic row counts towards new
    patterns until ``cover`` of them are in it.
    """

    rows: int = 20_000
    least_rows: int = 3
    least_share: float = 0.004
    least_weight: float = 2.5
    cover: int = 8
    patterns: int = 400
    bias: float = -3.0


def fold(text: str) -> str:
    """Lower case, lookalikes and digits as letters, anything between words as spaces; one space on either side."""
    lowered = text.lower()
    if not lowered.isascii():
        lowered = lowered.translate(LOOKALIKES) if max(lowered) > "ÿ" else lowered
    return " " + lowered.encode("utf-8", "replace").translate(_TABLE).decode("utf-8", "replace") + " "


def word_patterns(folded: str) -> set[str]:
    """Every word, and every start of a word of 3 to 10 letters."""
    found = set()
    for word in set(folded.split()):
        found.add(f" {word} ")
        found.update(f" {word[:n]}" for n in range(3, min(len(word), 10) + 1))
    return found


class Matcher:
    """Counts patterns in texts; occurrences inside an exception phrase do not count."""

    def __init__(self, patterns: tuple[str, ...], exceptions: tuple[str, ...] = ()):
        self.automaton = ahocorasick.Automaton()
        for number, pattern in enumerate(patterns):
            self.automaton.add_word(pattern, (number, len(pattern)))
        for phrase in exceptions:
            if f" {phrase} " not in self.automaton:
                self.automaton.add_word(f" {phrase} ", (-1, len(phrase) + 2))
        self.some = len(self.automaton) > 0
        if self.some:
            self.automaton.make_automaton()

    def count(self, folded: str) -> dict[int, int]:
        if not self.some:
            return {}
        found = [(end - length + 1, end, number) for end, (number, length) in self.automaton.iter(folded)]
        spared = [(start, end) for start, end, number in found if number < 0]
        hits: Counter = Counter()
        for start, end, number in found:
            if number >= 0 and not any(a <= start and end <= b for a, b in spared):
                hits[number] += 1
        return hits


def feature(hits: int, letters: int) -> float:
    """What some occurrences of a pattern count in a text: less for each further one and in a longer text."""
    return hits / (hits + 1.0) * 2.0 / (1.0 + 0.1 * math.log1p(letters / 500))


def score(lexicon: Lexicon, matcher: Matcher, text: str | None) -> float:
    folded = fold(text or "")
    total = lexicon.bias
    for number, hits in sorted(matcher.count(folded).items()):
        total += lexicon.weights[number] * feature(hits, len(folded))
    return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, total))))


def held_out(id_column: str) -> Column:
    """Whether a row is kept from learning: its id's CRC-32 leaves 1 when divided by 3.  No id: it is not."""
    text = F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 3 == 1


def training_rows(docs: DataFrame, labels: DataFrame, fit: Fit) -> DataFrame:
    """Labelled rows that are not held out, at most about ``fit.rows``: ``toxic, text``, stored.

    A row is chosen by the hash of its id, so the choice does not depend on how the table is cut.  The chosen labels,
    whose number the parameter bounds, are broadcast; the texts are not shuffled.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out("doc_id"))
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    share = min(1.0, fit.rows / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = docs.join(F.broadcast(chosen), "doc_id").select("toxic", F.coalesce("text", F.lit("")).alias("text"))
    return cut_lineage(rows, "toxicity-rows")


def learn_lexicon(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> Lexicon:
    """Lexicon and weights from the labelled documents that are not held out.

    Of near copies with one label one row counts, on either side.  Patterns of the toxic rows are counted in tasks,
    then those frequent enough in the clean rows.  Among patterns likelier in toxic rows those are taken that
    are in the most rows not yet covered, weighted by how much likelier they are.  Without rows of both kinds the
    seed words are returned.
    """
    rows = cut_lineage(without_copies(training_rows(docs, labels, fit)), "toxicity-rows")
    sizes = {r.toxic: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return Lexicon(tuple(f" {w} " for w in SEED), (4.0,) * len(SEED), -3.0)
    least = max(fit.least_rows, math.ceil(fit.least_share * sizes[True]))

    def in_toxic(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update(word_patterns(fold(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["pattern", "n"])

    toxic = rows.where("toxic").mapInArrow(in_toxic, "pattern string, n long")
    frequent = {
        r.pattern: r.total for r in toxic.groupBy("pattern").agg(F.sum("n").alias("total")).where(F.col("total") >= least).collect()
    }
    wanted = frozenset(frequent)

    def in_clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update(word_patterns(fold(text)) & wanted)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["pattern", "n"])

    clean_rows = rows.where("NOT toxic").mapInArrow(in_clean, "pattern string, n long")
    clean = {r.pattern: r.total for r in clean_rows.groupBy("pattern").agg(F.sum("n").alias("total")).collect()}
    weights = {p: weight(n, clean.get(p, 0), sizes[True], sizes[False]) for p, n in frequent.items()}
    strong = _settled(sorted(p for p, w in weights.items() if w >= fit.least_weight), frequent, clean)
    chosen = _cover(_patterns_of_toxic(rows, Matcher(tuple(strong))), len(strong), least, fit)
    patterns = tuple(strong[i] for i in chosen)
    return Lexicon(patterns, tuple(weights[p] for p in patterns), fit.bias)


def weight(toxic: int, clean: int, toxic_rows: int, clean_rows: int) -> float:
    """Cautious logarithm of how much likelier a pattern is in toxic rows: two deviations of each count against it."""
    low = max(0.0, toxic - 2 * math.sqrt(toxic)) + 0.5
    high = clean + 2 * math.sqrt(clean) + 0.5
    return math.log(low / (toxic_rows + 1)) - math.log(high / (clean_rows + 1))


def copy_keys(texts: pa.Array) -> np.ndarray:
    """For each text the smallest hash of five words in it, which near copies mostly share; of a text with fewer words
    the hash of its folded words."""
    found = words(*utf8(texts))
    values, at = shingles(found, 5)
    least = np.zeros(len(texts), np.uint64)
    least[:] = np.iinfo(np.uint64).max
    np.minimum.at(least, found.text[at], values)
    for number in np.flatnonzero(np.diff(found.first) < 5).tolist():
        folded = " ".join(fold(texts[number].as_py() or "").split())
        least[number] = int.from_bytes(hashlib.blake2b(folded.encode(), digest_size=8).digest(), "little")
    return least.view(np.int64)


def word_runs(text: str) -> frozenset[tuple[str, ...]]:
    """Every five words of a folded text; all its words if there are fewer."""
    parts = fold(text).split()
    return frozenset(tuple(parts[n : n + 5]) for n in range(max(1, len(parts) - 4)))


def without_copies(rows: DataFrame) -> DataFrame:
    """One row of each label and near copies: ``toxic, text``.

    Copies are looked for among texts with one copy key; a text is a copy of an earlier one if their runs of five
    words have a Jaccard similarity of at least ``COPY_SHARE``.
    """

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("copy", pa.array(copy_keys(batch.column("text")), pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, first, kept = None, None, []
        for batch in batches:
            stay = []
            for toxic, text, copy in zip(*[batch.column(c).to_pylist() for c in ("toxic", "text", "copy")], strict=True):
                if (toxic, copy) != group:
                    group, first, kept = (toxic, copy), text, []
                    stay.append(True)
                    continue
                own, kept = word_runs(text), kept or [word_runs(first)]
                known = text == first or any(_alike(own, other) for other in kept)
                stay.append(not known)
                if not known:
                    kept.append(own)
            yield batch.select(["toxic", "text"]).filter(pa.array(stay, pa.bool_()))

    keyed = rows.mapInArrow(key, "toxic boolean, text string, copy long")
    dealt = keyed.repartition(partitions(rows), "toxic", "copy").sortWithinPartitions("toxic", "copy", "text")
    return dealt.mapInArrow(run, "toxic boolean, text string")


def _alike(a: frozenset, b: frozenset) -> bool:
    if min(len(a), len(b)) < COPY_SHARE * max(len(a), len(b)):
        return False
    shared = len(a & b)
    return shared >= COPY_SHARE * (len(a) + len(b) - shared)


def _settled(patterns: list[str], toxic: dict[str, int], clean: dict[str, int]) -> list[str]:
    """One pattern of each chain of starts: the longest that still finds what a shorter one does, and none that
    begins with one at least as exact."""
    known = set(patterns)
    longer_does = {p[:-1] for p in patterns if p[:-1] in known and toxic[p] >= 0.95 * toxic[p[:-1]]}
    known -= longer_does
    kept = []
    for p in patterns:
        starts = [p[:n] for n in range(4, len(p)) if p[:n] in known]
        if p in known and not any(clean.get(s, 0) <= clean.get(p, 0) + 0.02 * toxic[s] for s in starts):
            kept.append(p)
    return kept


def _patterns_of_toxic(rows: DataFrame, matcher: Matcher) -> list[list[int]]:
    """Patterns in each toxic fitted row, the number of which is bounded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(matcher.count(fold(t))) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32()))], ["numbers"])

    return sorted(r.numbers for r in rows.where("toxic").mapInArrow(run, "numbers array<int>").collect())


def _cover(toxic: list[list[int]], patterns: int, least: int, fit: Fit) -> list[int]:
    """Patterns in order of how many toxic rows they add to that hold fewer than ``fit.cover`` chosen ones."""
    holders: list[list[int]] = [[] for _ in range(patterns)]
    for row, numbers in enumerate(toxic):
        for n in numbers:
            holders[n].append(row)
    held = [0] * len(toxic)
    left, chosen = set(range(patterns)), []
    while left and len(chosen) < fit.patterns:
        gains = {n: sum(held[row] < fit.cover for row in holders[n]) for n in left}
        best = min(left, key=lambda n: (-gains[n], n))
        if gains[best] < least:
            break
        chosen.append(best)
        left = {n for n in left if gains[n] >= least and n != best}
        for row in holders[best]:
            held[row] += 1
    return chosen


def score_toxicity(docs: DataFrame, lexicon: Lexicon, text_column: str = "text", name: str = "toxicity") -> DataFrame:
    """The same rows and columns with a score from 0 to 1 under ``name``; null texts are scored as empty ones."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon.patterns, lexicon.exceptions)
        for batch in batches:
            place = batch.schema.names.index(text_column)
            scores = [score(lexicon, matcher, t) for t in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def find_toxic(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), least: float = 0.7) -> DataFrame:
    """Score of every text under a lexicon learned from the labels: ``doc_id, held_out, score, predicted``.

    Labels of one id count as toxic if any does; null labels are none.  Null and empty texts have the score of a text
    without any pattern; repeated rows stay; an empty table gives no rows.
    """
    rows = keep(docs, doc_id="doc_id", text="text")
    lexicon = learn_lexicon(rows, keep(labels, doc_id="doc_id", toxic="toxic"), fit)
    scored = score_toxicity(rows, lexicon, name="score")
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted")
    )


def reject_toxic(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), least: float = 0.7) -> DataFrame:
    """The documents, with all their columns, that are scored below ``least``."""
    lexicon = learn_lexicon(keep(docs, doc_id="doc_id", text="text"), keep(labels, doc_id="doc_id", toxic="toxic"), fit)
    name = "__toxicity"
    return score_toxicity(docs, lexicon, name=name).where(F.col(name) < least).drop(name)
