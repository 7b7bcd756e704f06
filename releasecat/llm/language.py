"""Language of a text by prediction by partial matching: code lengths under byte contexts of each language."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .text import keep, slices, utf8
from .toxicity import held_out

UNKNOWN = "und"
# Bytes of context at most, and bytes of text of each language that the statistics are taken from: the bound of the
# sample, above which rows are chosen by a hash of their text.
DEPTH = 4
TRAINING_BYTES = 2_000_000
# More languages than this are taken for a column that holds something else.
MOST_LANGUAGES = 400
# Bytes of text that count as independent when the code lengths are turned into a score.
_SCORED_BYTES = 40.0
_LETTER = re.compile(r"[^\W\d_]")
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)


class Table:
    """Places of 64-bit keys in an array, found without a loop over keys."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(8, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.keys = np.full(1 << self.bits, np.iinfo(np.uint64).max, np.uint64)
        self.rows = np.zeros(1 << self.bits, np.int32)
        self.rounds = 0
        left = np.arange(len(keys))
        for self.rounds, _ in enumerate(_MULTIPLIERS, 1):
            slot = self._slot(keys[left], self.rounds - 1)
            free = self.keys[slot] == np.iinfo(np.uint64).max
            self.keys[slot[free]] = keys[left[free]]
            self.rows[slot[free]] = left[free]
            left = left[self.keys[slot] != keys[left]]
            if not len(left):
                break
        order = left[np.argsort(keys[left])]
        self.rest, self.rest_rows = keys[order], order.astype(np.int32)

    def _slot(self, keys: np.ndarray, turn: int) -> np.ndarray:
        return ((keys * np.uint64(_MULTIPLIERS[turn])) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where it is not in the table."""
        slot = self._slot(keys, 0)
        held = self.keys[slot]
        rows = np.where(held == keys, self.rows[slot], -1)
        open_ = np.flatnonzero((held != keys) & (held != np.iinfo(np.uint64).max))
        for turn in range(1, self.rounds):
            slot = self._slot(keys[open_], turn)
            held = self.keys[slot]
            hit = held == keys[open_]
            rows[open_[hit]] = self.rows[slot[hit]]
            open_ = open_[~hit & (held != np.iinfo(np.uint64).max)]
        if len(self.rest) and len(open_):
            place = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            hit = self.rest[place] == keys[open_]
            rows[open_[hit]] = self.rest_rows[place[hit]]
        return rows


class Order(NamedTuple):
    """Statistics of one context length: strings seen in any language with their cost in each, and contexts seen in
    any language with the cost of an escape in each (none where the language has not seen the context)."""

    strings: np.ndarray
    costs: np.ndarray
    contexts: np.ndarray
    escapes: np.ndarray


class Model(NamedTuple):
    languages: tuple[str, ...]
    orders: tuple[Order, ...]


def byte_strings(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``length`` bytes up to each byte as one number, and whether they lie in one text."""
    keys = np.zeros(len(data), np.uint64)
    wide = data.astype(np.uint64)
    for back in range(length):
        keys[back:] |= wide[: len(data) - back] << np.uint64(8 * back)
    begin = np.repeat(offsets[:-1], np.diff(offsets))
    return keys, np.arange(len(data)) - begin + 1 >= length


def training_texts(docs: DataFrame, limit: int = TRAINING_BYTES) -> DataFrame:
    """Rows to learn from, stored: ``lang, text`` of about ``limit`` bytes of each language, or of all if it has fewer."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id")).select("lang", "text")
    sizes = known.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes")).where(F.col("bytes") > 0)
    shares = sizes.limit(MOST_LANGUAGES + 1).collect()
    if len(shares) > MOST_LANGUAGES:
        raise ValueError(f"lang has more than {MOST_LANGUAGES} values")
    chances = {r.lang: int(min(1.0, limit / r.bytes) * (1 << 30)) for r in shares}
    below = F.lit(0)
    for lang, chance in sorted(chances.items()):
        below = F.when(F.col("lang") == lang, chance).otherwise(below)
    return cut_lineage(known.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < below), "language-texts")


def string_counts(texts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """How often each byte string of 1 to ``depth + 1`` bytes is in the texts of a language: ``lang, length, key, n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.array(batch.column("lang").to_pylist(), object)
            for lang in sorted(set(names)):
                chosen = batch.filter(pa.array(names == lang))
                for part in slices(chosen):
                    offsets, data = utf8(part.column("text"))
                    for length in range(1, depth + 2):
                        keys, inside = byte_strings(data, offsets, length)
                        values, counts = np.unique(keys[inside], return_counts=True)
                        columns = [
                            pa.array([lang] * len(values), pa.string()),
                            pa.array(np.full(len(values), length, np.int32)),
                            pa.array(values.view(np.int64)),
                            pa.array(counts, pa.int64()),
                        ]
                        yield pa.RecordBatch.from_arrays(columns, ["lang", "length", "key", "n"])

    counted = texts.mapInArrow(run, "lang string, length int, key long, n long")
    return counted.groupBy("lang", "length", "key").agg(F.sum("n").alias("n"))


def freeze(lang: np.ndarray, length: np.ndarray, key: np.ndarray, n: np.ndarray) -> Model:
    """Costs in bits from counts.  A byte seen n times in a context of N bytes and T different ones costs
    ``-log2(n / (N + T))``; an escape to the context one byte shorter costs ``-log2(T / (N + T))``; a byte never seen
    at all costs 8 bits.  A context not seen is left without a cost."""
    languages = tuple(sorted(set(lang.tolist())))
    number = {name: i for i, name in enumerate(languages)}
    which = np.array([number[x] for x in lang.tolist()], np.int64)
    orders: list[Order] = []
    for size in range(1, int(length.max(initial=0)) + 1):
        rows = length == size
        keys, count, of = key[rows].view(np.uint64), n[rows].astype(float), which[rows]
        strings, at = np.unique(keys, return_inverse=True)
        seen = np.zeros((len(strings), len(languages)))
        seen[at, of] = count
        contexts, inside = np.unique(strings >> np.uint64(8), return_inverse=True)
        total = np.zeros((len(contexts), len(languages)))
        kinds = np.zeros((len(contexts), len(languages)))
        np.add.at(total, inside, seen)
        np.add.at(kinds, inside, seen > 0)
        whole = total + kinds
        with np.errstate(divide="ignore", invalid="ignore"):
            escapes = np.where(whole > 0, -np.log2(kinds / whole), 0.0)
            direct = -np.log2(seen / whole[inside])
        if orders:
            shorter = orders[-1]
            suffix = strings & np.uint64((1 << 8 * (size - 1)) - 1)
            lower = shorter.costs[np.searchsorted(shorter.strings, suffix)]
        else:
            lower = np.full((len(strings), len(languages)), 8.0)
        costs = np.where(seen > 0, direct, escapes[inside] + lower)
        orders.append(Order(strings, costs.astype(np.float32), contexts, escapes.astype(np.float32)))
    return Model(languages, tuple(orders))


class Scorer:
    """Code length in bits of texts under every language of a model."""

    def __init__(self, model: Model):
        self.model = model
        self.tables = [(Table(o.strings), Table(o.contexts)) for o in model.orders]

    def byte_costs(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        depth = len(self.model.orders)
        keys, _ = byte_strings(data, offsets, depth)
        begin = np.repeat(offsets[:-1], np.diff(offsets))
        have = np.minimum(np.arange(len(data)) - begin + 1, depth)
        costs = np.zeros((len(data), len(self.model.languages)), np.float32)
        left = np.arange(len(data))
        for size in range(depth, 0, -1):
            order, (strings, contexts) = self.model.orders[size - 1], self.tables[size - 1]
            able = have[left] >= size
            tried = left[able]
            key = keys[tried] & np.uint64((1 << 8 * size) - 1)
            row = strings.find(key)
            hit = row >= 0
            costs[tried[hit]] += order.costs[row[hit]]
            missed = tried[~hit]
            context = contexts.find(key[~hit] >> np.uint64(8))
            known = context >= 0
            costs[missed[known]] += order.escapes[context[known]]
            left = np.concatenate([left[~able], missed])
        costs[left] += 8.0
        return costs

    def lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text (rows) under each language (columns)."""
        result = np.zeros((len(offsets) - 1, len(self.model.languages)))
        full = np.flatnonzero(np.diff(offsets))
        if len(full):
            result[full] = np.add.reduceat(self.byte_costs(data, offsets), offsets[full], axis=0, dtype=np.float64)
        return result


def learn_languages(docs: DataFrame, depth: int = DEPTH, limit: int = TRAINING_BYTES) -> Model:
    """Model of every language among the rows that are not held out.

    Strings are counted in tasks; the driver gets the counts, whose number the bound of the sample limits.
    """
    counts = string_counts(training_texts(docs, limit), depth).toPandas()
    return freeze(*(counts[c].to_numpy() for c in ("lang", "length", "key", "n")))


def identify_languages(
    docs: DataFrame, depth: int = DEPTH, limit: int = TRAINING_BYTES, model: Model | None = None
) -> DataFrame:
    """Language of every whole text: ``doc_id, held_out, lang_pred, score, bits_per_byte``.

    The language with the shortest code is predicted; the score compares its code length for 40 bytes of the text
    with those of the others.  A text that is null or has no letter is ``und`` with score 0, and so is every text if
    there is nothing to learn from.  Of equal code lengths the first language in order is taken.  Repeated rows stay;
    an empty table gives no rows.
    """
    rows = keep(docs, doc_id="doc_id", text="text", lang="lang")
    learned = learn_languages(rows, depth, limit) if model is None else model
    shared = rows.sparkSession.sparkContext.broadcast(learned)
    scorers: list[Scorer] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not scorers:
            scorers.append(Scorer(shared.value))
        scorer = scorers[0]
        names = np.array([*scorer.model.languages, UNKNOWN], object)
        for batch in batches:
            for part in slices(batch):
                offsets, data = utf8(part.column("text"))
                letters = np.array([bool(t and _LETTER.search(t)) for t in part.column("text").to_pylist()])
                best = np.full(len(part), len(names) - 1)
                score, rate = np.zeros(len(part)), np.zeros(len(part))
                if len(names) > 1 and letters.any():
                    bits = scorer.lengths(data, offsets) / np.maximum(1, np.diff(offsets))[:, None]
                    odds = np.exp2(-_SCORED_BYTES * (bits - bits.min(1, keepdims=True)))
                    best[letters] = bits.argmin(1)[letters]
                    score[letters] = (1 / odds.sum(1))[letters]
                    rate[letters] = bits.min(1)[letters]
                columns = [part.column("doc_id"), pa.array(names[best], pa.string()), pa.array(score), pa.array(rate)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "bits_per_byte"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, bits_per_byte double")
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "bits_per_byte")
