"""Packing of token streams into sequences by order-preserving dynamic programming."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import binaries, keep, partitions, slices
from .tokens import tokenizer

# Cost of a cut, in padding tokens: between documents, between sentences, anywhere else.
SENTENCE_CUT, OTHER_CUT = 8, 64
# A stretch without sentence ends may also be cut at these distances, less in a short window.
_STEP = 256
# Tokens planned at once; the last sequence of a plan is planned again with what follows.
_PLANNED = 1 << 20
_BLOCK_BITS = 40

PIECE_SCHEMA = "doc_id {id}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def choose_cuts(places: np.ndarray, costs: np.ndarray, window: int) -> list[int]:
    """Cuts of least cost: indexes into ``places``, from 0 to the last.

    ``places`` ascend from 0 and lie at most ``window`` apart.  A window from cut i to cut j costs its padding,
    ``window - places[j] + places[i]``, and ``costs[j]``.  The best i for each j is the least of
    ``best[i] + places[i]`` over a sliding range of i, which a monotone queue keeps at its front.
    """
    at, cost = places.tolist(), costs.tolist()
    before = [0] * len(at)
    queue = deque([(0, 0)])  # index, best cost plus place; the second ascends
    for j in range(1, len(at)):
        here = at[j]
        while at[queue[0][0]] < here - window:
            queue.popleft()
        i, value = queue[0]
        before[j] = i
        total = value + window + cost[j]
        while queue and queue[-1][1] >= total:
            queue.pop()
        queue.append((j, total))
    cuts = [len(at) - 1]
    while cuts[-1]:
        cuts.append(before[cuts[-1]])
    return cuts[::-1]


def candidates(total: int, documents: np.ndarray, sentences: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places for cuts in a stretch of ``total`` tokens and their costs; neighbours lie at most ``window`` apart."""
    cost = {0: 0, total: 0}
    step = max(1, min(_STEP, window // 8))
    known = np.unique(np.concatenate([[0], documents, sentences, [total]]))
    wide = np.flatnonzero(np.diff(known) > step)
    extra = [np.arange(known[i] + step, known[i + 1], step) for i in wide]
    places = np.unique(np.concatenate([known, *extra])).astype(np.int64)
    costs = np.full(len(places), OTHER_CUT, np.int64)
    costs[np.searchsorted(places, sentences)] = SENTENCE_CUT
    costs[np.searchsorted(places, documents)] = 0
    costs[[0, -1]] = [cost[0], cost[total]]
    return places, costs


class Packer:
    """Plans a block of documents, given in order, and returns its pieces as they are settled."""

    def __init__(self, window: int, planned: int, block: int):
        self.window, self.planned = window, planned
        self.sequence = block << _BLOCK_BITS
        self.ids = np.zeros(0, np.uint32)
        self.sentences = np.zeros(0, np.int64)
        # Of each document not settled: its row, where it begins among the pending ids (negative: before), its length.
        self.row: list = []
        self.begin = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)

    def add(self, rows: list, tokens) -> None:
        begin = len(self.ids) + np.cumsum(tokens.counts) - tokens.counts
        self.sentences = np.concatenate([self.sentences, tokens.ends + len(self.ids)])
        self.begin = np.concatenate([self.begin, begin])
        self.length = np.concatenate([self.length, tokens.counts])
        self.row += rows
        self.ids = np.concatenate([self.ids, tokens.ids])

    def settle(self, last: bool) -> dict | None:
        """Pieces of the sequences that are settled: all of them at the end, else all but the last."""
        total = len(self.ids)
        if not total or not last and total < self.planned:
            return None
        inner = (self.begin > 0) & (self.begin < total)
        sentences = self.sentences[(self.sentences > 0) & (self.sentences < total)]
        places, costs = candidates(total, self.begin[inner], sentences, self.window)
        cuts = places[choose_cuts(places, costs, self.window)]
        if not last:
            cuts = cuts[:-1]
        done = int(cuts[-1])
        starts = np.unique(np.concatenate([cuts, self.begin[(self.begin > 0) & (self.begin < done)]]))
        begins, ends = starts[:-1], starts[1:]
        document = np.searchsorted(self.begin, begins, "right") - 1
        sequence = np.searchsorted(cuts, begins, "right") - 1
        pieces = {
            "doc_id": [self.row[d] for d in document],
            "start": begins - self.begin[document],
            "length": ends - begins,
            "ids": binaries(self.ids[:done].astype("<u4"), starts),
            "doc_tokens": self.length[document],
            "sequence_id": self.sequence + sequence,
            "offset": begins - cuts[sequence],
        }
        self.sequence += len(cuts) - 1
        held = int(np.searchsorted(self.begin + self.length, done, "right"))
        self.row = self.row[held:]
        self.begin, self.length = self.begin[held:] - done, self.length[held:]
        self.sentences = self.sentences[self.sentences > done] - done
        self.ids = self.ids[done:]
        return pieces


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    window: int = 4096,
    end_id: int | None = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
    blocks: int | None = None,
) -> DataFrame:
    """Tokens of all documents, in order of their ids, cut into sequences of at most ``window`` tokens.

    Returns one row for each piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``; ``ids`` are the
    piece's token ids as little-endian 32-bit numbers.  Cuts lie between documents or sentences where that costs less
    than the padding; a stretch without sentence ends may be cut inside.  Documents are dealt out in ranges of ids,
    one block each; every block is planned in stretches, so a task holds a stretch and no more.  Each block ends with
    one sequence that may be short.

    Null and empty texts are an end id alone (without an end id they give no row), rows with null or equal ids are
    packed as documents of their own, and an empty table gives no rows.
    """
    rows = keep(docs, doc_id=id_column, text=text_column)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(vocabulary, end_id)
        packer = Packer(window, _PLANNED, TaskContext.get().partitionId())

        def settled(last: bool) -> Iterator[pa.RecordBatch]:
            pieces = packer.settle(last)
            if pieces is not None:
                whole = pa.RecordBatch.from_pydict(pieces, schema=schema)
                for start in range(0, len(whole), 4096):
                    yield whole.slice(start, 4096)

        schema = None
        for batch in batches:
            schema = schema or pa.schema(
                [("doc_id", batch.schema.field("doc_id").type), ("start", pa.int64()), ("length", pa.int64()),
                 ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
            )
            for part in slices(batch):
                packer.add(part.column("doc_id").to_pylist(), words.encode(part.column("text").to_pylist()))
                yield from settled(False)
        if schema is not None:
            yield from settled(True)

    ordered = rows.repartitionByRange(blocks or partitions(rows), "doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(pack, PIECE_SCHEMA.format(id=kind)).where(F.col("length") > 0)
