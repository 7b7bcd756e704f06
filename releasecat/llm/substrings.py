"""Exact removal of repeated byte strings, by suffix sorting of what may repeat."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .text import binaries, keep, partitions, prefix_hashes, slices, span_hashes, utf8

# Bytes of a repeated string and of the gram that stands for it.
LENGTH, GRAM = 100, 32
_CONTEXT_BASE = 0xC2B2AE3D27D4EB4F
# Runs a task combines before it hands them on, and bytes of contexts it sorts together.
_COMBINED, _SORTED_BYTES = 200_000, 1 << 17
# Contexts of one gram that a task sorts; a gram with more has its windows counted one by one across all tasks.
MOST_CONTEXTS = 100_000
_MARK, _SORT, _SPREAD = 0, 1, 2
# A run on its way to the task of its gram.
_RUN = np.dtype([("gram", "<u8"), ("context", "<u8"), ("doc", "<i8"), ("tie", "<i8"), ("start", "<i4"), ("lead", "<i4"), ("count", "<i4")])


class Stretches(NamedTuple):
    """Runs of window starts that share an anchor, the place of the least gram in each of these windows.

    ``gram`` is the anchor's hash, ``context`` that of all bytes of the run's windows; the run begins at ``start`` of
    the text numbered ``text``, has its anchor ``lead`` bytes further on and ``count`` windows.
    """

    gram: np.ndarray
    context: np.ndarray
    text: np.ndarray
    start: np.ndarray
    lead: np.ndarray
    count: np.ndarray


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbouring values: least of a block's tail and of the next block's head."""
    count = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    table = padded.reshape(blocks, width)
    heads = np.minimum.accumulate(table, axis=1).ravel()
    tails = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tails[:count], heads[width - 1 : width - 1 + count])


def stretches(offsets: np.ndarray, data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> Stretches:
    """All windows of ``length`` bytes inside the texts, in runs by anchor.

    Equal windows have their anchors at the same distance, as the window's bytes alone decide: the least gram hash,
    the first of equal ones.
    """
    size = len(data)
    if size < length:
        return Stretches(*[np.zeros(0, np.uint64)] * 2, *[np.zeros(0, np.int64)] * 4)
    sums = prefix_hashes(data)
    at = np.arange(size - gram + 1)
    grams = span_hashes(sums, at, at + gram)
    bits = np.uint64(size.bit_length())
    ranked = (grams >> bits << bits) | at.astype(np.uint64)
    anchor = (sliding_least(ranked, length - gram + 1) & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(anchor)]
    inside = np.arange(len(anchor)) + length <= offsets[1:][text]
    first = inside.copy()
    first[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1] | (text[1:] != text[:-1])
    last = inside.copy()
    last[:-1] &= first[1:] | ~inside[1:]
    start, stop = np.flatnonzero(first), np.flatnonzero(last)
    contexts = prefix_hashes(data, _CONTEXT_BASE)
    return Stretches(
        grams[anchor[start]],
        span_hashes(contexts, start, stop + length, _CONTEXT_BASE),
        text[start],
        start - offsets[text[start]],
        anchor[start] - start,
        stop - start + 1,
    )


def suffix_order(symbols: list[int]) -> list[int]:
    """Suffix array by linear grouping.  The last symbol must be the least and stand nowhere else.

    First, suffixes are grouped by their longest prefix that is a Lyndon word.  Groups start out as first symbols and
    are finished from the greatest down: a suffix of the finished group lengthens the prefix of the previous smaller
    suffix, which moves to the top of its own group, the higher the more often the finished prefix follows it.  Then,
    from the least suffix up, every suffix whose prefix ends where a placed suffix begins takes the next place of its
    group; these are the suffixes on the way along the pointers until one that is placed already.
    """
    size = len(symbols)
    order = sorted(range(size), key=symbols.__getitem__)
    group, width, at = [0] * size, [0] * size, [0] * size
    start = 0
    for place, suffix in enumerate(order):
        if symbols[suffix] != symbols[order[start]]:
            start = place
        group[suffix] = start
        width[start] += 1
        at[suffix] = place

    smaller = [-1] * size
    stop = size
    while stop:
        first = group[order[stop - 1]]
        follows: dict[int, int] = {}
        for suffix in sorted(order[first:stop]):
            before = suffix - 1
            while before >= 0 and group[before] >= first:
                before = smaller[before]
            smaller[suffix] = before
            if before >= 0:
                follows[before] = follows.get(before, 0) + 1
        stop = first
        for count in range(max(follows.values(), default=0), 0, -1):
            raised: dict[int, list[int]] = {}
            for suffix, times in follows.items():
                if times == count:
                    raised.setdefault(group[suffix], []).append(suffix)
            for old, suffixes in raised.items():
                top = old + width[old]
                new = top - len(suffixes)
                if new == old:
                    continue
                for suffix in suffixes:
                    top -= 1
                    other, place = order[top], at[suffix]
                    order[place], at[other] = other, place
                    order[top], at[suffix] = suffix, top
                    group[suffix] = new
                width[new] = len(suffixes)
                width[old] -= len(suffixes)

    result = [size - 1] * size
    free = list(range(size))
    placed = [False] * (size - 1) + [True]
    for place in range(size):
        suffix = result[place] - 1
        while suffix >= 0 and not placed[suffix]:
            own = group[suffix]
            result[free[own]] = suffix
            free[own] += 1
            placed[suffix] = True
            suffix = smaller[suffix]
    return result


def place_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc, tie, text``: a number and 64 bits of the text's SHA-256 that put rows in order; no id comes before all ids."""
    rows = keep(docs, doc=F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(-(1 << 63))), text=F.coalesce(F.col(f"`{text_column}`"), F.lit("")))
    return rows.select("doc", F.xxhash64(F.sha2("text", 256)).alias("tie"), "text")


def _runs(part: pa.RecordBatch, length: int) -> np.ndarray:
    found = stretches(*utf8(part.column("text")), length, min(GRAM, length))
    runs = np.zeros(len(found.gram), _RUN)
    for name in ("gram", "context", "start", "lead", "count"):
        runs[name] = getattr(found, name)
    for name in ("doc", "tie"):
        runs[name] = part.column(name).to_numpy(zero_copy_only=False)[found.text]
    return runs


def settle_runs(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The earliest run of each gram and context, in that order, and the runs that come after an equal one."""
    runs = runs[np.lexsort((runs["start"], runs["tie"], runs["doc"], runs["context"], runs["gram"]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs["gram"][1:] != runs["gram"][:-1]) | (runs["context"][1:] != runs["context"][:-1])
    earliest = runs[new][np.cumsum(new) - 1] if len(runs) else runs
    later = (runs["doc"] != earliest["doc"]) | (runs["tie"] != earliest["tie"]) | (runs["start"] != earliest["start"])
    return runs[new], runs[later]


def _spans(doc: np.ndarray, tie: np.ndarray, start: np.ndarray, stop: np.ndarray) -> dict[str, np.ndarray]:
    """Spans of documents with those that touch made one; a later start has a later stop."""
    order = np.lexsort((stop, start, tie, doc))
    doc, tie, start, stop = doc[order], tie[order], start[order], stop[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (start[1:] > stop[:-1])
    last = np.append(np.flatnonzero(new)[1:], len(doc))[: new.sum()] - 1
    return {"doc": doc[new], "tie": tie[new], "start": start[new], "stop": stop[last]}


_STEP_SCHEMA = "kind int, doc long, tie long, start int, stop int, gram long, lead int"
_STEP_ARROW = pa.schema([("kind", pa.int32()), ("doc", pa.int64()), ("tie", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()), ("gram", pa.int64()), ("lead", pa.int32())])


def _step_rows(kind: int | np.ndarray, doc, tie, start, stop, gram=None, lead=None) -> pa.RecordBatch:
    size = len(doc)
    none = np.zeros(size, np.int64)
    columns = [np.broadcast_to(np.asarray(kind, np.int32), size), doc, tie, start, stop, none if gram is None else gram.view(np.int64), none if lead is None else lead]
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c), f.type) for c, f in zip(columns, _STEP_ARROW)], schema=_STEP_ARROW)


def _mark_rows(runs: np.ndarray, length: int) -> pa.RecordBatch:
    return _step_rows(_MARK, **_spans(runs["doc"], runs["tie"], runs["start"], runs["start"] + runs["count"] - 1 + length))


def matched_runs(placed: DataFrame, length: int = LENGTH, most: int = MOST_CONTEXTS) -> DataFrame:
    """What the runs of all documents say about each other.

    Rows of kind 0 are spans that repeat: runs after an equal run.  Rows of kind 1 are the earliest runs of the
    different contexts of one gram, whose windows have still to be sorted; of kind 2 those of grams with more than
    ``most`` contexts.  Tasks combine their own runs first, so equal runs reach the task of their gram once from each
    batch, packed; that task holds at most ``most`` runs of a gram.
    """
    parts = partitions(placed)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        pending: list[np.ndarray] = []

        def packed() -> pa.RecordBatch:
            first, later = settle_runs(np.concatenate(pending))
            part = (first["gram"] >> np.uint64(32)).astype(np.int64) % parts
            order = np.lexsort((first["start"], first["doc"], part))
            first, part = first[order], part[order]
            bounds = np.searchsorted(part, np.arange(parts + 1))
            rows = [(p, packer.compress(_columns(first[a:b]))) for p, (a, b) in enumerate(zip(bounds, bounds[1:])) if b > a]
            marks = _mark_rows(later, length) if len(later) else None
            if marks is not None:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, marks.schema) as stream:
                    stream.write_batch(marks)
                rows.append((int(part[0]) if len(part) else 0, b"M" + sink.getvalue().to_pybytes()))
            return pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())], ["part", "runs"])

        for batch in batches:
            for part in slices(batch):
                pending.append(_runs(part, length))
                if sum(map(len, pending)) >= _COMBINED:
                    yield packed()
                    pending.clear()
        if pending:
            yield packed()

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor()
        held: list[np.ndarray] = []
        spread: set[int] = set()
        size, limit = 0, 4 * most
        for batch in batches:
            for data in batch.column("runs").to_pylist():
                if data[:1] == b"M":
                    yield from pa.ipc.open_stream(data[1:])
                    continue
                held.append(_from_columns(reader.decompress(data)))
                size += len(held[-1])
                if size > limit:
                    held, rows = _relieve(held, spread, most, length)
                    size = sum(map(len, held))
                    limit = max(limit, 2 * size)
                    yield from rows
        if held:
            yield from _settled(np.concatenate(held), spread, most, length)

    dealt = placed.mapInArrow(send, "part int, runs binary")
    return dealt.repartitionById(parts, F.col("part")).mapInArrow(settle, _STEP_SCHEMA)


def _columns(runs: np.ndarray) -> bytes:
    return b"".join([len(runs).to_bytes(8, "little"), *[np.ascontiguousarray(runs[n]).tobytes() for n in _RUN.names]])


def _from_columns(data: bytes) -> np.ndarray:
    size, place = int.from_bytes(data[:8], "little"), 8
    runs = np.zeros(size, _RUN)
    for name in _RUN.names:
        kind = _RUN[name]
        runs[name] = np.frombuffer(data, kind, size, place)
        place += size * kind.itemsize
    return runs


def _split(first: np.ndarray, spread: set[int], most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many contexts the gram of each run has, and whether it is one of those with too many to be sorted here."""
    values, inverse, counts = np.unique(first["gram"], return_inverse=True, return_counts=True)
    spread.update(values[counts > most].tolist())
    many = np.isin(values, np.fromiter(spread, np.uint64, len(spread))) if spread else np.zeros(len(values), bool)
    return counts[inverse], many[inverse], first


def _relieve(held: list[np.ndarray], spread: set[int], most: int, length: int) -> tuple[list[np.ndarray], list[pa.RecordBatch]]:
    """Combine what a task holds and let go of the runs of grams with too many contexts."""
    first, later = settle_runs(np.concatenate(held))
    _, many, _ = _split(first, spread, most)
    rows = [_mark_rows(later, length)] if len(later) else []
    if many.any():
        rows.append(_runs_rows(_SPREAD, first[many], length))
    return [first[~many]], rows


def _settled(runs: np.ndarray, spread: set[int], most: int, length: int) -> Iterator[pa.RecordBatch]:
    first, later = settle_runs(runs)
    if len(later):
        yield _mark_rows(later, length)
    contexts, many, _ = _split(first, spread, most)
    if many.any():
        yield _runs_rows(_SPREAD, first[many], length)
    sort = first[(contexts > 1) & ~many]
    if len(sort):
        yield _runs_rows(_SORT, sort, length)


def _runs_rows(kind: int, runs: np.ndarray, length: int) -> pa.RecordBatch:
    return _step_rows(kind, runs["doc"], runs["tie"], runs["start"], runs["start"] + runs["count"] - 1 + length, runs["gram"], runs["lead"])


def run_contexts(steps: DataFrame, placed: DataFrame) -> DataFrame:
    """The bytes of the runs that have to be looked into: ``kind, gram, doc, tie, start, lead, bytes``."""
    wanted = steps.where(F.col("kind") != _MARK).groupBy("doc", "tie").agg(F.collect_list(F.struct("kind", "gram", "start", "stop", "lead")).alias("runs"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, doc, tie, runs in zip(*[batch.column(c).to_pylist() for c in ("text", "doc", "tie", "runs")]):
                data = text.encode()
                rows += [(r["kind"], r["gram"], doc, tie, r["start"], r["lead"], data[r["start"] : r["stop"]]) for r in runs]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            columns = zip(*rows) if rows else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["kind", "gram", "doc", "tie", "start", "lead", "bytes"])

    joined = placed.join(wanted, ["doc", "tie"]).select("text", "doc", "tie", "runs")
    return joined.mapInArrow(cut, "kind int, gram long, doc long, tie long, start int, lead int, bytes binary").distinct()


class Contexts(NamedTuple):
    """Contexts of grams, those of one gram together: number of the gram, place, and bytes around the anchor."""

    gram: np.ndarray
    doc: np.ndarray
    tie: np.ndarray
    start: np.ndarray
    lead: np.ndarray
    offsets: np.ndarray
    data: np.ndarray


def shared_reach(c: Contexts, step: int) -> np.ndarray:
    """How far from its anchor, to the right (``step`` 1) or left (-1), each context is like another of its gram."""
    room = c.offsets[1:] - c.offsets[:-1] - c.lead if step > 0 else c.lead
    origin = c.offsets[:-1] + c.lead - (step < 0)
    reach = np.zeros(len(room), np.int64)
    live, cls, distance = np.arange(len(room)), c.gram.astype(np.int64), 0
    while len(live):
        inside = room[live] > distance
        live, cls = live[inside], cls[inside]
        keys = cls * 256 + c.data[origin[live] + step * distance]
        _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        shared = counts[inverse] > 1
        live, cls, distance = live[shared], inverse[shared], distance + 1
        reach[live] = distance
    return reach


def repeated_windows(c: Contexts, length: int = LENGTH) -> dict[str, np.ndarray]:
    """Spans of the windows that stand earlier in another context.

    Contexts are cut to what any other context of the gram shares with them, so every window outside is alone of its
    kind.  The suffixes of the rest are sorted; windows that begin equal suffixes are neighbours in that order, and
    all but the earliest of them repeat.
    """
    right, left = shared_reach(c, 1), shared_reach(c, -1)
    chosen = np.flatnonzero(left + right >= length)
    begin, size = c.offsets[:-1][chosen] + c.lead[chosen] - left[chosen], (left + right)[chosen]
    start = c.start[chosen] + c.lead[chosen] - left[chosen]
    marked = []
    stop = 0
    ends = np.cumsum(size + 1)
    while stop < len(chosen):
        low = stop
        reached = np.searchsorted(ends, (ends[low - 1] if low else 0) + _SORTED_BYTES, "right")
        stop = max(low + 1, int(reached))
        # Whole grams: no window of one gram is equal to one of another.
        while stop < len(chosen) and c.gram[chosen[stop]] == c.gram[chosen[stop - 1]]:
            stop += 1
        part = slice(low, stop)
        marked.append(_repeats_sorted(c, chosen[part], begin[part], size[part], start[part], length))
    if not marked:
        none = np.zeros(0, np.int64)
        return {"doc": none, "tie": none, "start": none, "stop": none}
    doc, tie, at = (np.concatenate(x) for x in zip(*marked))
    return _spans(doc, tie, at, at + length)


def _repeats_sorted(c: Contexts, rows, begin, size, start, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    total = int(size.sum() + len(size))
    ends = np.cumsum(size + 1)
    row = np.repeat(np.arange(len(size)), size + 1)
    inside = np.arange(total) - (ends - size - 1)[row]
    symbols = np.ones(total + 1, np.int64)
    own = inside < size[row]
    symbols[:-1][own] = c.data[begin[row[own]] + inside[own]].astype(np.int64) + 2
    symbols[-1] = 0
    order = np.array(suffix_order(symbols.tolist()))
    order = order[order < total]
    order = order[inside[order] + length <= size[row[order]]]
    windows = sliding_window_view(symbols.astype(np.uint16), length)
    new = np.ones(len(order), bool)
    for low in range(1, len(order), 4096):
        high = min(len(order), low + 4096)
        new[low:high] = (windows[order[low:high]] != windows[order[low - 1 : high - 1]]).any(1)
    kind = np.cumsum(new)
    doc, tie, at = c.doc[rows][row[order]], c.tie[rows][row[order]], start[row[order]] + inside[order]
    by_place = np.lexsort((at, tie, doc, kind))
    kind, doc, tie, at = kind[by_place], doc[by_place], tie[by_place], at[by_place]
    first = np.searchsorted(kind, kind)
    later = (doc != doc[first]) | (tie != tie[first]) | (at != at[first])
    return doc[later], tie[later], at[later]


def sorted_marks(contexts: DataFrame, length: int = LENGTH) -> DataFrame:
    """Spans ``doc, tie, start, stop`` found by sorting the contexts of each gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            grams = batch.column("gram").to_numpy()
            if held and held[-1].column("gram")[-1].as_py() != grams[0] and sum(b.nbytes for b in held) > 1 << 22:
                yield _sorted_batch(held, length)
                held = []
            last = int(np.searchsorted(grams, grams[-1]))
            if last and sum(b.nbytes for b in held) > 1 << 22:
                yield _sorted_batch([*held, batch.slice(0, last)], length)
                held, batch = [], batch.slice(last)
            held.append(batch)
        if held:
            yield _sorted_batch(held, length)

    one = contexts.where(F.col("kind") == _SORT).drop("kind")
    dealt = one.repartition(partitions(contexts), "gram").sortWithinPartitions("gram")
    return dealt.mapInArrow(run, "doc long, tie long, start int, stop int")


def _sorted_batch(batches: list[pa.RecordBatch], length: int) -> pa.RecordBatch:
    table = pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
    number = {n: table.column(n).to_numpy(zero_copy_only=False) for n in ("gram", "doc", "tie", "start", "lead")}
    gram = np.cumsum(np.append(0, number["gram"][1:] != number["gram"][:-1]))
    offsets, data = utf8(table.column("bytes"))
    found = repeated_windows(Contexts(gram, number["doc"], number["tie"], number["start"].astype(np.int64), number["lead"].astype(np.int64), offsets, data), length)
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(found[n], k) for n, k in zip(("doc", "tie", "start", "stop"), kinds)], ["doc", "tie", "start", "stop"])


def spread_marks(contexts: DataFrame, length: int = LENGTH) -> DataFrame:
    """Spans of grams with too many contexts for a task: each window on its own, by a hash of its bytes.

    The earliest place of each window is a sum that map tasks begin, so no task gets all windows of a gram.
    """
    one = contexts.where(F.col("kind") == _SPREAD)
    window = F.expr(f"substring(bytes, shift + 1, {length})")
    each = one.select("doc", "tie", "start", "bytes", F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - length)).alias("shift"))
    each = each.select(F.unhex(F.substring(F.sha2(window, 256), 1, 32)).alias("window"), F.struct("doc", "tie", (F.col("start") + F.col("shift")).alias("at")).alias("place"))
    first = each.groupBy("window").agg(F.min("place").alias("first"))
    later = each.join(first, "window").where(F.col("place") != F.col("first"))
    return later.select("place.doc", "place.tie", F.col("place.at").alias("start"), (F.col("place.at") + length).cast("int").alias("stop"))


def repeated_spans(placed: DataFrame, length: int = LENGTH, most: int = MOST_CONTEXTS) -> DataFrame:
    """Spans of bytes that repeat what stands earlier: ``doc, tie, spans``, unordered and overlapping."""
    steps = cut_lineage(matched_runs(placed, length, most), "runs")
    contexts = cut_lineage(run_contexts(steps, placed), "contexts")
    marks = steps.where(F.col("kind") == _MARK).select("doc", "tie", "start", "stop")
    marks = marks.union(sorted_marks(contexts, length)).union(spread_marks(contexts, length))
    return marks.groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of the bytes in some spans."""
    runs: list[tuple[int, int]] = []
    for start, stop in sorted((s["start"], s["stop"]) for s in spans or ()):
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(stop, runs[-1][1]))
        else:
            runs.append((start, stop))
    return runs


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text", most: int = MOST_CONTEXTS
) -> DataFrame:
    """Texts without the bytes that a string of ``length`` bytes covers which also starts earlier.

    Earlier is under a smaller id or before in the same document; strings are judged on the input and never join two
    documents.  Returns ``doc_id, n_bytes, spans, kept``: the spans that were removed, in order, and the bytes that
    are left.  Null texts are empty; rows without an id come before all others; rows with one id are documents of
    their own in the order of a hash of their texts, and equal rows, being one document, get equal results; an empty
    table gives no rows.
    """
    placed = place_documents(docs, id_column, text_column)
    spans = repeated_spans(placed, length, most)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                offsets, data = utf8(part.column("text"))
                runs = [merged(s) for s in part.column("spans").to_pylist()]
                whole = np.ones(len(data) + 1, np.int8)
                edges = [(o + a, o + b) for o, own in zip(offsets.tolist(), runs) for a, b in own]
                for a, b in edges:
                    whole[a:b] = 0
                left = whole[:-1] > 0
                bounds = np.concatenate([[0], np.cumsum(left)])[offsets]
                kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
                listed = pa.array([[{"start": a, "stop": b} for a, b in own] for own in runs], kind)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(offsets), pa.int64()), listed, binaries(data[left], bounds)],
                    ["doc_id", "n_bytes", "spans", "kept"],
                )

    none = F.lit(-(1 << 63))
    joined = placed.join(spans, ["doc", "tie"], "left").select(F.when(F.col("doc") != none, F.col("doc")).alias("doc_id"), "text", "spans")
    return joined.mapInArrow(cut, "doc_id long, n_bytes long, spans array<struct<start:int,stop:int>>, kept binary")
