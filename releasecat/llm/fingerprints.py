"""Document fingerprints: a Merkle tree over sections and paragraphs."""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import keep, partitions

_SECTION = re.compile(r"\n[^\S\n]*\n\s*")
# Where a paragraph is cut into parts: after white space that follows punctuation or one of a few letters.  The
# content alone decides, so an edit changes the parts it touches and no others.
_PART = re.compile(r"(?<=[.,;:!?|afkpuz]\s)|(?<=[。、])")


class Tree(NamedTuple):
    """Root digest, and for each section its digest and its paragraphs: digest and checksums of the parts."""

    root: str
    sections: list[tuple[str, list[tuple[str, array]]]]


class Difference(NamedTuple):
    """Paragraphs of two trees that have no equal in the other, as (section, paragraph) places."""

    left: list[tuple[int, int]]
    right: list[tuple[int, int]]


def _digest(data: bytes) -> str:
    return hashlib.blake2b(data, digest_size=16).hexdigest()


def build_tree(text: str) -> Tree:
    """Tree of a text: parts below paragraphs (lines) below sections (lines between blank lines).

    Digests of inner nodes come from those of their children, in order; the root also has the digest of the text
    between them, so that equal roots mean equal texts.
    """
    sections = []
    for section in _SECTION.split(text):
        paragraphs = []
        for line in section.split("\n"):
            parts = array("I", [zlib.crc32(p.encode()) for p in _PART.split(line) if p])
            paragraphs.append((_digest(line.encode()), parts))
        sections.append((_digest("".join(d for d, _ in paragraphs).encode()), paragraphs))
    gaps = _digest("\0".join(_SECTION.findall(text)).encode())
    return Tree(_digest("".join([gaps, *[d for d, _ in sections]]).encode()), sections)


def to_text(tree: Tree) -> str:
    """The fingerprint: ``root:section;...``, a section ``digest,paragraph,...``, a paragraph digest and parts in hex."""
    return tree.root + ":" + ";".join(
        ",".join([digest, *[line + parts.tobytes().hex() for line, parts in paragraphs]])
        for digest, paragraphs in tree.sections
    )


def from_text(fingerprint: str) -> Tree:
    root, _, rest = fingerprint.partition(":")
    sections = []
    for section in rest.split(";"):
        digest, *paragraphs = section.split(",")
        sections.append((digest, [(p[:32], array("I", bytes.fromhex(p[32:]))) for p in paragraphs]))
    return Tree(root, sections)


def part_counts(tree: Tree) -> Counter:
    counts: Counter = Counter()
    for _, paragraphs in tree.sections:
        for _, parts in paragraphs:
            counts.update(parts)
    return counts


def likeness(left: Tree, right: Tree, left_parts: Counter | None = None, right_parts: Counter | None = None) -> float:
    """1 for equal roots, else the share of parts that both have among the parts that either has, counted repeatedly."""
    if left.root == right.root:
        return 1.0
    a = part_counts(left) if left_parts is None else left_parts
    b = part_counts(right) if right_parts is None else right_parts
    shared = sum((a & b).values())
    either = a.total() + b.total() - shared
    return shared / either if either else 0.0


def differences(left: Tree, right: Tree) -> Difference:
    """Where two texts differ; branches with equal digests are not entered."""
    if left.root == right.root:
        return Difference([], [])
    return Difference(_only(left, right), _only(right, left))


def _only(tree: Tree, other: Tree) -> list[tuple[int, int]]:
    known = {digest for digest, _ in other.sections}
    lines = Counter(line for _, paragraphs in other.sections for line, _ in paragraphs)
    return [
        (s, p)
        for s, (digest, paragraphs) in enumerate(tree.sections)
        if digest not in known
        for p, (line, _) in enumerate(paragraphs)
        if not lines[line]
    ]


def with_following(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """Deal ``doc_id, text`` out in ranges of ids, each followed by a copy of the next range's first rows.

    Adds ``block`` and ``borrowed``; in order of ``block, borrowed, doc_id, text`` every row is followed by the next
    document, the last one by the first.  Rows without an id come first.  The driver sees one number for each block.
    """
    count = blocks or partitions(docs)
    points = [(k + 1) / count for k in range(count - 1)] or [1.0]
    row = docs.agg(F.percentile_approx("doc_id", [float(p) for p in points], 10000).alias("b")).first()
    bounds = sorted(set(row.b or []))
    # Two levels, so that placing a row takes few comparisons: bounds in groups, then inside a group.
    width = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)] or [[]]
    coarse = F.lit([g[0] for g in groups[1:]] or [None]).cast("array<long>")
    fine = F.from_json(F.lit(str(groups)), "array<array<long>>")
    group = F.size(F.filter(coarse, lambda b: b <= F.col("doc_id")))
    inner = F.size(F.filter(F.get(fine, group), lambda b: b <= F.col("doc_id")))
    placed = docs.withColumn("home", group * width + inner)

    least = placed.groupBy("home").agg(
        F.min("doc_id").alias("least"), F.bool_or(F.col("doc_id").isNull()).alias("none")
    )
    first = {r.home: r for r in least.collect()}
    used = sorted(first)
    before = {home: used[i - 1] for i, home in enumerate(used)}
    size = max(used, default=0) + 1
    leads = F.lit([first[h].least if h in first else None for h in range(size)]).cast("array<long>")
    lead_none = F.lit([h in first and first[h].none for h in range(size)]).cast("array<boolean>")
    previous = F.lit([before.get(h, 0) for h in range(size)]).cast("array<int>")
    leading = F.when(F.get(lead_none, "home"), F.col("doc_id").isNull()).otherwise(F.col("doc_id") == F.get(leads, "home"))
    own = F.struct(F.col("home").alias("block"), F.lit(False).alias("borrowed"))
    lent = F.struct(F.get(previous, "home").alias("block"), F.lit(True).alias("borrowed"))
    dealt = placed.select("doc_id", "text", F.explode(F.when(leading, F.array(own, lent)).otherwise(F.array(own))).alias("to"))
    return (
        dealt.select("to.block", "to.borrowed", "doc_id", "text")
        .repartitionById(size, F.col("block"))
        .sortWithinPartitions("block", "borrowed", "doc_id", "text")
    )


FINGERPRINT_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def fingerprint_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprint of every text: ``doc_id, n_chars, fingerprint``.

    Null and empty texts have the fingerprint of the empty text; repeated rows stay; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            prints = [to_text(build_tree(t)) for t in texts]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes, pa.array(prints)], ["doc_id", "n_chars", "fingerprint"])

    rows = keep(docs, doc_id=id_column, text=text_column)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_chars long, fingerprint string")


def compare_edits(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text, and how like they are.

    The edited text has the last quarter of the code points, rounded down, replaced by as many from the start of the
    next document in order of ids (after the last: the first).  Columns are those of ``FINGERPRINT_SCHEMA``.  Null
    texts are empty, rows with one id follow each other in order of their texts, a single document follows itself, and
    an empty table gives no rows.  A task holds two documents and an output batch.
    """
    rows = keep(docs, doc_id=F.col(f"`{id_column}`").cast("long"), text=F.coalesce(F.col(f"`{text_column}`"), F.lit("")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        held = None
        for row in _rows(batches):
            block, borrowed, number, text = row
            tree = build_tree(text)
            current = (block, borrowed, number, text, tree, part_counts(tree), to_text(tree))
            if held is not None and held[0] == block and not held[1]:
                out.append(_compared(held, current))
                size += len(held[3])
                if size > 1 << 22:
                    yield _batch(out)
                    out, size = [], 0
            held = current
        if out:
            yield _batch(out)

    return with_following(rows).mapInArrow(run, FINGERPRINT_SCHEMA)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True)


def _compared(current: tuple, following: tuple) -> tuple:
    _, _, number, text, tree, parts, printed = current
    replaced = len(text) // 4
    edited = text[: len(text) - replaced] + following[3][:replaced]
    other = build_tree(edited)
    return (
        number,
        len(text),
        hashlib.sha256(edited.encode()).hexdigest(),
        printed,
        to_text(other),
        likeness(tree, other, left_parts=parts),
        likeness(tree, following[4], parts, following[5]),
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
