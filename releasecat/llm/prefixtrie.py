"""Conversations that share first turns, as a trie: adaptive radix trees over slices of the sorted turn ids.

A turn is a 16-byte big-endian id, a conversation the ids of its turns one after the other.  Tasks build a tree for
each part of a sorted slice and report its nodes; the reports of one node are added up.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .text import keep, partitions

WIDTH = 16
NOTHING = hashlib.sha256(b"").hexdigest()


class PrefixTrie(NamedTuple):
    """Conversations of one group share first turns with the group's first; up to how many turns are shared; turns
    that one tree holds before it is reported and a new one begun; ids of one chunk of a list."""

    group: int = 20
    heads: int = 4
    turns: int = 200_000
    chunk: int = 4096


class Sorted:
    """Children of a node in order of their byte: of up to 4, then of up to 16."""

    __slots__ = ("keys", "nodes")

    def __init__(self) -> None:
        self.keys, self.nodes = bytearray(), []

    def get(self, byte: int) -> Node | None:
        at = self.keys.find(byte)
        return self.nodes[at] if at >= 0 else None

    def put(self, byte: int, node: Node) -> Sorted | Indexed:
        at = bisect_left(self.keys, byte)
        if at < len(self.keys) and self.keys[at] == byte:
            self.nodes[at] = node
        elif len(self.keys) < 16:
            self.keys.insert(at, byte)
            self.nodes.insert(at, node)
        else:
            grown = Indexed()
            for key, held in zip(self.keys, self.nodes):
                grown.put(key, held)
            return grown.put(byte, node)
        return self

    def __iter__(self) -> Iterator[Node]:
        return iter(self.nodes)


class Indexed:
    """Children of a node by an index of 256 bytes into up to 48 places."""

    __slots__ = ("index", "nodes")

    def __init__(self) -> None:
        self.index, self.nodes = bytearray(256), []

    def get(self, byte: int) -> Node | None:
        place = self.index[byte]
        return self.nodes[place - 1] if place else None

    def put(self, byte: int, node: Node) -> Indexed | Direct:
        place = self.index[byte]
        if place:
            self.nodes[place - 1] = node
        elif len(self.nodes) < 48:
            self.nodes.append(node)
            self.index[byte] = len(self.nodes)
        else:
            grown = Direct()
            for key in range(256):
                if self.index[key]:
                    grown.nodes[key] = self.nodes[self.index[key] - 1]
            return grown.put(byte, node)
        return self

    def __iter__(self) -> Iterator[Node]:
        return iter([self.nodes[place - 1] for place in self.index if place])


class Direct:
    """Children of a node at 256 places of their own."""

    __slots__ = ("nodes",)

    def __init__(self) -> None:
        self.nodes: list[Node | None] = [None] * 256

    def get(self, byte: int) -> Node | None:
        return self.nodes[byte]

    def put(self, byte: int, node: Node) -> Direct:
        self.nodes[byte] = node
        return self

    def __iter__(self) -> Iterator[Node]:
        return (node for node in self.nodes if node is not None)


class Node:
    """Bytes from the parent's to this node, members that end here, and children."""

    __slots__ = ("path", "ends", "children")

    def __init__(self, path: bytes) -> None:
        self.path, self.ends, self.children = path, [], Sorted()


class RadixTree:
    """An adaptive radix tree with compressed paths; keys have a whole number of ``WIDTH`` bytes."""

    def __init__(self) -> None:
        self.root = Node(b"")

    def insert(self, key: bytes, member: object) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = Node(key[at:])
                node.children = node.children.put(key[at], child)
                node, at = child, len(key)
                break
            rest = key[at : at + len(child.path)]
            if rest != child.path:
                same = next((i for i, (a, b) in enumerate(zip(rest, child.path)) if a != b), len(rest))
                upper = Node(child.path[:same])
                child.path = child.path[same:]
                upper.children = upper.children.put(child.path[0], child)
                node.children = node.children.put(key[at], upper)
                child = upper
            node, at = child, at + len(child.path)
        node.ends.append(member)

    def prefixes(self) -> Iterator[tuple[bytes, bytes | None, bytes, int, Node | None, bool]]:
        """Turn-aligned prefixes, each before those that extend it and once more after them.

        ``id, id of the prefix one turn shorter, last turn, depth, node that ends there if one does, whether all that
        extends it is done``.
        The id of a prefix is a hash of its parent's id and its last turn, so trees of different slices agree on it.
        """
        start = prefix_id(b"", b"")
        stack = [(self.root, start, 0, b"", False)]
        while stack:
            node, own, depth, part, done = entered = stack.pop()
            part, way = part + node.path, []
            if node is self.root:
                way.append((start, None, b"", 0))
            while len(part) >= WIDTH:
                turn, part = part[:WIDTH], part[WIDTH:]
                depth, parent, own = depth + 1, own, prefix_id(own, turn)
                way.append((own, parent, turn, depth))
            last = len(way) - 1
            for step in range(last, -1, -1) if done else range(last + 1):
                yield *way[step], None if step < last or part else node, done
            if not done:
                stack.append((*entered[:-1], True))
                stack += [(child, own, depth, part, False) for child in node.children]


def prefix_id(parent: bytes, turn: bytes) -> bytes:
    return hashlib.sha256(parent + turn).digest()[:WIDTH]


def turn_id(role: str = "role", text: str = "text") -> Column:
    """128 bits of the SHA-256 of role and text; the role's length keeps the two apart."""
    said = F.concat(F.length(role).cast("string"), F.lit(":"), F.col(role), F.col(text))
    return F.unhex(F.substring(F.sha2(said.cast("binary"), 256), 1, 2 * WIDTH))


def rebuilt_conversations(turns: DataFrame, rule: PrefixTrie) -> DataFrame:
    """``conv_id, turns``: ids and numbers of words of the turns of each rebuilt conversation, without texts.

    A conversation starts with the first turns of its group's first one in place of as many turns of its own; how
    many is told by the CRC-32 of its number.  The remainder of a negative number is negative, as in SQL.
    """
    known = turns.where(F.col("conv_id").isNotNull())
    filled = known.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    said = filled.select(
        "conv_id",
        F.struct(
            "turn",
            "role",
            turn_id().alias("id"),
            F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
        ).alias("said"),
    )
    # Nulls come first in the order of a list; turns with one number are ordered by role and id.
    listed = said.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    own = listed.select("conv_id", F.transform("said", lambda s: F.struct(s["id"].alias("id"), s["words"].alias("words"))).alias("turns"))
    own = cut_lineage(own, "conversations")
    first = F.col("conv_id") - F.col("conv_id") % rule.group
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % rule.heads).cast("int")
    heads = own.where(F.col("conv_id") % rule.group == 0).select(
        F.col("conv_id").alias("first"), F.slice("turns", 1, rule.heads - 1).alias("heads")
    )
    joined = own.withColumns({"first": first, "taken": taken}).join(heads, "first", "left")
    rest = F.slice("turns", F.col("taken") + 1, F.greatest(F.size("turns"), F.lit(1)))
    lead = F.slice(F.coalesce("heads", F.array().cast(own.schema["turns"].dataType)), F.lit(1), F.col("taken"))
    return joined.select("conv_id", F.concat(lead, rest).alias("turns"))


def _trees(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[RadixTree, list[dict]]]:
    """Trees of consecutive rows with about ``limit`` turns each, with the rows."""
    tree, rows, held = RadixTree(), [], 0
    for batch in batches:
        for row in batch.to_pylist():
            tree.insert(row["path"], row["conv_id"])
            rows.append(row)
            held += len(row["path"]) // WIDTH + 1
            if held >= limit:
                yield tree, rows
                tree, rows, held = RadixTree(), [], 0
    if rows:
        yield tree, rows


def node_reports(sliced: DataFrame, rule: PrefixTrie) -> DataFrame:
    """What each tree knows of each prefix: members, the least, words of the last turn, and lists of those that end there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree, rows in _trees(batches, rule.turns):
            words = {}
            for row in rows:
                path = row["path"]
                for place, count in enumerate(row["words"]):
                    words[path[place * WIDTH : (place + 1) * WIDTH]] = count
            yield from _record(_members(tree, words, rule.chunk), REPORT)

    return sliced.mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind, _ in REPORT))


REPORT = [
    ("node", "binary", pa.binary()),
    ("parent", "binary", pa.binary()),
    ("depth", "long", pa.int64()),
    ("members", "long", pa.int64()),
    ("least", "long", pa.int64()),
    ("words", "long", pa.int64()),
    ("first_end", "long", pa.int64()),
    ("ends", "string", pa.string()),
]
TOTAL = [("node", "binary", pa.binary()), ("saved", "long", pa.int64()), ("leaves", "long", pa.int64())]


def _members(tree: RadixTree, words: dict[bytes, int], chunk: int) -> Iterator[tuple]:
    """Reports of all prefixes; lists of members that end at one come in chunks, as further rows without members."""
    below: list[tuple[int, int]] = []
    for node_id, parent, turn, depth, node, done in tree.prefixes():
        if not done:
            below.append((0, 1 << 63))
            continue
        count, least = below.pop()
        ends = node.ends if node is not None else []
        if ends:
            count, least = count + len(ends), min(least, ends[0])
        if below:
            below[-1] = (below[-1][0] + count, min(below[-1][1], least))
        yield node_id, parent, depth, count, least, words.get(turn, 0), None, None
        for at in range(0, len(ends), chunk):
            part = ends[at : at + chunk]
            yield node_id, parent, depth, 0, least, 0, part[0], ",".join(map(str, part))


def subtree_totals(sliced: DataFrame, rule: PrefixTrie) -> DataFrame:
    """Sums over the subtree of each prefix, of what ``owned`` lists for the nodes on a path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree, rows in _trees(batches, rule.turns):
            own = {o["node"]: (o["saved"], o["leaf"]) for row in rows for o in row["owned"]}
            yield from _record(_sums(tree, own), TOTAL)

    return sliced.mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind, _ in TOTAL))


def _sums(tree: RadixTree, own: dict[bytes, tuple[int, int]]) -> Iterator[tuple]:
    below: list[tuple[int, int]] = []
    for node_id, _, _, _, _, done in tree.prefixes():
        if not done:
            below.append(own.get(node_id, (0, 0)))
            continue
        saved, leaves = below.pop()
        if below:
            below[-1] = (below[-1][0] + saved, below[-1][1] + leaves)
        yield node_id, saved, leaves


def _record(rows: Iterable[tuple], fields: list[tuple]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == 8192:
            yield _batch(held, fields)
            held = []
    if held:
        yield _batch(held, fields)


def _batch(rows: list[tuple], fields: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(column, kind) for column, (_, _, kind) in zip(zip(*rows), fields)]
    return pa.RecordBatch.from_arrays(columns, [name for name, _, _ in fields])


def _sliced(paths: DataFrame) -> DataFrame:
    """Paths in ranges of their order.

    The order is that of the first turns, of a hash of the whole path and of the number, so that equal paths are
    together and a range boundary may still divide them, and the keys sampled for the ranges stay short.
    """
    order = [F.substring("path", 1, 32 * WIDTH), F.xxhash64("path"), F.col("conv_id")]
    return paths.repartitionByRange(partitions(paths), *order).sortWithinPartitions(*order)


def _lists_hashed(chunks: DataFrame) -> DataFrame:
    """``node, ends_sha256``: hash of the joined lists of each node, chunk by chunk; a task holds one chunk at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hashed() -> Iterator[tuple]:
            node, state = None, None
            for batch in batches:
                for key, ends in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
                    if key == node:
                        state.update(b"," + ends.encode())
                        continue
                    if node is not None:
                        yield node, state.hexdigest()
                    node, state = key, hashlib.sha256(ends.encode())
            if node is not None:
                yield node, state.hexdigest()

        yield from _record(hashed(), [("node", "binary", pa.binary()), ("ends_sha256", "string", pa.string())])

    dealt = chunks.repartition(partitions(chunks), "node").sortWithinPartitions("node", "first_end")
    return dealt.select("node", "ends").mapInArrow(run, "node binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, rule: PrefixTrie = PrefixTrie()) -> DataFrame:
    """Nodes of the trie of rebuilt conversations: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``.

    Turns are ordered by their number, those without one first, those with equal numbers by role and id of the turn
    (repeated turns stay turns); null roles and texts are empty.  Rows without a conversation's number belong to no
    conversation and are left out.  Numbers must be whole.  An empty table gives no rows, as there is no conversation
    then; otherwise the root has all conversations.

    A conversation passes tasks as 24 bytes for each of its turns, never with its texts.  A prefix shared by any
    number of conversations is reported once by each tree, and the order of the slices divides equal conversations
    among tasks by their number.
    """
    columns = {c: c for c in ("conv_id", "turn", "role", "text")}
    rebuilt = rebuilt_conversations(keep(conversations, **columns), rule)
    # A list of ids becomes one binary key.
    key = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), ""))
    paths = cut_lineage(rebuilt.select("conv_id", key.alias("path"), F.col("turns.words").alias("words")), "paths")
    reports = cut_lineage(node_reports(_sliced(paths), rule), "reports")

    merged = reports.groupBy("node").agg(
        F.max("parent").alias("parent"),
        F.max("depth").alias("depth"),
        F.sum("members").alias("n_convs"),
        F.min("least").alias("conv_id"),
        F.max("words").alias("words"),
    )
    nodes = cut_lineage(merged, "nodes")
    ends = _lists_hashed(reports.where(F.col("ends").isNotNull()).select("node", "first_end", "ends"))
    children = nodes.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    family = nodes.join(children, "node", "left").join(ends, "node", "left").withColumns(
        {
            "n_children": F.coalesce("n_children", F.lit(0).cast("long")),
            "ends_sha256": F.coalesce("ends_sha256", F.lit(NOTHING)),
        }
    )
    family = cut_lineage(family, "family")

    # The least member of a node is the least of every deeper node on its way, so each node is listed by one path.
    owned = family.groupBy("conv_id").agg(
        F.collect_list(
            F.struct(
                "node",
                ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
                (F.col("n_children") == 0).cast("long").alias("leaf"),
            )
        ).alias("owned")
    )
    totals = subtree_totals(_sliced(paths.select("conv_id", "path").join(owned, "conv_id")), rule)
    summed = totals.groupBy("node").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))
    above = family.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        family.join(summed, "node")
        .join(above, "parent", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
        )
    )
