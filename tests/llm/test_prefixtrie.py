"""The trie of conversations against all prefixes in a dictionary, and its trees against sorted keys."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest
from oracle import connect, differences

from releasecat.llm.prefixtrie import WIDTH, Direct, Indexed, Node, PrefixTrie, RadixTree, Sorted, prefix_trie
from releasecat.llm.queries import ORACLES, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {conv: [t[2:] for t in sorted(held)] for conv, held in turns.items()}
    rebuilt = {}
    for conv in own:
        taken = zlib.crc32(str(conv).encode()) % 4
        rebuilt[conv] = own.get(conv - int(math.fmod(conv, 20)), [])[:taken] + own[conv][taken:]
    members, children = defaultdict(list), defaultdict(list)
    for conv, path in rebuilt.items():
        for depth in range(len(path) + 1):
            members[tuple(path[:depth])].append(conv)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        words = len(WORD.findall(path[-1][1])) if path else 0
        leaves[path] = sum(leaves[c] for c in children[path]) or 1
        saved[path] = (len(members[path]) - 1) * words + sum(saved[c] for c in children[path])
    return sorted(
        (
            min(held),
            len(path),
            min(members[path[:-1]]) if path else -1,
            len(held),
            len(children[path]),
            leaves[path],
            saved[path],
            hashlib.sha256(",".join(str(c) for c in sorted(held) if len(rebuilt[c]) == len(path)).encode()).hexdigest(),
        )
        for path, held in members.items()
    )


def found(spark, rows, rule=PrefixTrie(), parts=3):
    df = prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(parts), rule)
    assert df.columns == COLUMNS and {kind for _, kind in df.dtypes[:-1]} == {"bigint"}
    return sorted(tuple(-1 if v is None else v for v in row) for row in df.collect())


def test_query_and_sql(spark, sf_dir):
    df = QUERIES["op13_radix_prefix_trie"](spark, sf_dir)
    assert differences(df, connect(sf_dir), ORACLES["op13_radix_prefix_trie"]) == []
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    assert sorted(tuple(-1 if v is None else v for v in row) for row in df.collect()) == plain(rows)


def test_shared_turns_nulls_and_gaps(spark):
    pick = random.Random(1)
    rows = []
    for conv in [*range(60), 1000, 1001, -5, -40]:
        for turn in range(pick.randrange(0, 6)):
            said = pick.choice(["hello there", "how are you", "", None, "a  b\tc\x0bd"])
            rows.append((conv, turn, pick.choice(["user", "assistant", None, ""]), said))
    rows += [(7, None, "user", "without a number"), (None, 0, "user", "of no conversation")]
    assert found(spark, rows) == plain(rows)


def test_equal_numbers_and_repeated_rows(spark):
    # A conversation that keeps its own turns only: ties are ordered by role, equal rows stay.
    rows = [(3, 0, "b", "x"), (3, 0, "a", "y"), (3, 1, "c", "z"), (3, 1, "c", "z"), (3, None, "d", "first")]
    assert found(spark, rows) == plain(rows)


def test_hot_first_turn_and_copies_in_small_trees_and_chunks(spark):
    rows = [(conv, turn, "user", f"turn {turn}") for conv in range(0, 400) for turn in range(5)]
    rows += [(conv, 5, "user", f"own {conv}") for conv in range(0, 400, 7)]
    assert found(spark, rows, PrefixTrie(turns=30, chunk=3), parts=8) == plain(rows)


def test_long_conversation(spark):
    rows = [(20, turn, "user", f"t{turn} {'word ' * (turn % 3)}") for turn in range(5000)]
    rows += [(21, turn, "user", f"t{turn} {'word ' * (turn % 3)}") for turn in range(5001)]
    assert found(spark, rows) == plain(rows)


def test_conversation_without_turns_is_in_the_root(spark):
    empty = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(empty, 0, "user", "is replaced by nothing")]
    assert found(spark, rows) == plain(rows) == [(empty, 0, -1, 1, 0, 1, 0, hashlib.sha256(str(empty).encode()).hexdigest())]


def test_empty_table_and_clashing_columns(spark):
    assert found(spark, [], parts=1) == []
    df = spark.createDataFrame([(0, 0, "user", "a b", 1)], SCHEMA + ", node long").selectExpr("*", "1 AS path", "2 AS depth")
    assert prefix_trie(df).count() == 2


@pytest.mark.parametrize("seed", range(4))
def test_tree_against_sorted_keys(seed):
    pick = random.Random(seed)
    turns = [bytes(pick.randrange(256) if seed % 2 else pick.randrange(3) for _ in range(WIDTH)) for _ in range(300)]
    keys = [b"".join(pick.choice(turns[: 3 if i % 2 else 300]) for _ in range(pick.randrange(4))) for i in range(1000)]
    tree = RadixTree()
    for number, key in enumerate(keys):
        tree.insert(key, number)
    expected = {key[:size] for key in keys for size in range(0, len(key) + 1, WIDTH)}
    open_, paths, ends = [], {}, {}
    for own, parent, turn, depth, node, done in tree.prefixes():
        if done:
            assert open_.pop() == own
            ends[paths[own]] = node.ends if node is not None else []
        else:
            assert (open_[-1] if open_ else None) == parent
            paths[own] = paths.get(parent, b"") + turn
            assert len(paths[own]) == depth * WIDTH
            open_.append(own)
    assert set(ends) == expected and len(paths) == len(expected)
    assert all(held == [n for n, key in enumerate(keys) if key == path] for path, held in ends.items())


def test_node_layouts_grow():
    children, kinds = Sorted(), []
    for byte in random.Random(2).sample(range(256), 256):
        children = children.put(byte, Node(bytes([byte])))
        kinds.append(type(children))
    assert [kinds.index(kind) for kind in (Sorted, Indexed, Direct)] == [0, 16, 48]
    assert [node.path[0] for node in children] == list(range(256))
    assert Sorted().get(1) is None and Indexed().get(1) is None and Direct().get(1) is None
