"""SimHash components against all pairs of fingerprints, and the covering code."""

import random
import re
from math import comb

import numpy as np
import pytest
import xxhash

from releasecat.llm.queries import QUERIES
from releasecat.llm.simhash import (
    CODE,
    SimHash,
    anchors_in_reach,
    fingerprint,
    fingerprint_links,
    home_anchors,
    nearest,
    remainders,
    simhash_components,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


def plain_print(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def joined(prints, threshold=2):
    """Component of each fingerprint, by all pairs."""
    values, parent = sorted(prints), {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, a in enumerate(values):
        near = np.flatnonzero(np.bitwise_count(np.array(values[i + 1 :], np.uint64) ^ np.uint64(a)) <= threshold)
        for j in near:
            parent[root(values[i + 1 + int(j)])] = root(a)
    return {p: root(p) for p in prints}


def plain(rows):
    own = [plain_print(text) for _, text in rows]
    component = joined(set(own))
    least = {}
    for (number, _), p in zip(rows, own):
        if number is not None:
            least[component[p]] = min(number, least.get(component[p], number))
    return sorted((str(n), f"{p:016x}", str(least.get(component[p]))) for (n, _), p in zip(rows, own))


def as_rows(df):
    assert df.columns == ["doc_id", "fingerprint", "component_id"]
    return sorted((str(a), b, str(c)) for a, b, c in df.collect())


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert as_rows(QUERIES["op11_anchor_simhash"](spark, sf_dir)) == plain(rows)


def test_odd_texts_ids_and_columns(spark):
    text = "one Two three four five six seven eight nine ten"
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "word"), (5, "two words"), (6, "TWO\x0bwords"), (7, text), (7, text + " eleven")]
    rows += [(None, text), (None, "alone without an id"), (9, text.upper()), (10, "É é"), (10, "É é"), (11, "x\x85y z w a b")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", print long, component long")
    assert as_rows(simhash_components(df)) == plain(rows)
    assert simhash_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_text_in_pieces():
    pick = random.Random(4)
    text = " ".join(pick.choice(["alpha", "Beta", "g", "delta\n", "épsilon"]) for _ in range(3000))
    for piece in (1, 2, 3, 100, 1 << 20):
        value = fingerprint(text.encode(), SimHash(piece=piece))
        assert value % (1 << 64) == plain_print(text)
    # A word longer than a piece, and fewer words than a shingle over several pieces.
    assert fingerprint(b"a" * 50 + b" bb", SimHash(piece=5)) % (1 << 64) == plain_print("a" * 50 + " bb")


@pytest.mark.parametrize("block", sorted(set(CODE)))
def test_codes_are_perfect(block):
    words = np.arange(1 << block.bits) if block.bits < 20 else np.random.default_rng(1).integers(0, 1 << block.bits, 20_000)
    code = words ^ nearest(block)[remainders(words, block)]
    assert not remainders(code, block).any() and int(np.bitwise_count(words ^ code).max()) == block.radius
    # As many words within the radius as there are syndromes: one code word each.
    ball = sum(comb(block.bits, r) for r in range(block.radius + 1))
    assert ball == 1 << block.checks


def test_any_two_near_fingerprints_share_an_anchor():
    rng = np.random.default_rng(2)
    a = rng.integers(-(1 << 63), (1 << 63) - 1, 3000, np.int64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 3), replace=False)) for _ in a], np.uint64)
    b = (a.view(np.uint64) ^ flips).view(np.int64)
    of_a, of_b = set(zip(*map(np.ndarray.tolist, anchors_in_reach(a, 1)))), set(zip(*map(np.ndarray.tolist, anchors_in_reach(b, 1))))
    assert {row for row, _ in of_a & of_b} == set(range(len(a)))
    assert {(i, h) for i, h in enumerate(home_anchors(a).tolist())} <= of_a


@pytest.mark.parametrize("together", [2, 8, 32])
def test_crowded_anchors(spark, together):
    """Drifting fingerprints around one centre: every size of the groups that are compared gives the same links."""
    pick = random.Random(5)
    prints, at = {0}, 0
    for _ in range(400):
        at ^= 1 << pick.randrange(64)
        prints |= {at, at ^ (1 << pick.randrange(64)), 0 ^ (1 << pick.randrange(64)) ^ (1 << pick.randrange(64))}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "print long")
    links = {(a % (1 << 64), b % (1 << 64)) for a, b in fingerprint_links(df, SimHash(together=together)).collect()}
    assert all((a ^ b).bit_count() <= 2 for a, b in links)
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in links:
        parent[root(a)] = root(b)
    groups = lambda label: sorted(sorted(p for p in prints if label[p] == r) for r in set(label.values()))
    assert groups({p: root(p) for p in prints}) == groups(joined(prints))


def test_wider_links_are_refused(spark):
    with pytest.raises(ValueError):
        simhash_components(spark.createDataFrame([], SCHEMA), SimHash(threshold=3))
