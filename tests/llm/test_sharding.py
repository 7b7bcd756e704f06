"""Shards by virtual slots."""

import random
import zlib
from collections import Counter, defaultdict

from releasecat.llm.sharding import Slot, initial_map, rebalance, shard_documents, slot_maps, with_slots


def check(rows, found, shards=16):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    places = defaultdict(list)
    for r in found:
        assert 0 <= r.shard < shards
        places[r.shard].append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = shard_documents(docs).collect()
    check([(r.doc_id, r.text) for r in docs.collect()], found)
    loads = Counter()
    for r in found:
        loads[r.shard] += r.size
    assert max(loads.values()) <= 1.1 * sum(loads.values()) / 16
    assert {(r.doc_id, r.shard, r.slot) for r in shard_documents(docs.repartition(7)).collect()} == {
        (r.doc_id, r.shard, r.slot) for r in found
    }


def test_many_rows_alike_in_id_and_text(spark):
    rows = [(None, "the same text")] * 6000 + [(7, "x")] * 2000 + [(100 + i, f"text {i}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = shard_documents(docs).collect()
    check(rows, found)
    loads = Counter()
    for r in found:
        loads[r.shard] += r.size
    assert len(loads) == 16 and max(loads.values()) <= 1.1 * sum(loads.values()) / 16


def test_hand_made(spark):
    rows = [(1, "a"), (1, "a"), (None, None), (None, "é" * 5000), (2, ""), (3, "x")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, slot int, shard int")
    check(rows, shard_documents(docs).collect())
    assert shard_documents(docs.limit(0)).count() == 0


def test_map_versions(spark, sf_dir):
    slotted = with_slots(spark.read.parquet(f"{sf_dir}/documents.parquet"), slots=64)
    rows = slot_maps(slotted, 4, 64).collect()
    assert Counter(r.version for r in rows) == {1: 64, 2: 64}
    assert [r.shard for r in sorted(rows, key=lambda r: (r.version, r.slot))][:64] == initial_map(64, 4)


def test_rebalance_moves_little_and_fills_a_new_shard():
    random.seed(3)
    sizes = [Slot(s, random.randint(1, 1000), 1) for s in range(512)]
    start = rebalance(initial_map(512, 8), sizes, 8)
    grown = rebalance(start, sizes, 9)
    loads = Counter()
    for s in sizes:
        loads[grown[s.slot]] += s.bytes
    assert max(loads.values()) - min(loads.values()) <= 0.02 * sum(loads.values()) / 9
    assert sum(a != b for a, b in zip(start, grown)) < 512 / 4
