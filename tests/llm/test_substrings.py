"""Removal of repeated strings against a table of all windows, and the suffix order against sorting."""

import random

from pyspark.sql import functions as F

from releasecat.llm.substrings import place_documents, remove_repeats, repeated_spans, run_contexts, matched_runs, suffix_order


def plain(rows, length):
    """Of each row: bytes, removed spans, bytes left."""
    first, found = {}, []
    for order, (i, text) in sorted(enumerate(rows), key=lambda r: (r[1][0] is not None, r[1][0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for start in range(len(data) - length + 1):
            if first.setdefault(data[start : start + length], (order, start)) != (order, start):
                gone[start : start + length] = b"\1" * length
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(gone)))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        found.append((-1 if i is None else i, len(data), sum(gone), spans, kept))
    return sorted(found)


def check(docs, rows, length, **more):
    found = remove_repeats(docs, length, **more).collect()
    got = sorted(
        (-1 if r.doc_id is None else r.doc_id, r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans), bytes(r.kept))
        for r in found
    )
    assert got == plain(rows, length)


def test_suffix_order():
    random.seed(1)
    for _ in range(3000):
        symbols = [random.randint(1, random.choice([1, 2, 3, 6])) for _ in range(random.randint(0, 40))] + [0]
        assert suffix_order(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])
    for symbols in ([1] * 500 + [0], [1, 2] * 300 + [0], [2, 1, 1] * 200 + [0]):
        assert suffix_order(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check(docs, [(r.doc_id, r.text) for r in docs.collect()], 100)


def pieces(seed, count):
    random.seed(seed)
    parts = ["".join(random.choice("abc ") for _ in range(random.randint(1, 90))) for _ in range(12)] + ["é" * 30, "\n" * 50, "x" * 70]
    return [(n, "".join(random.choice(parts) for _ in range(random.randint(0, 9)))) for n in range(count)]


def test_mixed_pieces(spark):
    for length, seed in ((40, 1), (100, 2), (12, 3)):
        rows = pieces(seed, 80)
        random.shuffle(rows)
        docs = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id int, text string, start int, spans string")
        check(docs, rows, length)


def test_grams_with_too_many_contexts(spark):
    rows = pieces(4, 80)
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    check(docs, rows, 40, most=1)
    placed = place_documents(docs)
    steps = matched_runs(placed, 40, 1)
    assert steps.where("kind = 2").count() > 0 and run_contexts(steps, placed).count() > 0


def test_hand_made(spark):
    random.seed(9)
    long = "".join(random.choice("abcdefghij") for _ in range(300_000))
    rows = [(1, None), (2, ""), (3, "short"), (4, "short"), (5, "a" * 99), (6, "a" * 100), (7, "a" * 101), (8, long), (-5, long[1000:1200]), (9, "é" * 120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(docs, rows, 100)
    assert remove_repeats(docs.limit(0)).count() == 0
    one = spark.createDataFrame([(1, long[:500]), (1, long[:500]), (None, long[:250])], "doc_id long, text string")
    got = [(r.doc_id, [tuple(s) for s in r.spans]) for r in remove_repeats(one).collect()]
    assert sorted(got, key=str) == sorted([(1, [(0, 250)]), (1, [(0, 250)]), (None, [])], key=str)
    assert repeated_spans(place_documents(docs)).columns == ["doc", "tie", "spans"]


def test_texts_of_one_id_whose_short_hashes_are_equal(spark):
    texts = spark.range(300_000).selectExpr("concat('text number ', id, ' ', md5(string(id)), ' that nothing else holds') AS text")
    pair = texts.groupBy(F.hash("text")).agg(F.min("text"), F.max("text"), F.count(F.lit(1)).alias("n")).where("n = 2").first()
    a, b = pair[1], pair[2]
    rows = [(1, a), (5, a), (5, b), (None, a[:60]), (None, b[:60])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, bytes(r.kept).decode()) for r in remove_repeats(docs, 61).collect()}
    assert found == {(1, a), (5, ""), (5, b), (None, a[:60]), (None, b[:60])}
