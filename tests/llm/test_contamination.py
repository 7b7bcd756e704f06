"""Decontamination against an alignment of every document with every item."""

import random
import re

import numpy as np
import pyarrow as pa

from releasecat.llm.contamination import (
    GAP,
    MATCH,
    MISMATCH,
    SeedIndex,
    align,
    drop_contaminated,
    find_contamination,
    least_points,
    seed_files,
)
from releasecat.llm.text import utf8
from releasecat.llm.text import words as hashed_words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def slow_align(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (MATCH if x == y else MISMATCH), h[i - 1, j] - GAP, h[i, j - 1] - GAP)
    return int(h.max())


def test_alignment():
    random.seed(4)
    for _ in range(200):
        a = np.array([random.randint(0, 3) for _ in range(random.randint(1, 9))])
        b = np.array([random.randint(0, 3) for _ in range(random.randint(1, 14))])
        assert align(a, b)[0] == slow_align(a.tolist(), b.tolist())


def numbers(text, known):
    return np.array([known.setdefault(w, len(known)) for w in words(text)], int)


def holds(item, text):
    """By the score of the alignment alone; no score is higher than that of the item's words that the text has."""
    least = least_points(len(item))
    return len(item) > 1 and MATCH * np.isin(item, text).sum() >= least and align(item, text)[0] >= least


def edited(item, share, kinds=("change", "insert", "remove")):
    result = []
    for word in item:
        kind = random.choice(kinds) if random.random() < share else None
        result += {None: [word], "change": [f"z{random.random()}"], "insert": [word, f"z{random.random()}"], "remove": []}[kind]
    return result


def test_edited_copies_are_found_by_their_score_alone(spark):
    """Copies of items of 5 to 60 words with 10 to 40 % of edits, of every kind; few words, so that pairs repeat."""
    random.seed(11)
    items = [[f"v{random.randint(0, 400)}" for _ in range(random.randint(5, 60))] for _ in range(60)]
    filler = [f"v{i}" for i in range(400, 800)]
    rows, known, expected = [], {}, set()
    for n in range(600):
        copy = edited(items[n % 60], (0.1, 0.15, 0.2, 0.3, 0.4)[n % 5], random.choice([("change",), ("insert",), ("remove",), ("change", "insert", "remove")]))
        rows.append((n, " ".join(random.choices(filler, k=30) + copy + random.choices(filler, k=30))))
    tests = [numbers(" ".join(item), known) for item in items]
    for n, text in rows:
        text = numbers(text, known)
        expected |= {(n, i) for i, item in enumerate(tests) if holds(item, text)}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(i, " ".join(item)) for i, item in enumerate(items)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in find_contamination(docs, benchmark).collect()}
    assert found == expected and len(expected) > 400


def test_every_fifth_word_changed(spark):
    items = [[f"i{n}w{i}" for i in range(40)] for n in range(200)]
    rows = [(n, " ".join(f"e{i}" if i % 5 == 4 else w for i, w in enumerate(item))) for n, item in enumerate(items)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(n, " ".join(item)) for n, item in enumerate(items)], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in find_contamination(docs, benchmark).collect()) == [(n, n) for n in range(200)]


def test_short_items_must_stand_whole(spark):
    benchmark = spark.createDataFrame([(1, "yes"), (2, "red fish"), (3, "one two three four five"), (4, None)], "item_id long, text string")
    rows = [(1, "yes"), (2, "a red fish"), (3, "red old fish"), (4, "x one two three four five"), (5, "one two three five"), (6, "fish red")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in find_contamination(docs, benchmark).collect()) == [(2, 2), (4, 3)]


def test_a_stock_phrase_aligns_few_pairs(spark):
    stock = "which of the following statements is true".split()
    items = [stock + [f"i{n}w{i}" for i in range(15)] for n in range(300)]
    texts = [" ".join([f"d{n}w{i}" for i in range(20)] + stock + [f"d{n}v{i}" for i in range(20)]) for n in range(300)]
    known = hashed_words(*utf8(pa.array([" ".join(i) for i in items])))
    index = SeedIndex(list(range(300)), [known.hash[a:b].view(np.int64) for a, b in zip(known.first, known.first[1:])])
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    files = seed_files(docs, index)
    assert files.max() == 300 and (files > 0).sum() == 6
    index.leave_out_frequent(files)
    found = hashed_words(*utf8(pa.array(texts)))
    assert len(list(index.stretches(found))) == 0
    copies = hashed_words(*utf8(pa.array([" ".join(i) for i in items])))
    assert sorted((t, i) for t, i, _, _ in index.stretches(copies)) == [(n, n) for n in range(300)]


def test_documents(spark, sf_dir):
    docs, items = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    known, expected = {}, set()
    tests = [(r.item_id, numbers(r.text, known)) for r in items.collect()]
    for r in docs.collect():
        text = numbers(r.text, known)
        for item, held in tests:
            if holds(held, text):
                expected.add((r.doc_id, item))
    found = find_contamination(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected and len(found) == len(expected) > 0
    kept = drop_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - len({d for d, _ in expected})


def test_edited_copies_and_odd_rows(spark):
    random.seed(8)
    item = [f"w{i}" for i in range(40)]
    edited = [w if i % 7 else "other" for i, w in enumerate(item)]
    filler = [f"f{i}" for i in range(3000)]
    rows = [
        (1, " ".join(filler + edited + filler)), (2, " ".join(filler)), (3, None), (4, ""), (5, " ".join(item[:10] + filler)),
        (None, " ".join(item).upper()), (7, " ".join(item)), (7, " ".join(item)), (8, "in the same order " * 40),
    ]
    docs = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "doc_id long, text string, item_id long, score double")
    items = spark.createDataFrame([(9, " ".join(item), 3), (10, None, 3), (11, "a b", 3), (None, "x", 3)], "item_id long, text string, doc_id int")
    found = {r.doc_id: r for r in find_contamination(docs, items).collect()}
    assert set(found) == {1, None, 7} and {r.item_id for r in found.values()} == {9}
    assert (found[1].first_word, found[1].last_word) == (3001, 3039) and found[1].score < 1 == found[7].score
    assert sorted(r.doc_id for r in drop_contaminated(docs, items).collect()) == [2, 3, 4, 5, 8]
    assert find_contamination(docs.limit(0), items).count() == find_contamination(docs, items.limit(0)).count() == 0


def test_a_passage_that_many_items_share(spark):
    """Items with one passage and a question each: a document that holds the passage alone holds them all."""
    passage = [f"p{i}" for i in range(60)]
    items = [(n, " ".join(passage + [f"q{n}x{i}" for i in range(8)])) for n in range(7)]
    filler = [f"f{i}" for i in range(300)]
    rows = [(1, " ".join(filler + passage + filler)), (2, " ".join(filler))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = find_contamination(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, n) for n in range(7)]
    assert all(abs(r.score - 60 / 68) < 1e-9 and (r.first_word, r.last_word) == (300, 359) for r in found)


def test_rows_that_share_an_id_are_judged_by_their_texts(spark):
    item = "which of the seven rivers of the old kingdom runs through both of the capitals in winter"
    clean = "nothing of the kind stands in this text about boats and the people who build them by hand"
    rows = [(None, item), (None, clean), (None, None), (7, item), (7, clean), (8, clean), (9, item)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = sorted((tuple(r) for r in drop_contaminated(docs, benchmark).collect()), key=str)
    assert kept == sorted([(None, clean), (None, None), (7, clean), (8, clean)], key=str)
    found = find_contamination(docs, benchmark).collect()
    assert sorted((r.doc_id for r in found), key=str) == [7, 9, None]
