"""Fingerprints against plain Python over the ordered documents."""

import hashlib

from releasecat.llm.fingerprints import build_tree, compare_edits, differences, fingerprint_documents, from_text, likeness, to_text


def check(rows, found):
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    expected = []
    for (i, a), (_, b) in zip(order, order[1:] + order[:1]):
        cut = len(a) // 4
        edited = a[: len(a) - cut] + b[:cut]
        trees = build_tree(a), build_tree(edited), build_tree(b)
        expected.append((
            -1 if i is None else i, len(a), hashlib.sha256(edited.encode()).hexdigest(), to_text(trees[0]), to_text(trees[1]),
            likeness(trees[0], trees[1]), likeness(trees[0], trees[2]),
        ))
    assert sorted((-1 if r.doc_id is None else r.doc_id, *r[1:]) for r in found) == sorted(expected)


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = compare_edits(docs).collect()
    check(rows, found)
    assert sum(r.near_edited > r.near_next for r in found) > 0.95 * len(found)
    assert {r.doc_id: r.fingerprint for r in fingerprint_documents(docs).collect()} == {r.doc_id: r.fingerprint for r in found}


def test_hand_made(spark):
    rows = [(5, "a b. " * 4000), (None, "first"), (1, None), (1, ""), (9, "é日本語" * 7), (2, "one\n\ntwo"), (5, "a b. " * 4000), (-3, "x")]
    docs = spark.createDataFrame([(*r, 1, True) for r in rows], "doc_id long, text string, block int, borrowed boolean")
    check(rows, compare_edits(docs).collect())
    check(rows[:1], compare_edits(docs.limit(1)).collect())
    assert compare_edits(docs.limit(0)).count() == 0


def test_trees():
    a = build_tree("Title\n\nOne two. Three\nfour\n\nlast")
    assert from_text(to_text(a)) == a
    assert likeness(a, a) == 1 and differences(a, a) == ([], [])
    b = build_tree("Title\n\nOne two. Three\nfive\n\nlast")
    assert differences(a, b) == ([(1, 1)], [(1, 1)])
    assert 0 < likeness(a, b) < 1
    assert build_tree("x\n\ny").root != build_tree("x\n\n\ny").root != build_tree("x\ny").root
