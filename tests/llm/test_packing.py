"""Tokens against the tokenizer itself, cuts against all cuts, and packing as an exact round trip."""

import random
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from releasecat.llm.packing import OTHER_CUT, candidates, choose_cuts, pack_documents
from releasecat.llm.tokens import WordTokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


def encode(plain, text):
    return plain.encode(text or "", add_special_tokens=False).ids


def test_tokens_equal_the_tokenizer(plain):
    random.seed(5)
    texts = [None, "", "  ", "It's they're I'll I'd 'tis ''s !'s x's's DON'T 're'll 'v 'l", "a1b22 3.5 ½²ª µß", "日本 text. ok\nx", "é <|endoftext|> A."]
    texts += ["".join(chr(c) for c in range(256)), " ".join(chr(c) for c in range(256))]
    letters = [chr(c) for c in range(256)] + list("'stmdrevl'''  .\n\x1c\x85\xa0 ")
    texts += ["".join(random.choice(letters) for _ in range(random.randint(0, 60))) for _ in range(3000)]
    # Control characters and all kinds of white space among characters beyond Latin-1 and special marks.
    mixed = list("日本あя.!?<|>ab1 \n\t\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u2003\u2028\u2029\u3000\u200b\ufeff")
    texts += ["日\x1c\nb", "日 a!\x1fb", "<| a.\x1cb"]
    texts += ["日" + "".join(random.choice(mixed) for _ in range(random.randint(0, 40))) for _ in range(3000)]
    words = WordTokenizer(PATH, 2)
    for _ in range(2):
        tokens = words.encode(texts)
        assert tokens.counts.sum() == len(tokens.ids)
        for text, ids in zip(texts, np.split(tokens.ids, np.cumsum(tokens.counts)[:-1]), strict=True):
            assert ids.tolist() == [*encode(plain, text), 2], repr(text)


def test_cuts_cost_least():
    random.seed(1)
    for _ in range(60):
        total, window = random.randint(1, 60), random.randint(5, 20)
        inner = sorted(random.sample(range(1, total), min(total - 1, 6)))
        documents, sentences = np.array(inner[::2], np.int64), np.array(inner[1::2], np.int64)
        places, costs = candidates(total, documents, sentences, window)
        if len(places) > 12:
            continue

        def price(cuts):
            return sum(window - places[b] + places[a] + costs[b] for a, b in zip(cuts, cuts[1:]))

        def fits(cuts):
            return all(places[b] - places[a] <= window for a, b in zip(cuts, cuts[1:]))

        ends = len(places) - 1
        every = ([0, *c, ends] for n in range(ends) for c in combinations(range(1, ends), n))
        assert price(choose_cuts(places, costs, window)) == min(price(c) for c in every if fits(c))
    assert OTHER_CUT > 0


def check(plain, rows, pieces, window=4096):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length > 0
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == {i for i, _ in rows}
    for i, text in rows:
        ids = [*encode(plain, text), 2]
        parts = sorted(by_doc[i], key=lambda p: p.start)
        assert b"".join(p.ids for p in parts) == np.array(ids, "<u4").tobytes()
        assert [p.start for p in parts] == np.cumsum([0] + [p.length for p in parts])[:-1].tolist()
        assert {p.doc_tokens for p in parts} == {len(ids)}
    used = []
    for parts in by_sequence.values():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == np.cumsum([0] + [p.length for p in parts])[:-1].tolist()
        used.append(sum(p.length for p in parts))
    assert max(used) <= window
    return sum(used) / (window * len(used))


def test_documents(spark, sf_dir, plain):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert check(plain, rows, pack_documents(docs, PATH, blocks=1).collect()) > 0.97
    assert check(plain, rows, pack_documents(docs, PATH, window=256, blocks=3).collect(), 256) > 0.9


def test_hand_made(spark, plain):
    rows = [(1, None), (2, ""), (3, "word " * 9000), (4, "One. Two! Three?\n" * 2000), (5, "日本語。" * 3000), (None, "x")]
    docs = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id int, text string, length int, ids string")
    check(plain, rows, pack_documents(docs, PATH).collect())
    assert pack_documents(docs.limit(0), PATH).count() == 0
    twice = pack_documents(docs.where("doc_id = 3").union(docs.where("doc_id = 3")), PATH).collect()
    assert sum(p.length for p in twice) == 2 * 9001
    assert zlib.crc32(b"".join(p.ids for p in sorted(twice, key=lambda p: (p.sequence_id, p.offset)))[:36004]) > 0
