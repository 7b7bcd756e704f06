"""Language by code lengths: the frozen costs against a plain statement of the rule, and held-out accuracy."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from releasecat.llm.language import Scorer, Table, freeze, identify_languages, string_counts
from releasecat.llm.text import prepare
from releasecat.llm.toxicity import held_out


def plain_bits(training, text, depth=4):
    """Code length of a text by the counts of some training texts."""
    counts = Counter()
    for t in training:
        data = t.encode()
        for end in range(1, len(data) + 1):
            for size in range(1, min(depth + 1, end) + 1):
                counts[data[end - size : end]] += 1
    total = 0.0
    data = text.encode()
    for end in range(1, len(data) + 1):
        for size in range(min(depth, end - 1), -2, -1):
            if size < 0:
                total += 8
                break
            context, symbol = data[end - 1 - size : end - 1], data[end - 1 : end]
            seen = {bytes([b]): counts[context + bytes([b])] for b in range(256) if counts[context + bytes([b])]}
            if not seen:
                continue
            whole = sum(seen.values()) + len(seen)
            if symbol in seen:
                total -= math.log2(seen[symbol] / whole)
                break
            total -= math.log2(len(seen) / whole)
    return total


def test_code_lengths(spark):
    random.seed(2)
    training = {"x": ["abab abba", "ab", "é é"], "y": ["cdcd cdd", "abcd"]}
    rows = [(lang, t) for lang, texts in training.items() for t in texts]
    counts = string_counts(spark.createDataFrame(rows, "lang string, text string")).toPandas()
    model = freeze(*(counts[c].to_numpy() for c in ("lang", "length", "key", "n")))
    texts = ["abab", "cdcdcd", "", "zéz", "q"] + ["".join(random.choice("abcdéz ") for _ in range(12)) for _ in range(30)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    found = Scorer(model).lengths(data, offsets)
    for i, text in enumerate(texts):
        for j, lang in enumerate(model.languages):
            assert found[i, j] == pytest.approx(plain_bits(training[lang], text), rel=1e-5)


def test_table():
    generator = np.random.default_rng(1)
    keys = np.unique(generator.integers(0, 1 << 40, 5000).astype(np.uint64))
    table = Table(keys)
    assert (table.find(keys) == np.arange(len(keys))).all()
    others = np.setdiff1d(generator.integers(0, 1 << 40, 5000).astype(np.uint64), keys)
    assert (table.find(others) == -1).all()


def test_held_out_accuracy(spark):
    prepare(spark)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    judged = [r for r in found if r.held_out]
    assert len(found) == docs.count() and len(judged) > 200
    assert sum(r.lang == r.lang_pred for r in judged) > 0.97 * len(judged)
    assert all(0 <= r.score <= 1 for r in found)


def test_odd_rows(spark):
    prepare(spark)
    rows = [(n, "the and of with " * 9, "en") for n in range(9)] + [(n, "der die das und " * 9, "de") for n in range(9, 18)]
    rows += [(20, None, "en"), (21, "", "de"), (22, "12 34 !", None), (23, "der und", None), (None, "the of", None), (23, "der und", None), (24, "the of " * 50000, None)]
    docs = spark.createDataFrame([(*r, 1.0, True) for r in rows], "doc_id long, text string, lang string, score double, held_out boolean")
    found = sorted(((r.doc_id or -1, r.lang_pred) for r in identify_languages(docs).collect()))
    assert found[0] == (-1, "en")
    assert [p for i, p in found if i >= 20] == ["und", "und", "und", "de", "de", "en"]
    assert identify_languages(docs.limit(0)).count() == 0
    unknown = identify_languages(docs.withColumn("lang", docs["text"].substr(1, 0)).where("doc_id = 23").selectExpr("doc_id", "text", "cast(null as string) lang"))
    assert {(r.lang_pred, r.score) for r in unknown.collect()} == {("und", 0.0)}
    ids = {r.doc_id: r.h for r in docs.select("doc_id", held_out("doc_id").alias("h")).distinct().collect()}
    import zlib

    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in ids.items() if i is not None)
