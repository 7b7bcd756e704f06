"""Toxicity: matching against a plain search, and held-out accuracy of the learned lexicon."""

import random

from releasecat.llm.text import prepare
from releasecat.llm.toxicity import Matcher, find_toxic, fold, learn_lexicon, reject_toxic, weight, without_copies, word_patterns


def test_folding():
    assert fold("You 1d10t, ЅСUМ!") == " you idiot  scum  "
    assert fold("") == "  " and fold("Straße\n$tupid") == " straße stupid "


def test_matching_is_a_plain_search():
    random.seed(1)
    patterns = (" ab", " abc ", "  b", " c ")
    matcher = Matcher(patterns, ("b c",))
    for _ in range(300):
        text = fold("".join(random.choice("abc ") for _ in range(14)))
        spared = [i for i in range(len(text)) if text.startswith(" b c ", i)]
        expected = {}
        for n, p in enumerate(patterns):
            places = [i for i in range(len(text)) if text.startswith(p, i)]
            count = sum(not any(s <= i and i + len(p) <= s + 5 for s in spared) for i in places)
            if count:
                expected[n] = count
        assert dict(matcher.count(text)) == expected
    assert Matcher(()).count(" x ") == {}


def test_weights_and_patterns():
    assert weight(100, 0, 200, 1000) > weight(10, 0, 200, 1000) > weight(3, 0, 200, 1000)
    assert weight(100, 0, 200, 1000) > weight(100, 50, 200, 1000)
    assert word_patterns(" worse a ") == {" worse ", " wor", " wors", " worse", " a "}


def test_held_out_accuracy(spark):
    prepare(spark)
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    found = find_toxic(docs, labels).join(labels, "doc_id").where("held_out").collect()
    toxic = [r for r in found if r.toxic]
    clean = [r for r in found if not r.toxic]
    assert sum(r.predicted for r in toxic) > 0.8 * len(toxic) and sum(r.predicted for r in clean) < 0.01 * len(clean)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)


def test_odd_rows(spark):
    prepare(spark)
    random.seed(4)
    word = lambda: "".join(random.choice("lmnop") for _ in range(5))
    rows = [(n, " ".join([word() for _ in range(20)] + ["grumblefoo"] * (n % 4 == 0))) for n in range(400)]
    labels = [(n, int(n % 4 == 0)) for n in range(400)] + [(0, 0), (None, 1), (5000, 1), (3, None)]
    rows += [(900, None), (901, ""), (902, "GRUMBLEF00 you"), (902, "GRUMBLEF00 you"), (None, "calm"), (903, "calm " * 60000)]
    docs = spark.createDataFrame([(*r, 1.0, 2) for r in rows], "doc_id long, text string, score double, toxic int")
    marks = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, toxic int, text string")
    found = find_toxic(docs, marks).collect()
    assert len(found) == len(rows)
    assert all(r.predicted == (r.doc_id == 902 or r.doc_id is not None and r.doc_id < 400 and r.doc_id % 4 == 0) for r in found)
    kept = reject_toxic(docs, marks)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 102
    assert find_toxic(docs.limit(0), marks).count() == 0
    assert find_toxic(docs, marks.limit(0)).where("predicted = 1").count() == 0


def test_short_comments_and_shared_passages_count(spark):
    prepare(spark)
    random.seed(5)
    word = lambda: "".join(random.choice("lmnop") for _ in range(6))
    rows = [(2 * n, f"{word()} grumblefoo", 1) for n in range(300)] + [(2 * n + 1, f"{word()} {word()}", 0) for n in range(300)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    lexicon = learn_lexicon(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))
    assert any(p.startswith(" grum") for p in lexicon.patterns)
    passage, own = " ".join(word() for _ in range(20)), [" ".join(word() for _ in range(30)) for _ in range(6)]
    texts = [f"{passage} {o}" for o in own]
    labelled = [(True, t) for t in texts + [texts[0], texts[1] + " end"]] + [(False, t) for t in [texts[0], texts[0], ""]]
    kept = without_copies(spark.createDataFrame(labelled, "toxic boolean, text string")).collect()
    assert sum(r.toxic for r in kept) == 6 and sum(not r.toxic for r in kept) == 2
