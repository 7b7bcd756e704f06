"""Near-duplicate classes against all pairs, and signatures against the similarity they estimate."""

import math
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa

from releasecat.llm import neardup
from releasecat.llm.neardup import (
    NearDup,
    band_table,
    compare_block,
    components,
    connect,
    each_text,
    extended,
    find_links,
    jaccard,
    keep_one_of_each,
    link_texts,
    near_duplicate_classes,
    rare_shared_shingles,
    signatures,
    spanning_tree,
    text_key,
    weighted_shingles,
)

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingle_weights(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    times = Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else {}
    return {s: 1 + math.log(n) for s, n in times.items()}


def linked(a, b, least):
    """Whether the sets, or the weighted shingles by the definition of their similarity, are alike."""
    shared = a.keys() & b.keys()
    if len(shared) >= least * len(a.keys() | b.keys()):
        return True
    if min(sum(w[s] for s in shared) / sum(w.values()) for w in (a, b)) < least:
        return False
    return by_definition(a, b) >= least


def by_definition(a, b):
    every = sorted(a.keys() | b.keys())
    x, y = (np.array([w.get(s, 0) for s in every]) for w in (a, b))
    return sum(1 / np.maximum(x / p, y / q).sum() for p, q in zip(x, y) if p and q)


def classes(rows, least=0.8):
    """Class of each row by a union of all linked pairs."""
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets, holders, by_text = [shingle_weights(t) for _, t in rows], defaultdict(list), {}
    for i, s in enumerate(sets):
        parent[root(i)] = root(by_text.setdefault(rows[i][1] or "", i))
        for x in s:
            holders[x].append(i)
    pairs = {p for h in holders.values() for p in combinations(h, 2)}
    for a, b in pairs:
        if root(a) != root(b) and linked(sets[a], sets[b], least):
            parent[root(a)] = root(b)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(rows[i][0])
    return sorted((i, min((x for x in g if x is not None), default=None)) for g in groups.values() for i in g if i is not None)


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = classes([(r.doc_id, r.text) for r in docs.collect()])
    found = near_duplicate_classes(docs).collect()
    assert sorted((r.doc_id, r.class_id) for r in found) == expected


def test_hand_made(spark):
    random.seed(6)
    base = [f"w{i}" for i in range(200)]
    rows = [(n, " ".join(w if random.random() > 0.012 else "x" for w in base)) for n in range(60)]
    # A chain: neighbours are alike, the ends are not.
    rows += [(100 + n, " ".join(f"c{i}" for i in range(12 * n, 12 * n + 200))) for n in range(12)]
    rows += [(200, None), (201, ""), (202, " .,"), (203, "one two"), (204, "One, two!"), (205, "one"), (206, base[0] + " long" * 30000), (207, "tie " * 9), (208, "tie " * 90)]
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, key string, class_id int")
    assert sorted((r.doc_id, r.class_id) for r in near_duplicate_classes(docs).collect()) == classes(rows)
    assert keep_one_of_each(docs.limit(0)).count() == 0
    odd = docs.where("doc_id in (203, 207)").union(docs.where("doc_id = 203")).union(docs.where("doc_id = 204").selectExpr("NULL", "text", "key", "class_id"))
    kept = keep_one_of_each(odd)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [203, 207]
    assert sorted((r.doc_id or -1, r.class_id) for r in near_duplicate_classes(odd).collect()) == [(-1, 203), (203, 203), (203, 203), (207, 207)]


def test_one_bucket_is_connected_without_its_pairs(spark):
    """All texts share one band; links are between neighbours only, so most lie beside the pivot."""
    words = [f"v{i}" for i in range(300)]
    rows = [(n, " ".join(words[8 * n : 8 * n + 120])) for n in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bands = docs.select(text_key().alias("key")).selectExpr("key", "1L AS band")
    expected = {c for _, c in classes(rows)}
    for together in (1, 512):
        links = components(find_links(bands, docs, NearDup(together=together)))
        assert len(expected) == links.select("component").distinct().count() + len(rows) - links.count()


def test_a_member_apart_in_another_bucket_still_links(spark):
    """Text 2 joins pivot 0 in the second turn but stays apart from pivot 10; text 3 is linked to text 2 alone."""
    words = [f"v{i}" for i in range(300)]
    rows = [(n, " ".join(words[8 * n : 8 * n + 120])) for n in range(4)]
    rows += [(n, " ".join(f"u{n}x{i}" for i in range(120))) for n in range(10, 16)]
    buckets = [(0, 1, 2, 3), (2, 10), (0, 11), (0, 12), (10, 13), (10, 14), (10, 15)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", text_key().alias("key"))
    of = spark.createDataFrame([(n, b) for b, members in enumerate(buckets) for n in members], "doc_id long, band long")
    links = components(find_links(docs.join(of, "doc_id").select("key", "band"), docs, NearDup()))
    found = {r.doc_id: r.component for r in docs.join(links, "key").collect()}
    assert set(found) == {0, 1, 2, 3} and len(set(found.values())) == 1


def test_small_buckets_are_compared_exactly():
    random.seed(3)
    texts = ["", "a", "a b c d e f"] + [" ".join(f"w{random.randint(0, 9) if random.random() < 0.1 else i}" for i in range(60)) for _ in range(30)]
    found = compare_block(pa.array(texts), 5).similarity
    sets = [shingle_weights(t).keys() for t in texts]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert abs(found[i, j] - (len(a & b) / len(a | b) if a | b else 1)) < 1e-12
    near = found >= 0.5
    assert len(spanning_tree(near)) == len(texts) - _parts(near)


def repeating(rng, n):
    """Texts of a few families whose lines repeat from one to sixty times."""
    lines = [[" ".join(f"f{f}l{i}w{k}" for k in range(9)) for i in range(12)] for f in range(3)]
    return ["\n".join(line for line in lines[f % 3] if rng.random() < 0.9 for _ in range(rng.choice([1, 1, 2, 20, 60]))) + f" end {f}" for f in range(n)]


def test_weighted_similarity_equals_its_definition():
    texts = ["", "a", *repeating(random.Random(8), 20)]
    own, held = [shingle_weights(t) for t in texts], each_text(pa.array(texts), 5)
    block = compare_block(pa.array(texts), 5)
    for i, a in enumerate(own):
        for j, b in enumerate(own):
            sets, weighted = jaccard(held[i], held[j])
            exact = by_definition(a, b) if a and b else float(i == j)
            assert abs(weighted - exact) < 1e-12 and abs(sets - block.similarity[i, j]) < 1e-12
            assert i == j or not (held[i].uneven or held[j].uneven) or weighted <= block.most[i, j] + 1e-5
    for least in (0.5, 0.6, 0.7, 0.8):
        near = np.array([[i == j or bool(a and b) and linked(a, b, least) for j, b in enumerate(own)] for i, a in enumerate(own)])
        links = connect(block, least)
        assert all(near[a, b] for a, b in links) and len(links) == len(texts) - _parts(near)


def test_links_by_weight_alone(spark):
    """Texts that share what they repeat and differ in much that stands once."""
    rng = random.Random(9)
    shared = [" ".join(f"line{i}w{k}" for k in range(12)) for i in range(8)]
    rows = [(n, "\n".join(shared * 40) + "".join(f" own{n}x{i}" for i in range(30))) for n in range(9)]
    a, b = shingle_weights(rows[0][1]), shingle_weights(rows[1][1])
    assert len(a.keys() & b.keys()) < 0.7 * len(a.keys() | b.keys()) and by_definition(a, b) >= 0.8
    rows += [(100 + n, text) for n, text in enumerate(repeating(rng, 30))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = classes(rows)
    assert {c for i, c in expected if i < 100} == {0}
    assert sorted((r.doc_id, r.class_id) for r in near_duplicate_classes(docs).collect()) == expected


def _parts(near):
    seen, parts = set(), 0
    for i in range(len(near)):
        if i not in seen:
            parts += 1
            waiting = [i]
            while waiting:
                k = waiting.pop()
                if k not in seen:
                    seen.add(k)
                    waiting += np.flatnonzero(near[k]).tolist()
    return parts


def test_signatures_estimate_probability_jaccard():
    a = [f"a{i}" for i in range(60)] + ["r"] * 9
    b = [f"a{i}" for i in range(20, 75)] + ["r"] * 3
    column = pa.array([" ".join(a), " ".join(b)])
    text, hashes, weights = weighted_shingles(column, 1)
    p, q = ({h: w / weights[text == t].sum() for h, w in zip(hashes[text == t], weights[text == t])} for t in (0, 1))
    exact = sum(
        1 / sum(max(p.get(e, 0) / p[d], q.get(e, 0) / q[d]) for e in {*p, *q}) for d in set(p) & set(q)
    )
    size = 20000
    s = signatures(text, hashes, weights, 2, size)
    assert abs((s[0] == s[1]).mean() - exact) < 4 * np.sqrt(exact * (1 - exact) / size)


def test_repeated_shingles_do_not_hide_a_pair(spark):
    """Pairs with a set similarity of 0.83 whose own shingles repeat 50 times share a band."""
    rows = []
    for n in range(20):
        shared = [f"s{n}x{i}" for i in range(244)]
        rows += [(2 * n + side, " ".join(shared + [f"o{n}y{side}z{i}" for i in range(20)] * 50)) for side in (0, 1)]
    found = {r.doc_id: set(r.bands) for r in band_table(spark.createDataFrame(rows, "doc_id long, text string"), NearDup()).collect()}
    assert all(found[2 * n] & found[2 * n + 1] for n in range(20))


def test_few_links_are_few_files_and_later_links_extend_the_labels(spark):
    """Labels of few keys are stored in few files, not one for each shuffle partition; further links change what they join."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(held, ("48", "false")):
            spark.conf.set(k, v)
        links = spark.range(200).selectExpr("id AS a", "id + 1 AS b").where("a % 4 < 3")
        first = components(links)
        assert len(first.inputFiles()) <= 16
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert {(r.key, r.component) for r in first.collect()} == {(i, i - i % 4) for i in range(200)}
    more = spark.createDataFrame([(3, 4), (9, 14), (300, 301), (198, 302), (20, 21), (303, 301)], "a long, b long")
    for extra in (more, spark.createDataFrame([(0, 3), (7, 9)], "a long, b long")):
        links = links.union(extra)
        first = extended(first, extra)
        assert sorted(first.collect()) == sorted(components(links).select("key", "component").collect())


def test_labels_are_the_components_of_the_links(spark):
    """Chains in one bucket, with texts that join their pivot's component in later turns and in later rounds."""
    words = [f"v{i}" for i in range(300)]
    rows = [(100 * f + n, " ".join(f"{f}{w}" for w in words[8 * n : 8 * n + 120])) for f in range(2) for n in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bands = docs.select(text_key().alias("key")).selectExpr("key", "1L AS band")
    links, labels = link_texts(bands, docs, NearDup(together=4))
    assert sorted(labels.collect()) == sorted(components(links).collect())
    assert labels.count() == len(rows) and labels.select("component").distinct().count() == 2


def test_a_large_bucket_of_unlike_texts_takes_one_turn(spark, monkeypatch):
    """Texts that share some lines and a band and are not alike, but for three of them; none takes a turn of its own."""
    turns, compare = [], neardup.similarities
    monkeypatch.setattr(neardup, "similarities", lambda *a: turns.append(1) or compare(*a))
    shared = " ".join(f"s{i}" for i in range(40))
    rows = [(n, f"{shared} " + " ".join(f"o{n}x{i}" for i in range(60))) for n in range(14)]
    rows += [(20 + n, rows[5 * n][1] + " end") for n in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", text_key().alias("key"))
    links, labels = link_texts(docs.selectExpr("key", "1L AS band"), docs, NearDup(together=4))
    found = docs.join(labels, "key").groupBy("component").agg({"doc_id": "collect_set"}).collect()
    assert sorted(sorted(r[1]) for r in found) == [[0, 20], [5, 21], [10, 22]] and links.count() >= 3
    assert len(turns) == 1


def test_linked_texts_share_a_rare_shingle(spark):
    """Any two that are linked, by sets or by weights alone."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(100)]
    texts = [" ".join(w if rng.random() > 0.012 else f"x{rng.random()}" for w in base) for _ in range(25)] + repeating(rng, 25)
    lines = [" ".join(f"line{i}w{k}" for k in range(12)) for i in range(8)]
    texts += ["\n".join(lines * 40) + "".join(f" own{n}x{i}" for i in range(30)) for n in range(5)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").select("text", text_key().alias("key")).dropDuplicates(["key"])
    of, rows = defaultdict(set), docs.collect()
    for r in rare_shared_shingles(docs.select("key"), docs, NearDup()).collect():
        of[bytes(r.key)].add(r.shingle)
    own = [(bytes(r.key), shingle_weights(r.text)) for r in rows]
    pairs = [(a, b) for (a, x), (b, y) in combinations(own, 2) if linked(x, y, 0.8)]
    assert len(pairs) > 50 and all(of[a] & of[b] for a, b in pairs)
    assert sum(map(len, of.values())) < 0.7 * sum(len(x) for _, x in own)
