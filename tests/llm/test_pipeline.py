"""The pipeline's stages, one after another, against plain Python over what each was given."""

import re

import corpus_pipeline
import numpy as np
from test_contamination import holds, numbers
from test_neardup import classes
from tokenizers import Tokenizer

from releasecat.llm.queries import vocabulary_path
from releasecat.llm.secrets import find_secrets, redact
from releasecat.llm.text import prepare
from releasecat.llm.toxicity import Matcher, keep, learn_lexicon, score
from releasecat.session import cut_lineage


def rows_of(docs):
    return {r.doc_id: tuple(r) for r in docs.collect()}


def test_stages(spark, sf_dir):
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("labels", "benchmark"))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "secrets", "packing"]
    columns = docs.columns
    given, before = docs, rows_of(docs)
    known = {}
    items = [numbers(r.text, known) for r in benchmark.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        given = cut_lineage(stage(spark, given, sf_dir), name)
        assert given.columns == columns
        after = rows_of(given)
        if name == "toxicity":
            lexicon = learn_lexicon(keep(docs, doc_id="doc_id", text="text"), keep(labels, doc_id="doc_id", toxic="toxic"))
            matcher = Matcher(lexicon.patterns, lexicon.exceptions)
            expected = {i: r for i, r in before.items() if score(lexicon, matcher, r[1]) < 0.7}
        elif name == "near_dedup":
            expected = {c: before[c] for _, c in classes([(i, r[1]) for i, r in before.items()])}
        elif name == "decontamination":
            expected = {i: r for i, r in before.items() if not any(holds(item, numbers(r[1], known)) for item in items)}
        else:
            texts = {i: redact(r[1], find_secrets(r[1])) for i, r in before.items()}
            expected = {i: (i, texts[i], r[2], r[3], len(texts[i])) for i, r in before.items()}
            assert not any(re.search(r"token = \"[0-9a-f]{24}", t) for t in texts.values())
        assert after == expected and 0 < len(after) <= len(before)
        before = after
    plain = Tokenizer.from_file(vocabulary_path())
    pieces = corpus_pipeline.STAGES[-1][1](spark, given, sf_dir).collect()
    packed = {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        packed[p.doc_id] = packed.get(p.doc_id, b"") + bytes(p.ids)
    assert packed == {i: np.array([*plain.encode(r[1], add_special_tokens=False).ids, 2], "<u4").tobytes() for i, r in before.items()}
    assert {tuple(p) for p in corpus_pipeline.run(spark, sf_dir).collect()} == {tuple(p) for p in pieces}


def test_odd_rows_and_empty_tables(spark, sf_dir):
    prepare(spark)
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first().text
    rows = [
        (1, None), (2, ""), (None, "plain words about boats and the people who build them"), (4, item), (4, "another text of the same number"),
        (5, "twice the same row of some words"), (5, "twice the same row of some words"), (6, "long " * 50000), (None, None),
    ]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, score double, text_key string, words string, sequence_id int"
    docs = spark.createDataFrame([(*r, "xx", "s", None if r[1] is None else len(r[1]), 0.5, "k", "w", 3) for r in rows], kinds)

    def through(docs):
        kept = [docs]
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept.append(cut_lineage(stage(spark, kept[-1], sf_dir), name))
            assert kept[-1].schema.names == docs.schema.names
        return [[(r.doc_id, r.text) for r in k.collect()] for k in kept], corpus_pipeline.STAGES[-1][1](spark, kept[-1], sf_dir)

    (given, clean, single, other, redacted), pieces = through(docs)
    # Nothing here is toxic; of equal texts, null among the empty ones, the least id stays; only the row with the item goes.
    assert sorted(clean, key=str) == sorted(given, key=str) == sorted(rows, key=str)
    assert set(single) == set(rows) - {(None, None), (2, "")} and len(single) == len(set(rows)) - 2
    assert sorted(other, key=str) == sorted(redacted, key=str) == sorted((r for r in single if r[1] != item), key=str)
    assert {p.doc_id for p in pieces.collect()} == {r[0] for r in redacted}
    nothing, pieces = through(docs.limit(0))
    assert nothing == [[]] * 5 and pieces.count() == 0
