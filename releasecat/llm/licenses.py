"""License scan by a positional index of rare license words; DataFrame functions only.

Each notice is indexed by the places of its rarest words.  A word of a file that is in the index tells where the
notice would begin; tellings that agree within ``SLACK`` words are added up, so words may be put in or left out.  A
notice is found where enough of its weight agrees and its key phrases stand there.
"""

from __future__ import annotations

import json
import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .text import keep

# Phrases that are counted, and the label of each.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices the index is built from: label, the notice, key phrases of which all must stand in a file.
TEMPLATES = (
    ("agpl-3.0", "this program is licensed under the gnu affero general public license version 3", ("affero general public license",)),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    ("bsd-3-clause", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("cc-by-4.0", "this work is licensed under the creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    ("cc-by-nc-4.0", "this work is licensed under the creative commons attribution noncommercial 4 0 international license", ("attribution noncommercial 4 0",)),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    ("cc0-1.0", "this work is dedicated to the public domain under cc0 1 0 universal", ("cc0 1 0",)),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify and or distribute this software",)),
    ("lgpl-3.0", "licensed under the gnu lesser general public license version 3", ("gnu lesser general public license",)),
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted free of charge",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    ("agpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version", ("gnu affero general public license", "version 3")),
    ("gpl-2.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", ("gnu general public license", "version 2")),
    ("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", ("gnu general public license", "version 3")),
    ("lgpl-2.1", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version", ("gnu lesser general public license", "version 2 1")),
    ("lgpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version", ("gnu lesser general public license", "version 3")),
    ("cc-by-nd-4.0", "this work is licensed under a creative commons attribution noderivatives 4 0 international license", ("attribution noderivatives 4 0",)),
    ("cc-by-nc-sa-4.0", "this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international license", ("attribution noncommercial sharealike 4 0",)),
    ("cc-by-nc-nd-4.0", "this work is licensed under a creative commons attribution noncommercial noderivatives 4 0 international license", ("attribution noncommercial noderivatives 4 0",)),
    ("cc-by-sa-4.0", "this work is licensed under a creative commons attribution sharealike 4 0 international license", ("attribution sharealike 4 0",)),
    ("bsl-1.0", "distributed under the boost software license version 1 0", ("boost software license",)),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", ("eclipse public license",)),
)

# A word, as Java reads the pattern; A-Z are in it because texts are not lower-cased first.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Share of a notice's weight that its rarest words are indexed for, and share of that weight that must be in place.
INDEXED_SHARE = 0.9
LEAST_SHARE = 0.6
# Words by which two words of a notice may stand nearer or further apart in a file.
SLACK = 8


def text_words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased."""
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(f"{_WORD}+"), 0)


def phrase_starts(words: Column, phrase: str) -> Column:
    """Places, from 0, at which the words of a phrase stand one after another."""
    parts = phrase.split()
    places = F.sequence(F.lit(0), F.size(words) - len(parts))

    def fits(place: Column) -> Column:
        found = F.get(words, place) == parts[0]
        for step, part in enumerate(parts[1:], 1):
            found = found & (F.get(words, place + step) == part)
        return found

    return F.when(F.size(words) >= len(parts), F.filter(places, fits)).otherwise(F.array().cast("array<int>"))


def _vocabulary() -> list[str]:
    return sorted({w for _, notice, _ in TEMPLATES for w in notice.split()} | {w for p in PHRASES for w in p.split()})


def _literal(values: list) -> Column:
    """A nested list of words as one literal."""
    kind = "array<array<string>>" if values and isinstance(values[0], list) else "array<string>"
    return F.from_json(F.lit(json.dumps(values)), kind)


def licensed_words(docs: DataFrame) -> DataFrame:
    """One row for each text: ``row, doc_id, n_words, held, starts, base, words``.

    ``held`` are the words of notices and phrases in the text, ``starts`` and ``base`` places and labels of
    ``PHRASES``.  ``words`` are all words of the text if those of some key phrase are among them, else null.
    """
    keys = sorted({key for _, _, needed in TEMPLATES for key in needed} | set(PHRASES))
    split = docs.select("doc_id", text_words(F.col("text")).alias("words"))
    split = split.select("doc_id", "words", F.array_intersect("words", _literal(_vocabulary())).alias("held"))
    some = F.exists(_literal([k.split() for k in keys]), lambda k: F.size(F.array_except(k, F.col("held"))) == 0)
    split = split.select("doc_id", F.size("words").cast("long").alias("n_words"), "held", F.when(some, F.col("words")).alias("words"))
    line = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    placed = split.select("*", line.alias("line")).select(
        "doc_id", "n_words", "held", "words",
        *[F.when(F.col("line").contains(f" {p} "), phrase_starts(F.col("words"), p)).alias(f"at_{n}") for n, p in enumerate(PHRASES)],
    )
    starts = [F.col(f"at_{n}") for n in range(len(PHRASES))]
    none = F.array().cast("array<int>")
    labels = F.array(*[F.when(at.isNotNull(), F.lit(label)) for at, label in zip(starts, PHRASES.values(), strict=True)])
    return placed.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "n_words",
        "held",
        F.concat(*[F.coalesce(at, none) for at in starts]).alias("starts"),
        F.array_distinct(F.array_compact(labels)).alias("base"),
        "words",
    )


def word_weights(found: DataFrame) -> dict[str, float]:
    """Inverse document frequency, over all texts, of every word of the notices.

    The map tasks sum before the exchange; the driver gets one number for each word of the fixed notices.
    """
    held = found.select(F.explode("held").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("files"))
    files = {r.word: r.files for r in held.collect()}
    total = found.count()
    return {w: math.log((total + 1) / (files.get(w, 0) + 1)) + 0.01 for w in _vocabulary()}


class Notice(NamedTuple):
    """A notice in the index: label, number of words, key phrases, its rarest words with their places and weights."""

    label: str
    length: int
    needed: tuple[str, ...]
    words: list[str]
    places: list[int]
    weights: list[float]


def license_index(weights: dict[str, float]) -> list[Notice]:
    """The notices with their rarest words, as many as have ``INDEXED_SHARE`` of the weight."""
    index = []
    for label, notice, needed in TEMPLATES:
        parts = notice.split()
        by_rarity = sorted(range(len(parts)), key=lambda i: (-weights[parts[i]], i))
        missing, taken = INDEXED_SHARE * sum(weights[w] for w in parts), []
        while missing > 0 and by_rarity:
            taken.append(by_rarity.pop(0))
            missing -= weights[parts[taken[-1]]]
        index.append(Notice(label, len(parts), needed, [parts[i] for i in taken], taken, [weights[parts[i]] for i in taken]))
    return index


def postings(spark: SparkSession, index: list[Notice]) -> DataFrame:
    """Where words stand in notices: ``word, notice, begin, bit``; ``bit`` is the number of the place in its notice."""
    rows = [
        {"word": word, "notice": n, "begin": place, "bit": bit}
        for n, notice in enumerate(index)
        for bit, (word, place) in enumerate(zip(notice.words, notice.places, strict=True))
    ]
    return _table(spark, rows, "word string, notice int, begin int, bit int")


def notices(spark: SparkSession, index: list[Notice]) -> DataFrame:
    rows = [
        {"notice": n, "label": i.label, "length": i.length, "needed": [k.split() for k in i.needed], "weights": i.weights}
        for n, i in enumerate(index)
    ]
    return _table(spark, rows, "notice int, label string, length int, needed array<array<string>>, weights array<double>")


def _table(spark: SparkSession, rows: list[dict], columns: str) -> DataFrame:
    fields = ", ".join(f"{name}: {kind}" for name, kind in (c.strip().split(" ", 1) for c in columns.split(", ")))
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{fields}>>")))


def find_notices(found: DataFrame, index: list[Notice]) -> DataFrame:
    """Notices in the texts of ``licensed_words``: ``row, label, share``, the best share of each label.

    Words are looked up in the postings, which are broadcast: their size is that of the fixed notices.  What tells
    of one beginning of one notice is added up as a set of bits before it is shuffled, so that a word repeated any
    number of times in a text counts once.
    """
    spark = found.sparkSession
    read = found.where(F.col("words").isNotNull())
    hits = read.select("row", F.posexplode("words").alias("place", "word")).join(F.broadcast(postings(spark, index)), "word")
    step = F.floor((F.col("place") - F.col("begin")) / SLACK).cast("int")
    votes = hits.select("row", "notice", F.explode(F.array(step, step - 1)).alias("step"), F.expr("shiftleft(1L, bit)").alias("mask"))
    agreed = votes.groupBy("row", "notice", "step").agg(F.bit_or("mask").alias("mask"))
    in_place = F.filter("weights", lambda w, bit: F.getbit(F.col("mask"), bit) == 1)
    share = F.aggregate(in_place, F.lit(0.0), lambda a, w: a + w) / F.aggregate("weights", F.lit(0.0), lambda a, w: a + w)
    likely = agreed.join(F.broadcast(notices(spark, index)), "notice").withColumn("share", share).where(F.col("share") >= LEAST_SHARE)
    begin = F.greatest(F.lit(0), F.col("step") * SLACK)
    stretch = F.slice("words", begin + 1, F.col("length") + 3 * SLACK)
    line = F.concat(F.lit(" "), F.array_join(stretch, " "), F.lit(" "))
    stands = F.forall("needed", lambda k: F.col("line").contains(F.concat(F.lit(" "), F.array_join(k, " "), F.lit(" "))))
    verified = likely.join(read.select("row", "words"), "row").withColumn("line", line).where(stands)
    return verified.groupBy("row", "label").agg(F.max("share").alias("share"))


def scan_licenses(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """License phrases and notices of every text.

    Returns ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``: the words, the places of
    ``PHRASES``, the smallest and largest of these places, labels of the phrases, labels of phrases and notices, and
    the largest share of a notice found (1 where a phrase stands).  A notice needs its key phrases and
    ``LEAST_SHARE`` of its weight.  Null and empty texts have no words, null places and score 0; repeated rows give
    repeated rows; an empty table gives none.  Texts are split into words once; what the words of licenses tell is
    stored, with all words of texts that may have a key phrase, and all else is worked out from there.
    """
    rows = keep(docs, doc_id=id_column, text=F.coalesce(F.col(f"`{text_column}`"), F.lit("")))
    found = cut_lineage(licensed_words(rows), "license-words")
    labelled = find_notices(found, license_index(word_weights(found)))
    listed = labelled.groupBy("row").agg(F.collect_set("label").alias("listed"), F.max("share").alias("share"))
    none = F.array().cast("array<string>")
    return found.join(listed, "row", "left").select(
        "doc_id",
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("listed", none))), ",").alias("labels"),
        F.when(F.size("starts") > 0, 1.0).otherwise(F.least(F.lit(1.0), F.coalesce("share", F.lit(0.0)))).alias("score"),
    )
