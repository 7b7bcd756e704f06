"""License scan against a plain Python statement of its rules."""

import re

from releasecat.llm.licenses import PHRASES, TEMPLATES, LEAST_SHARE, scan_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def base(text):
    words = WORD.findall(lower(text))
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        places += at
        labels |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def check(rows, found):
    assert len(found) == len(rows)
    texts = dict(rows)
    for r in found:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(rows, scan_licenses(docs).collect())


def test_hand_made(spark):
    rows = [
        (1, "x MIT\n license, mit-LICENSE mitlicense Mit Licenses"),
        (2, None),
        (3, ""),
        (4, "École CC BY 4.0; Licensed under the Apache License, Version 2.0."),
        (5, "gnu general public gnu general public license"),
        (6, "This work is licensed under the GNU General Public License, version 3."),
        (7, "version 3 " + "gap " * 50 + "GNU General Public License"),
        (8, "license mit " * 2000),
        (9, "éMIT license K"),
    ]
    docs = spark.createDataFrame([(*r, "key", "w") for r in rows], "doc_id long, text string, key string, words string")
    found = {r.doc_id: r for r in scan_licenses(docs).collect()}
    check(rows, found.values())
    assert found[6].labels == "gpl,gpl-3.0"
    assert found[4].labels == "apache,apache-2.0,cc-by,cc-by-4.0" and found[4].score == 1
    assert "gpl-3.0" not in found[7].labels
    assert found[2].n_words == 0 and found[2].labels == ""


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "MIT License"), (1, "MIT License"), (None, "MIT License")], "doc_id long, text string")
    assert [(r.n_base, r.labels) for r in scan_licenses(docs).collect()] == [(1, "mit")] * 3
    assert scan_licenses(docs).count() == 3
    assert scan_licenses(docs.limit(0)).count() == 0


def test_every_notice_names_its_own_label(spark):
    docs = spark.createDataFrame([(n, notice) for n, (_, notice, _) in enumerate(TEMPLATES)], "doc_id long, text string")
    for r in scan_licenses(docs).collect():
        assert TEMPLATES[r.doc_id][0] in r.labels.split(",")
    assert 0 < LEAST_SHARE <= 1


# Notices as files have them.
HEADERS = (
    ("gpl-3.0", "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version."),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("agpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("lgpl-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)


def test_standard_headers_also_with_words_put_in(spark):
    keys = {"gpl-3.0": "general public license|version 3", "gpl-2.0": "general public license|version 2", "lgpl-2.1": "lesser general public license|version 2 1"}
    filler = "some prose of the kind that stands before and after " * 20
    rows, expected = [], []
    for label, notice in HEADERS:
        words = notice.split()
        needed = [k.split() for t in TEMPLATES if t[0] == label for k in t[2]] + [k.split() for k in keys.get(label, "").split("|") if k]
        for at in [None, *range(len(words) + 1)]:
            before, after = (WORD.findall(lower(" ".join(w))) for w in (words[: at or 0], words[at or 0 :]))
            # Words inside a key phrase break it.
            if at and any(before[-i:] + after[: len(k) - i] == k for k in needed for i in range(1, len(k))):
                continue
            text = notice if at is None else " ".join([*words[:at], "one two three", *words[at:]])
            rows.append((len(rows), filler + text + "\n" + filler))
            expected.append(label)
    docs = spark.createDataFrame(rows + [(-1, filler), (-2, "a license of the public, version 3")], "doc_id long, text string")
    found = {r.doc_id: r for r in scan_licenses(docs).collect()}
    check(docs.collect(), found.values())
    for n, label in enumerate(expected):
        others = {t[0] for t in TEMPLATES} - {label, "mit"}
        named = set(found[n].labels.split(","))
        assert label in named and not named & others and found[n].score >= LEAST_SHARE, (rows[n][1], found[n].labels)
    assert found[-1].labels == found[-2].labels == "" and found[-1].score == found[-2].score == 0


def test_a_text_full_of_license_words(spark):
    rows = [(1, "license " * 20000 + "version " * 20000), (2, "mit license " * 5000)]
    found = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    check(rows, found.values())
    assert found[1].labels == "" and found[2].labels == "mit"
