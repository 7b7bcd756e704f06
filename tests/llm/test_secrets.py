"""Secret scan against the patterns as the contract words them."""

import hashlib
import random
import re

from releasecat.llm.secrets import find_secrets, marginal_bytes, redact, redact_secrets, scan_secrets, secret_digest

PATTERNS = (
    ("assign", re.compile("((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), 2, 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile("[0-9a-f]+"), 0, 24),
)


def base(text):
    found = []
    for rank, (kind, pattern, group, least) in enumerate(PATTERNS):
        found += [(m.start(), rank, kind, m.end()) for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def check(rows, found):
    texts = dict(rows)
    assert len(found) == len(rows)
    for r in found:
        spans = base(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for k, _, _ in spans) for x in ("assign", "access", "hex")]
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check([(r.doc_id, r.text) for r in docs.collect()], secret_digest(scan_secrets(docs)).collect())


KEY = "sess-Qx8r2LmZ0pYv7KtW3nBd"


def test_hand_made(spark):
    random.seed(2)
    pieces = ["token", "TOKEN", "apikey", "API_key", "=", ":", " ", "'", '"', "AKIA", "ABC123XYZ0", "0f9a", "deadbeef", "é", "\n", "secret", "ſecret=abcdefgh"]
    rows = [(n, "".join(random.choice(pieces) for _ in range(40))) for n in range(400)]
    rows += [(900, None), (901, ""), (902, "x" * 200_000 + "0" * 24), (903, f"bearer {KEY} rest")]
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id int, text string, spans string")
    found = secret_digest(scan_secrets(docs)).collect()
    check(rows, found)
    assert {r.doc_id: r.spans for r in found}[903] == f"novel:7:{7 + len(KEY)}"
    changed = {r.doc_id: (r.text, r.spans) for r in redact_secrets(docs).collect()}
    assert changed[900] == (None, "s") and changed[903] == ("bearer [secret] rest", "s")
    assert scan_secrets(docs.limit(0)).count() == redact_secrets(docs.limit(0)).count() == 0
    assert scan_secrets(docs.where("doc_id = 903").union(docs.where("doc_id = 903"))).count() == 2


def test_novelty():
    assert marginal_bytes(KEY, "nothing like it") > marginal_bytes(KEY, f"set {KEY} before") + 8
    assert find_secrets(f"{KEY} is shown; token {KEY} again") == []
    assert find_secrets("the token of ordinaryuncommonwords stands here") == []
    text = f"a token='{'f' * 40}' b"
    assert redact(text, find_secrets(text)) == "a [secret]' b"


BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def test_random_keys_are_found_and_names_are_not():
    pick = random.Random(7)
    for size in (16, 20, 24, 32, 40):
        keys = ["".join(pick.choice(BASE64) for _ in range(size)) for _ in range(400)]
        for form in ("Authorization: Bearer {}", "credential for the box is {} and more", "private_key:\n  {}\n", "access_key |\n\n\t{}"):
            hits = sum(any(s.kind == "novel" and form.format(k)[s.start : s.end] == k for s in find_secrets(form.format(k))) for k in keys)
            assert hits >= 0.95 * len(keys), (size, form, hits)
    names = (
        "getUserAccountSettingsFactory org/example/service/internal/handlers client_secret_rotation_interval_seconds "
        "AUTHORIZATION_HEADER_NAME_DEFAULT authenticationmiddleware token-refresh-interval-minutes XMLHttpRequestBuilder "
        "Donaudampfschifffahrtsgesellschaft 1234567890123456 ---------------------- /usr/local/share/certificates"
    ).split()
    for name in names:
        for form in ("the token {} is", "secret:\n{}\n", "bearer {}"):
            assert not [s for s in find_secrets(form.format(name)) if s.kind == "novel"], name
    # Two lines on, and far from the word, nothing is looked for.
    key = "sess-Qx8r2LmZ0pYv7KtW3nBd"
    assert find_secrets(f"token\nnothing here\n{key}") == find_secrets(f"token {'a ' * 40}{key}") == []
