"""Secret scan by patterns and by novelty: what a string adds to a dictionary-primed compression."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import keep

# The patterns of the base kinds and the least lengths of what they find.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A run of hex digits is matched whole, so the least length can stand in the pattern.
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "novel")

# Names common in code and settings, with which every dictionary begins.
IDENTIFIERS = (
    "password passwd secret token api_key apikey access_key client_secret private_key authorization bearer "
    "credential username config settings environment variable version default example localhost function return "
    "import export const public private static string boolean integer null none true false https http www com org"
)
_SENSITIVE = re.compile(r"pass(?:word|wd|phrase)|secret|token|api_?key|access_?key|private_?key|credential|bearer|authorization", re.ASCII | re.IGNORECASE)
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")


class Span(NamedTuple):
    start: int
    end: int
    kind: str


class Novelty(NamedTuple):
    """When a string in sensitive context is reported: text around it that primes the dictionary, how far after a
    sensitive word, or after the begin of one of the next ``lines`` that are not blank, it may begin, the least
    marginal bytes and the least marginal bytes for each byte, and what tells a key from words: at which share of
    neighbours the kind of character changes, or how many digits there are besides letters."""

    around: int = 1024
    reach: int = 48
    lines: int = 1
    least_changes: float = 0.36
    least_digits: int = 3
    least_bytes: int = 14
    least_share: float = 0.6


def base_spans(text: str) -> list[Span]:
    """Spans of the base kinds in order of start, then kind."""
    found = []
    if "=" in text or ":" in text:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= LEAST_ASSIGN:
                found.append(Span(m.start(), m.end(), "assign"))
    if "AKIA" in text:
        found += [Span(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [Span(*m.span(), "hex") for m in HEX.finditer(text)]
    return ordered(found)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def marginal_bytes(candidate: str, around: str) -> int:
    """Bytes that a string adds to the compression of the text around it and of common identifiers."""
    primed = zstandard.ZstdCompressionDict(
        (IDENTIFIERS + "\n" + around).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )
    packer = zstandard.ZstdCompressor(level=9, dict_data=primed, write_content_size=False, write_checksum=False)
    return len(packer.compress(candidate.encode())) - len(packer.compress(b""))


def like_a_key(value: str, rule: Novelty) -> bool:
    """Words of a language are as new to a small dictionary as keys are, but keep to one kind of character for longer.

    In random base64 two neighbours of three are of different kinds (small, large, digit, sign), in names made of
    words, in any style, fewer than one of three.  Strings of small letters and digits mix less: for these, digits
    count.
    """
    digits = sum(c.isdigit() for c in value)
    if rule.least_digits <= digits < len(value):
        return True
    kinds = [0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 for c in value.rstrip("=")]
    return sum(a != b for a, b in zip(kinds, kinds[1:])) >= rule.least_changes * (len(kinds) - 1) and len(set(kinds) - {3}) > 1


def places_after(text: str, start: int, rule: Novelty) -> Iterator[tuple[int, int, int]]:
    """Where a value of the word that ends at ``start`` may begin: begin, end, and end of the line, line by line."""
    left = rule.lines
    while True:
        stop = text.find("\n", start)
        stop = len(text) if stop < 0 else stop
        yield start, start + rule.reach, stop
        start = stop + 1
        while start < len(text) and text[start] in " \t\r\n":
            start += 1
        if not left or start >= len(text):
            return
        left -= 1


def novel_spans(text: str, known: list[Span], rule: Novelty = Novelty()) -> list[Span]:
    """Strings after a sensitive word that are new against what stands around them and overlap no known span."""
    found: dict[int, Span] = {}
    seen: set[int] = set()
    for word in _SENSITIVE.finditer(text):
        for begin, last, stop in places_after(text, word.end(), rule):
            for m in _CANDIDATE.finditer(text, begin, stop):
                start, end = m.span()
                if start > last:
                    break
                value = m.group()
                if start in seen or not like_a_key(value, rule) or any(s.start < end and start < s.end for s in known):
                    continue
                seen.add(start)
                around = text[max(0, start - rule.around) : start] + "\n" + text[end : end + rule.around]
                added = marginal_bytes(value, around)
                if added >= rule.least_bytes and added >= rule.least_share * len(value):
                    found[start] = Span(start, end, "novel")
    return list(found.values())


def find_secrets(text: str | None, rule: Novelty = Novelty()) -> list[Span]:
    """All spans of a text in order; none for a null text."""
    if not text:
        return []
    known = base_spans(text)
    return ordered(known + novel_spans(text, known, rule))


def written(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def redact(text: str, spans: list[Span], mark: str = "[secret]") -> str:
    """The text with every span, overlapping ones as one, replaced by a mark."""
    out, place = [], 0
    for s in ordered(spans):
        if s.start >= place:
            out += [text[place : s.start], mark]
        place = max(place, s.end)
    return "".join([*out, text[place:]])


def scan_secrets(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rule: Novelty = Novelty()
) -> DataFrame:
    """Secrets of every text: ``doc_id`` and ``spans``, an array of ``start, end, kind`` in code points.

    Texts are judged apart from each other.  Null and empty texts have no spans; repeated rows stay; an empty table
    gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[s._asdict() for s in find_secrets(t, rule)] for t in batch.column("text").to_pylist()]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    rows = keep(docs, doc_id=id_column, text=text_column)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, spans array<struct<start:long,end:long,kind:string>>")


def secret_digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, digest of their spans, and all spans as text."""

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return found.select(
        "doc_id",
        *[count(kind) for kind in KINDS[:3]],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        count(KINDS[3]),
    )


def redact_secrets(docs: DataFrame, text_column: str = "text", rule: Novelty = Novelty()) -> DataFrame:
    """The same rows and columns with every secret in the text replaced by a mark; null texts stay null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.names.index(text_column)
            texts = [t and redact(t, find_secrets(t, rule)) for t in batch.column(place).to_pylist()]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    return docs.mapInArrow(run, docs.schema)

