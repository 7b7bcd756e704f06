"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .contamination import find_contamination
from .fingerprints import compare_edits
from .language import identify_languages
from .licenses import scan_licenses
from .neardup import near_duplicate_classes
from .packing import pack_documents
from .prefixtrie import prefix_trie
from .secrets import scan_secrets, secret_digest
from .sharding import shard_documents
from .simhash import simhash_components
from .substrings import remove_repeats
from .text import prepare
from .toxicity import find_toxic
from .whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def vocabulary_path() -> str:
    """The public vocabulary file that the packing query and the pipeline use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = lambda spark, sf_dir: function(prepare(spark), sf_dir)
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op8_license_scan")
def _licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_read(spark, sf_dir, "documents"))


@_query("op10_virtual_slot_shards")
def _shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_read(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "map_version",
    )


@_query("op3_pack_windows")
def _packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(_read(spark, sf_dir, "documents"), vocabulary_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@_query("op4_merkle_fingerprints")
def _fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edits(_read(spark, sf_dir, "documents"))


@_query("op5_novel_secrets")
def _secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(scan_secrets(_read(spark, sf_dir, "documents")))


@_query("op6_ppm_language")
def _languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(_read(spark, sf_dir, "documents"))


@_query("op9_lexicon_toxicity")
def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_toxic(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


@_query("op7_seeded_alignment")
def _contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


@_query("op1_probminhash_classes")
def _near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(_read(spark, sf_dir, "documents")).select("doc_id", "class_id")


@_query("op2_linear_grouping_dedup")
def _substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0), lambda total, s: total + s["stop"] - s["start"])
    return remove_repeats(_read(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        removed.cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@_query("op11_anchor_simhash")
def _simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(_read(spark, sf_dir, "documents"))


@_query("op12_cholesky_whitening")
def _whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_read(spark, sf_dir, "embeddings"))


# CRC-32 bit by bit: 3988292384 is its reversed polynomial.
TRIE_SQL = r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
numbers AS (
  SELECT conv_id, conv_id - conv_id % 20 AS first, xor(4294967295, list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), CAST(range(8) AS BIGINT[])),
        lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 4 AS taken
  FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT n.conv_id, t.place, t.role, t.text
  FROM numbers n JOIN turns t ON t.conv_id = n.first AND t.place <= n.taken
  UNION ALL
  SELECT n.conv_id, t.place, t.role, t.text
  FROM numbers n JOIN turns t ON t.conv_id = n.conv_id AND t.place > n.taken),
placed AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth FROM rebuilt),
lists AS (
  SELECT conv_id, depth, text,
         list(sha256(length(role) || ':' || role || text)) OVER (PARTITION BY conv_id ORDER BY depth) AS way
  FROM placed),
prefixes AS (
  SELECT conv_id, CAST(depth AS BIGINT) AS depth, text, way, array_to_string(way[:depth - 1], '') AS above,
         array_to_string(way, '') AS node
  FROM lists
  UNION ALL
  SELECT conv_id, 0, '', [], NULL, '' FROM numbers),
lengths AS (SELECT conv_id, max(depth) AS turns FROM prefixes GROUP BY conv_id),
nodes AS (
  SELECT node, max(above) AS above, max(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * max(CASE WHEN depth = 0 THEN 0
           ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END) AS own,
         sha256(coalesce(string_agg(CASE WHEN depth = turns THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM prefixes JOIN lengths USING (conv_id) GROUP BY node),
children AS (SELECT above AS node, count(*) AS n_children FROM nodes WHERE above IS NOT NULL GROUP BY above),
below AS (
  SELECT p.node, sum(n.own) AS saved_tokens, count(*) FILTER (WHERE c.node IS NULL) AS n_leaves
  FROM nodes n JOIN prefixes q ON q.node = n.node AND q.conv_id = n.conv_id
  JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= q.depth
  LEFT JOIN children c ON c.node = n.node
  GROUP BY p.node)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, b.n_leaves,
       CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.node = n.node LEFT JOIN children c ON c.node = n.node LEFT JOIN nodes u ON u.node = n.above
"""


@_query("op13_radix_prefix_trie", TRIE_SQL)
def _trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(_read(spark, sf_dir, "conversations"))
