"""The corpus pipeline: stages that each read what the one before has kept.

Every stage takes (spark, docs, sf_dir).  All but the last return the columns of ``documents``: documents that are
scored as toxic go, one document of each class of near duplicates stays, documents that hold a test item go, secrets
are replaced by a mark.  The last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from releasecat.llm.contamination import drop_contaminated
from releasecat.llm.neardup import keep_one_of_each
from releasecat.llm.packing import pack_documents
from releasecat.llm.queries import vocabulary_path
from releasecat.llm.secrets import redact_secrets
from releasecat.llm.text import prepare
from releasecat.llm.toxicity import reject_toxic
from releasecat.session import cut_lineage

# Model scores, estimated signatures, alignments and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored below 0.7.

    Each row is scored by its own text, so repeated rows and ties share a fate; null and empty texts are scored too.
    Labels of ids that ``docs`` lacks teach nothing.  An empty table stays empty, further columns stay as they are.
    """
    return reject_toxic(docs, _table(prepare(spark), sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates, that of the least id; of equal rows one.

    Texts of fewer than five words are near only to the same words, those without words only to
    equal texts; null counts as empty.  Rows without an id stay only where their class has no
    id at all, one of each text.  An empty table stays empty, further columns stay as they are.
    """
    prepare(spark)
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no test item.

    Each row is judged by its own text, whatever its id; null and empty texts stay.  An empty table of documents or of
    items drops nothing, further columns stay as they are.
    """
    return drop_contaminated(docs, _table(prepare(spark), sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with a mark in place of each secret and ``n_chars`` of the new text.

    Null texts stay null and have null ``n_chars``; repeated rows stay repeated.  An empty table stays empty, further
    columns stay as they are.
    """
    prepare(spark)
    return redact_secrets(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences instead of documents; further columns are left out.

    A null or empty text is a document of the end token alone; each repeated row is packed.  An empty table gives no
    pieces.
    """
    prepare(spark)
    return pack_documents(docs, vocabulary_path())


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; what a stage keeps is stored for the next one."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
