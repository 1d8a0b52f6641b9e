"""Corpus pipeline: quality rules, line dedup, near dedup, secret redaction, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs.  All but the last return the columns of ``documents``.  The result
is one row per packed sequence.

Defined results, for every stage: columns beside those of ``documents`` are ignored, whatever their names; an empty
table gives an empty table; texts are read whole, however long.  Null or empty texts, null ids, ties and repeated
rows are told at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspark.llm import line_dedup, packing, quality_rules, secret_scan, simhash
from kinspark.llm.common import documents, stage

COLUMNS = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}


def _rows(docs: DataFrame) -> DataFrame:
    """The columns of ``documents`` only, whatever else the input has."""
    return docs.select(*[F.col(c).cast(kind).alias(c) for c, kind in COLUMNS.items()])


def _measured(docs: DataFrame) -> DataFrame:
    """n_chars follows the text that a stage has changed."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.  A null or empty text has no words, so it goes; repeated rows are judged alike."""
    return quality_rules.kept_documents(_rows(docs))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that at least five of them share, which stay in the largest doc_id only.

    No row leaves.  A null text becomes an empty one; a row without a doc_id keeps its lines and counts for none; rows
    that repeat a doc_id are one document for the counts.
    """
    out = line_dedup.dedup_lines(_rows(docs), carry=("lang", "source"))
    return _measured(out.select("doc_id", F.col("kept").alias("text"), "source_row.*"))


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (of least doc_id) of each group of near copies.

    Null, empty and white texts have fingerprint zero and are one group, so one of them stays; a repeated row leaves one; in a
    group without any doc_id, each fingerprint leaves one row.
    """
    return simhash.one_per_component(_rows(docs))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret replaced by a mark.  No row leaves, repeated ones neither; a null text stays null."""
    return _measured(secret_scan.redact(_rows(docs)))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed sequences: sequence_id, tokens, n_tokens, doc_ids.

    A null or empty text is the end mark alone; a repeated row is packed as often as it stands there.
    """
    return packing.sequences(packing.tokenised_documents(_rows(docs)))


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_copy_stage),
    ("secret_scans", secret_stage),
    ("packing", packing_stage),
]

#: Fingerprints and token ids are beyond SQL; tests/llm compare every stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{name}")
    return docs
