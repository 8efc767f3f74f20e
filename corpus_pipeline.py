"""A training corpus in five stages: quality, exact copies, near copies, benchmark leaks, pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it to the shared
folder and hands what was written to the next.  All but the last keep the columns of
``documents``.  Rows keep their defined results from the operators: null and empty texts are
scored by structure, deduplicated as one group, clean of leaks and encoded to no pieces; columns
beside doc_id, text and n_chars are carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from matrixlens.llm import decontaminate, exact_dedup, near_dedup, quality, sentencepieces
from matrixlens.llm.queries import PIECE_MODEL
from matrixlens.llm.tables import discard, hand_on, in_fold, scratch, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier gives 0.3 or more.

    It is fitted as the query of its own, on labelled rows outside the held-out fold.
    """
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), in_fold("doc_id", 5, 0))
    return quality.accepted(docs, model)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for blanks."""
    return exact_dedup.deduplicate(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints over three-word shingles are linked within three bits."""
    return near_dedup.one_per_group(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and decoded text of every document."""
    return sentencepieces.encode_documents(docs, str(PIECE_MODEL))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_dedup_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("SentencePiece encoding and decoding", pieces_stage),
]

#: No SQL can express the classifier, the fingerprints and the pieces.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over ``documents``.

    The tables that a stage wrote on its way go when its result is written, and that result when
    the next one is.
    """
    docs, last = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        with scratch(spark) as folders:
            docs = written(stage(spark, docs, sf_dir))
            before, last = last, hand_on(folders)
        if before:
            discard(spark, before)
    return docs
