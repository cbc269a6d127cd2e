"""Corpus preparation: the documents that pass, once each, mixed and encoded.

Stages, each over all rows that the one before kept:

1. quality: rejected documents go.
2. near duplicates: of documents that n-gram Jaccard links connect, the one with
   the smallest id stays (null ids last, equal ids by a hash of the text).
3. passages: fuzzy passages that repeat across documents stay in their first
   document and are cut from the others.
4. mixing: sources are brought to their target sizes by dropping and repeating
   documents.
5. encoding: every text as piece ids, checked by decoding them.

Each stage first lets the driver drop what earlier ones left there.
All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook.llm import jaccard_join, mixing, passages, pieces, quality
from daybook.llm.common import read, release, written

# Near-duplicate stages take five words and a similarity of 0.8.
SHINGLE_WORDS, SIMILARITY_PERCENT = 5, 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from all labelled documents and keeps those that it doesn't reject."""
    release(spark)
    return quality.accepted(docs, quality.fit_sample(docs, read(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component; documents without words have no near duplicates."""
    release(spark)
    return jaccard_join.representatives(docs, SHINGLE_WORDS, SIMILARITY_PERCENT)


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    return passages.without_repeats(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    return mixing.mixed(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_pieces, ids, exact): ids in the merge order that the vocabulary was made with."""
    release(spark)
    return pieces.encoded_rows(docs, pieces.Pieces.load(pieces.MODEL))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("passages", passage_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]

# A trained classifier decides the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read back."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
