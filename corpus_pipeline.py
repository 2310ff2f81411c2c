"""A training corpus from raw documents: quality, rules, near duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of docs.

Defined cases, in all stages: null and empty texts score the share of good labels in the first, and fail the base rule in
the second; very long texts are treated whole; repeated rows are judged alike, and one of them stays in the third; of rows
that tie there, that with the least doc_id, then the least hash of its text; rows with a null doc_id are judged as others,
give way to rows of their group that have one, and are packed under null. An empty table gives an empty one. Columns of
other names pass through as they are, whatever the names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstrata.llm import ngram_jaccard, packing, pii, quality_classifier, quality_rules
from quillstrata.llm.queries import pii_key
from quillstrata.sources.shared import discard, stored
from quillstrata.sources.tables import table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier takes for good."""
    labels = quality_classifier.learnable(table(spark, sf_dir, "labels"))
    return quality_classifier.keep_good(docs, quality_classifier.fit(docs, labels))


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and stray from no language."""
    return quality_rules.keep_judged(docs, quality_rules.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8 or more: the one of least doc_id."""
    return ngram_jaccard.keep_one(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Surrogates in place of personal data; n_chars follows the new text."""
    out = pii.replace(docs, pii_key(spark), None)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in windows of 4096 ids. Workers have had other stages before: they give the words' memory back after each task."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), keep=False)


STAGES = [
    ("quality classifier", keep_quality),
    ("quality rules", keep_by_rules),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("PII surrogates", replace_personal_data),
    ("packing", pack_windows),
]

#: SQL can't express the compression classifier, nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
        discard(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
