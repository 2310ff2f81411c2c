"""Queries of the operators in this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from . import chat, language_id, media, ngram_jaccard, packing, pii, quality_classifier, quality_rules, sentencepiece_bpe, site_style
from ._batches import crc_of_id, texts_of


def op1_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(table(spark, sf_dir, "conversations"))


def op2_quality_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.fit(docs, quality_classifier.learnable(table(spark, sf_dir, "labels")))
    return quality_classifier.score(docs, model).select("doc_id", F.coalesce(crc_of_id() % 3 == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_language_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs)).select("doc_id", F.coalesce(crc_of_id() % 5 == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.near_duplicates(table(spark, sf_dir, "documents"), size=3, share=90)


def op7_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.fit(docs))


def op3_media_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.text_tiles(table(spark, sf_dir, "documents"), keep_tile=False)


#: The setting that holds the secret key of the surrogates; without it, a key that anyone can read here.
PII_SETTING, PII_KEY = "spark.quillstrata.pii.key", "quillstrata"


def pii_key(spark: SparkSession) -> str:
    return spark.conf.get(PII_SETTING, PII_KEY)


def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(texts_of(table(spark, sf_dir, "documents")), pii_key(spark)).select("doc_id", "text", F.size("_pii").cast("long").alias("n_entities"), F.array_join(F.array_sort(F.array_distinct("_pii")), ",").alias("kinds"))


def op8_packing_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_site_style_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_style.extract(table(spark, sf_dir, "pages"))


def op10_sentencepiece_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_repair": op1_chat_repair,
    "op2_quality_compression": op2_quality_compression,
    "op3_media_tiles": op3_media_tiles,
    "op4_language_cross_parsing": op4_language_cross_parsing,
    "op5_pii_surrogates": op5_pii_surrogates,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_quality_divergence": op7_quality_divergence,
    "op8_packing_differencing": op8_packing_differencing,
    "op9_site_style_text": op9_site_style_text,
    "op10_sentencepiece_rounds": op10_sentencepiece_rounds,
}
#: op6 by all pairs that share a shingle, and a walk over the links.
NEAR_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t-\r]+') AS w FROM documents),
 s AS (SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
 u AS (SELECT doc_id, unnest(s) AS g FROM s),
 p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM u a JOIN u b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
 l AS (SELECT p.a, p.b FROM p JOIN s x ON x.doc_id = p.a JOIN s y ON y.doc_id = p.b WHERE 100 * c >= 90 * (len(x.s) + len(y.s) - c)),
 r AS (SELECT doc_id AS v, doc_id AS root FROM documents UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.v),
 m AS (SELECT v, min(root) AS component_id FROM r GROUP BY v)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id FROM s JOIN m ON m.v = s.doc_id"""

ORACLES: dict[str, str] = {"op6_ngram_jaccard": NEAR_SQL}
