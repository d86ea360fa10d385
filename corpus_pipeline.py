"""The corpus pipeline: from raw ``documents`` to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept.
Stages but the last return the columns of their input; ``run`` writes every
stage as Parquet into the shared folder and rereads it.

1. language: drops documents without a letter or without a likely language
   (posterior below ``LEAST_SCORE``) and fills in missing labels.
2. near_duplicates: word 5-grams, Jaccard similarity 0.8 or more; of each group
   one document stays.  Rows are told apart by id and text, so rows without an
   id are compared like all others, different texts under one id are different
   documents, and of rows equal in both one stays.
3. decontamination: drops documents with a twentieth or more of their words in
   verbatim benchmark passages.
4. secrets: replaces every secret in the texts; ``n_chars`` follows.
5. packing: assigns all that is left to sequences of several lengths, measured
   in tokens of a public vocabulary.

Stages whose texts pass Python workers bound what a worker gets at once, in
the session's settings.  Null texts have no language and go in stage 1.  An empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lading.llm.columns import fresh
from lading.llm.decontaminate import decontaminate
from lading.llm.graph import written
from lading.llm.language_id import UND, fit, identify
from lading.llm.narrow import may_match
from lading.llm.ngram_join import ngram_join
from lading.llm.packing import pack_by_tokens
from lading.llm.secret_scan import redact, scan
from lading.session import bound_batches

LEAST_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    pred, score = fresh(docs, "lang_pred"), fresh(docs, "lang_score")
    found = identify(docs, fit(docs, F.lit(True)), pred_col=pred, score_col=score)
    kept = found.where((F.col(pred) != UND) & (F.col(score) >= LEAST_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", pred)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    key, place, text_key, stays, alike, may = (fresh(docs, c) for c in ("row_key", "place", "text_key", "stays", "alike", "may"))
    # Nulls are told apart from what hashes alike.
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text"))
    fates = ngram_join(keyed, id_col=key).groupBy(key).agg(
        F.bool_or(F.col(key) == F.col("component_id")).alias(stays), F.count(F.lit(1)).alias(alike))
    # All other keys are of one row that stays.
    doubtful = written(fates.where(~F.col(stays) | (F.col(alike) > 1)).select(key, stays), "near-doubtful")
    marked = may_match(keyed, key, doubtful, may)
    same = Window.partitionBy(key, "doc_id", text_key).orderBy(F.lit(0))
    kept = (marked.where(may).join(doubtful.where(~F.col(stays)).select(key), key, "left_anti").withColumn(text_key, F.xxhash64(F.lit(2), "text"))
            .withColumn(place, F.row_number().over(same)).where(F.col(place) == 1))
    # Whole rows go through a shuffle only where that must be looked at.
    return marked.where(~F.col(may)).select(docs.columns).unionByName(kept.select(docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    spans = fresh(docs, "secret_spans")
    clean = scan(docs, spans_col=spans).withColumn("text", redact(F.col("text"), F.col(spans)))
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", F.when(F.size(spans) > 0, length).otherwise(F.col("n_chars"))).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return pack_by_tokens(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: SQL cannot express the language model and the packing; tests compare near
#: duplicates and token counts with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
