"""A training corpus from the documents table, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before
kept, written as Parquet and read again:

1. language ID: the classifier is trained on the labelled rows of its input;
   documents without a letter go, and those whose likeliest language scores
   under ``language.MIN_SCORE``.  If no row is labelled, only the first go.
2. SimHash near-dedup: one document of each group of near copies stays.
3. suffix-array dedup: byte strings that an earlier document holds are cut
   out of later ones; documents that this empties go.
4. benchmark decontamination: documents with a benchmark window go.
5. packing: the rest as pieces of token sequences, with their ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cartwise.llm import decontaminate, language, packing, repeats, simhash
from cartwise.llm.common import ship_package, stage, table

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
#: Words that a packing task remembers; the executors still hold what the stages before left.
TASK_WORDS = 100_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    model = language.train_on_documents(docs)
    if not model.languages:
        return docs.where(language.with_letter(F.col("text")))
    return docs.where(language.predictor(docs, model)(F.col("text"))["score"] >= language.MIN_SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return simhash.one_per_group(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return repeats.without_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pack_documents(docs, WORD_TOKENIZER, END_ID, task_words=TASK_WORDS)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("packing", pack),
]

#: A trained classifier, XXH64 and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs, _ = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
