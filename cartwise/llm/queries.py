"""Registered queries of the operators and of the pipeline, with their SQL."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import decontaminate as D, imatch, language, packing, repeats as R, simhash as S, token_counts as C, token_store as T, url_filter as U, warc as W
from .common import stage_path, table
from .exact_topk import top_products
from .lexical_search import rank_documents
from .oracle import OP5_SQL, OP6_SQL, OP8_SQL, OP10_SQL, OP11_SQL, OP12_SQL
from .periodic_runs import periodic_runs

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
STORE_END_ID, PACK_END_ID = 2, 1
LIMIT_TOKENS = 512
#: (verdict, host, path), as the contract gives them.
RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    predict = language.predictor(docs, language.train_on_documents(docs))
    return docs.select("doc_id", language.held_out().alias("held_out"), predict(F.col("text")).alias("p")).select("doc_id", "held_out", "p.lang_pred", "p.score")


def op2_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "token-store")
    T.write_tokens(table(spark, sf_dir, "documents"), path, WORD_TOKENIZER, STORE_END_ID)
    return T.with_crc32(T.read_tokens(spark, path))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = C.prefix_counts(table(spark, sf_dir, "documents"), BYTE_TOKENIZER)
    n_tokens = C.total(F.col("prefix_tokens"))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return counted.select("doc_id", n_bytes.alias("n_bytes"), n_tokens.alias("n_tokens")).withColumn("over_limit", F.col("n_tokens") > LIMIT_TOKENS)


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.near_duplicates(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_warc_revisit(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "warc")
    W.write_archives(table(spark, sf_dir, "pages"), path)
    return W.read_archives(spark, path)


def op7_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.filter_urls(table(spark, sf_dir, "pages"), U.rule_table(spark, RULES))


def op9_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), WORD_TOKENIZER, PACK_END_ID, with_ids=False)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(table(spark, sf_dir, "embeddings"))


def planted_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with a periodic end, in the tenth of documents that the contract names."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), edit=planted_period)
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    top = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("top"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = F.col("top.length"), -F.col("top.period")
    return top.select("doc_id", "n_runs", (-F.col("top.start")).alias("start"), length.alias("length"), period.alias("period"),
                      F.floor(1000 * length / period).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


REGISTRY = {f.__name__: f for f in (
    op1_language_id, op2_token_orc, op3_token_counts, op4_simhash_dedup, op5_decontaminate,
    op6_warc_revisit, op7_imatch, op8_url_filter, op9_vector_packing, op10_suffix_dedup,
    op11_lexical_search, op12_exact_topk, op13_periodic_runs, pipeline,
)}

#: The others have no SQL: their models, hashes or tokenizers are beyond it.
ORACLE_SQL = {
    "op5_decontaminate": OP5_SQL, "op6_warc_revisit": OP6_SQL, "op8_url_filter": OP8_SQL, "op10_suffix_dedup": OP10_SQL,
    "op11_lexical_search": OP11_SQL, "op12_exact_topk": OP12_SQL,
}
