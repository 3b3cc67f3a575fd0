"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.llm.common import hashed_fold, table
from clickweave.llm.ego_join import embedding_components
from clickweave.llm.gru_lm import score_documents
from clickweave.llm.importance import importance_resample
from clickweave.llm.language_id import fit_dictionaries, identify_language
from clickweave.llm.licenses import scan_licenses
from clickweave.llm.line_dedup import dedup_lines
from clickweave.llm.mixing import mix_sources
from clickweave.llm.packing import pack_documents
from clickweave.llm.pii import find_pii
from clickweave.llm.simhash_blocks import compare_with_edits
from clickweave.llm.simhash_pivots import simhash_components
from clickweave.llm.token_align import align_tokens
from clickweave.llm.toxicity import fit_toxicity, score_toxicity

#: The production mixture. The documents have no domain, so the number in their source's name deals them to four.
MIX_DOMAINS = 4
MIX_WEIGHTS: dict[tuple, int] = {
    ("d0",): 4, ("d1",): 3, ("d2",): 2, ("d3",): 3,
    ("d0", "en"): 5, ("d0", "de"): 2, ("d0", "fr"): 2, ("d0", "es"): 1,
    ("d1", "en"): 4, ("d2", "en"): 3, ("d3", "en"): 6,
    ("d0", "en", "src0"): 2, ("d1", "en", "src1"): 3,
}
MIX_SEED = 17


def mix_levels() -> dict[str, Column]:
    number = F.regexp_extract(F.coalesce("source", F.lit("")), "([0-9]+)$", 1)
    domain = F.when(number != "", F.concat(F.lit("d"), F.substring(number, -6, 6).cast("long") % MIX_DOMAINS))
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    mixed = mix_sources(docs, mix_levels(), MIX_WEIGHTS, max_epochs=4, seed=MIX_SEED)
    return mixed.select("doc_id", "epoch", "lang", "source", "n_tokens", "leaf_budget")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), max_tokens=2048, end_id=1)


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_documents(docs, hashed_fold(F.col("doc_id"), 10) == 0)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edits(table(spark, sf_dir, "documents").select("doc_id", "text"), radius=3)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = hashed_fold(F.col("doc_id"), 5) == 0
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~held_out)
    scored = score_toxicity(docs, fit_toxicity(docs, labels))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = hashed_fold(F.col("doc_id"), 4) == 2
    dictionaries = fit_dictionaries(docs.filter(~held_out))
    judged = identify_language(docs.select("doc_id", "text"), dictionaries)
    return judged.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin", "accepted")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = dedup_lines(docs, min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"), threshold=0.8)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return align_tokens(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return importance_resample(docs, table(spark, sf_dir, "benchmark").select("text"), percent=10, min_words=20, seed=2024)


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_packing": op2_packing,
    "op3_simhash_dedup": op3_simhash_dedup,
    "op4_lm_scores": op4_lm_scores,
    "op5_fingerprints": op5_fingerprints,
    "op6_toxicity": op6_toxicity,
    "op7_language_id": op7_language_id,
    "op8_line_dedup": op8_line_dedup,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_pii": op10_pii,
    "op11_licenses": op11_licenses,
    "op12_token_alignment": op12_token_alignment,
    "op13_importance": op13_importance,
}
