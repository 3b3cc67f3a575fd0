"""Corpus pipeline: language ID, line dedup, near dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps,
with the columns of ``documents``; the last one returns packed pieces. ``run``
writes each stage's result to the shared checkpoint folder and reads it again,
so a stage starts from files whatever executors were lost before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.llm.common import fresh, table
from clickweave.llm.language_id import fit_dictionaries, identify_language
from clickweave.llm.line_dedup import dedup_lines
from clickweave.llm.mixing import mix_sources
from clickweave.llm.packing import pack_documents
from clickweave.llm.queries import MIX_SEED, MIX_WEIGHTS, mix_levels, tokenizer_path
from clickweave.llm.simhash_pivots import drop_near_duplicates
from clickweave.session import remove_path, scratch, work_path


def _aside(docs: DataFrame, added: tuple[str, ...], operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``operator`` on ``docs``, of which it returns the columns: those that are
    named like its own ``added`` ones go under another name meanwhile."""
    names = {c: fresh(docs, f"{c}_") for c in docs.columns if c.lower() in added}
    out = operator(docs.withColumnsRenamed(names))
    return out.select(*(F.col(f"`{names.get(c, c)}`").alias(c) for c in docs.columns))


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; those that are null, empty, without
    letters or with a narrow margin (ties: none) go. Rows that repeat an id or a
    text are judged each; columns keep their names and values; an empty table
    gives an empty table."""
    dictionaries = fit_dictionaries(docs.select("doc_id", "text", "lang"))
    added = ("lang_pred", "score", "margin", "accepted")
    return _aside(docs, added, lambda d: identify_language(d, dictionaries).filter("accepted"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that ten or more documents have; rows that
    repeat an id or a text are documents of their own. A null text becomes empty,
    and ``n_chars`` counts what is left; other columns keep their values."""
    def dedup(d: DataFrame) -> DataFrame:
        return dedup_lines(d, min_docs=10, min_chars=1).withColumn("n_chars", F.char_length("text").cast("long"))

    return _aside(docs, ("n_lines", "n_dropped"), dedup)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (fingerprints within two bits):
    that of the smallest doc_id, of rows that repeat it the one that sorts first.
    Texts without words, null ones too, form one group."""
    return drop_near_duplicates(docs, shingle=3, max_bits=2)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target proportions, with as many words as before; a
    document of a source in demand is taken twice at most. Null languages and
    sources are branches of their own; equal places are ordered by doc_id and
    text."""
    added = ("epoch", "n_tokens", "leaf_budget")
    return _aside(docs, added, lambda d: mix_sources(d, mix_levels(), MIX_WEIGHTS, max_epochs=2, seed=MIX_SEED))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 2048; a null or empty text is its
    end token, repeated rows are packed each, and no other column is read."""
    return pack_documents(docs.select("doc_id", "text"), tokenizer_path(), max_tokens=2048, end_id=1)


STAGES = [
    ("language_id", keep_identified),
    ("line_dedup", drop_repeated_lines),
    ("simhash_dedup", keep_one_of_each_group),
    ("mixing", mix),
    ("packing", pack),
]

#: Compression and tokenizing have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result. What a stage wrote on its way goes once its own
    result is written, and that once the next stage's is."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = work_path(spark, name, unique=True)
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            remove_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
