"""Language identification by compression.

Each language has a zstandard raw-content dictionary: the words (of scripts
without blanks: the pairs of characters) most of its sampled documents share, most common last, where the compressor reaches them
most cheaply. A text is cut into windows, each window is compressed with every
dictionary, and the language with the smallest total wins; a narrow margin
rejects the document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickweave.llm.common import fresh
from clickweave.session import materialize

#: Everything in ASCII but letters reads as a blank; other bytes stay.
LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
NO_LANGUAGE = "und"
#: Scripts written without blanks between words: Thai, Lao, Burmese, Khmer, kana and Han.
NO_BLANKS = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]+")


def letters_only(text: str) -> bytes:
    return b" " + b" ".join(text.lower().encode().translate(LETTERS).split()) + b" "


def pieces_of(text: str) -> set[str]:
    """What a dictionary can hold of a text: its words, and of stretches of a
    script without blanks every two characters that stand together."""
    out: set[str] = set()
    for word in letters_only(text).decode().split():
        if word.isascii() or not NO_BLANKS.search(word):
            out.add(word)
            continue
        out.update(filter(None, NO_BLANKS.split(word)))
        for run in NO_BLANKS.findall(word):
            out.update(run[i : i + 2] for i in range(max(1, len(run) - 1)))
    return out


def fit_dictionaries(
    labelled: DataFrame, docs_per_lang: int = 300, chars_per_doc: int = 8192, dict_bytes: int = 8192, min_docs: int = 2
) -> dict[str, bytes]:
    """Dictionaries of the languages of ``labelled`` (doc_id, text, lang).

    The sample is bounded: per language the ``docs_per_lang`` documents first
    by the hash of their doc_id, of each ``chars_per_doc`` code points from
    its middle. Rows without text or language teach nothing. The number of
    languages is that of distinct values of ``lang``.
    """
    draw = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    rank = W.partitionBy("lang").orderBy(draw, "doc_id", "text")
    half = F.greatest(F.lit(1), F.floor((F.char_length("text") - chars_per_doc) / 2)).cast("int")
    known = labelled.filter("text is not null and lang is not null")
    # Hashes below a language's share leave about twice as many documents as wanted, however many tasks read them.
    # A row a language, like the result; written, so Spark knows its size before it chooses the join.
    sizes = materialize(known.groupBy("lang").agg(F.count(F.lit(1)).alias("held")), "labelled")
    low = (draw / F.lit(float(1 << 63)) + 1) / 2 * F.col("held") <= 2 * docs_per_lang + 100
    sample = (
        known.join(sizes, "lang")
        .filter(low)
        .withColumn("rank", F.row_number().over(rank))
        .filter(F.col("rank") <= docs_per_lang)
        .select("lang", F.col("text").substr(half, F.lit(chars_per_doc)).alias("text"))
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, words = [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = pieces_of(text.as_py())
                langs += [lang] * len(found)
                words += found
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.string())], names=["lang", "word"])

    counts = sample.mapInArrow(count, "lang string, word string").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    best = W.partitionBy("lang").orderBy(F.desc("n"), "word")
    most = counts.filter(F.col("n") >= min_docs).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= dict_bytes)
    by_lang: dict[str, list[str]] = {r["lang"]: [] for r in sample.select("lang").distinct().collect()}
    for r in most.orderBy("lang", "rank").collect():  # at most dict_bytes words a language
        by_lang[r["lang"]].append(r["word"])
    out = {}
    for lang, words in by_lang.items():
        size, chosen = 1, []
        for w in words:
            if size + len(w.encode()) < dict_bytes:  # a long word that does not fit keeps no other out
                size += len(w.encode()) + 1
                chosen.append(w.encode())
        out[lang] = b" " + b"".join(w + b" " for w in reversed(chosen))
    return out


def compressors(dictionaries: dict[str, bytes]):
    import zstandard as z

    settings = z.ZstdCompressionParameters(
        window_log=17, hash_log=14, chain_log=14, search_log=2, min_match=4, target_length=8,
        strategy=z.STRATEGY_LAZY, write_content_size=0, write_checksum=0, write_dict_id=0,
    )
    made = []
    for lang in sorted(dictionaries):
        words = z.ZstdCompressionDict(dictionaries[lang] * (1 + 8 // len(dictionaries[lang])), dict_type=z.DICT_TYPE_RAWCONTENT)
        made.append((lang, z.ZstdCompressor(dict_data=words, compression_params=settings)))
    return made


def judge(text: str | None, made, window: int) -> tuple[str, float, float]:
    """Language, score and margin of one text."""
    if not made or not text or not any(map(str.isalpha, text)):
        return NO_LANGUAGE, 0.0, 0.0
    data = letters_only(text)
    sizes = [0] * len(made)
    for at in range(0, len(data), window):
        part = data[at : at + window]
        for i, (_, c) in enumerate(made):
            sizes[i] += len(c.compress(part))
    order = sorted(range(len(made)), key=lambda i: (sizes[i], made[i][0]))
    best = sizes[order[0]]
    margin = 1.0 if len(made) == 1 else (sizes[order[1]] - best) / sizes[order[1]]
    return made[order[0]][0], min(1.0, 0.5 + 4 * margin), margin


def identify_language(
    docs: DataFrame, dictionaries: dict[str, bytes], window: int = 1024, min_margin: float = 0.002, text: Column | None = None
) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1, growing with the margin),
    ``margin`` (by how much of the second-smallest size the smallest is below
    it) and ``accepted``.

    Texts that are null, empty or without any letter are ``und`` with score 0
    and not accepted; a margin under ``min_margin`` (ties: 0, the language
    that sorts first) is not accepted either. Whole texts are read, however
    long. Columns named like those added are replaced.
    """
    added = ("lang_pred", "score", "margin", "accepted")
    columns = [c for c in docs.columns if c.lower() not in added]
    read = fresh(docs, "read")
    rows = docs.select(*columns, (F.col("text") if text is None else text).cast("string").alias(read))
    schema = rows.drop(read).withColumns(
        {"lang_pred": F.lit(""), "score": F.lit(0.0), "margin": F.lit(0.0), "accepted": F.lit(True)}
    ).schema
    sent = docs.sparkSession.sparkContext.broadcast(dictionaries)  # dict_bytes a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = compressors(sent.value)
        for batch in batches:
            found = [judge(t.as_py(), made, window) for t in batch.column(len(columns))]
            lang, score, margin = zip(*found) if found else ((), (), ())
            ok = [name != NO_LANGUAGE and m >= min_margin for name, m in zip(lang, margin)]
            new = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(margin, pa.float64()), pa.array(ok, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], *new], names=[*columns, *added])

    return rows.mapInArrow(run, schema)
