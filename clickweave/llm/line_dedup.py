"""Line dedup with DataFrame functions only.

Texts are split into lines, each line is normalised and hashed, the documents
of every hash are counted, and lines whose hash is found in many documents are
dropped; the others are put together again by position.

Only hashes and positions are shuffled for the counting. The repeated hashes
are a written table, so Spark knows its size: it broadcasts them if few, and
splits the rows of a very common line otherwise. The text moves once,
to meet the positions to drop, and not at all when those are few enough for
Spark to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import ASCII_SPACE, ascii_lower, fresh
from clickweave.session import materialize


def line_key(line: Column) -> Column:
    """The line stripped of ASCII white space at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(ASCII_SPACE)))


def repeated_lines(docs: DataFrame, text: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``line_hash`` (MD5 of the key) of keys of at least ``min_chars`` code
    points that at least ``min_docs`` rows of ``docs`` have. A row counts once
    for a key, however often its text repeats the line."""
    keys = F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1), line_key)
    long_enough = F.filter(keys, lambda k: F.char_length(k) >= min_chars)
    return (
        docs.select(F.explode(F.array_distinct(F.transform(long_enough, F.md5))).alias("line_hash"))
        .groupBy("line_hash")
        .agg(F.count(F.lit(1)).alias("n_docs"))
        .filter(F.col("n_docs") >= min_docs)
        .select("line_hash")
    )


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_docs: int = 10, min_chars: int = 1
) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, plus ``n_lines``
    (before) and ``n_dropped``.

    Every row is one document: repeated rows and rows without an id count
    each. A null or empty text is one empty line (it stays, as its key is
    shorter than ``min_chars``, and comes back as the empty text). A text that
    loses all its lines becomes empty; no row is dropped. Other columns stay;
    columns named ``n_lines`` or ``n_dropped`` are replaced. An empty table
    gives an empty table.
    """
    columns = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    own, digest, lines, drop, keep = (fresh(docs, c) for c in ("_own", "_digest", "_lines", "_drop", "_keep"))
    # What a row loses depends on its text alone, so rows that share id and text may share their positions.
    keyed = docs.select(
        *columns,
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias(own),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias(digest),
    )
    found = (
        keyed.select(own, digest, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)).alias("pos", "line"))
        .select(own, digest, "pos", line_key(F.col("line")).alias("key"))
        .filter(F.char_length("key") >= min_chars)
        .select(own, digest, "pos", F.md5("key").alias("line_hash"))
        .join(materialize(repeated_lines(docs, text, min_docs, min_chars), "repeated_lines"), "line_hash")
        .groupBy(own, digest)
        .agg(F.collect_set("pos").alias(drop))  # each position once, however many rows share the text
    )
    split = keyed.join(found, [own, digest], "left").withColumn(
        lines, F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    )
    every = F.sequence(F.lit(0), F.size(lines) - 1)
    kept = split.withColumn(keep, F.when(F.col(drop).isNull(), every).otherwise(F.array_except(every, F.col(drop))))
    joined = F.array_join(F.transform(F.col(keep), lambda i: F.col(lines)[i]), "\n")
    new_text = F.when(F.col(drop).isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(joined)
    return kept.select(
        *[new_text.alias(c) if c == text else F.col(c) for c in columns],
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(keep)).cast("long").alias("n_dropped"),
    )
