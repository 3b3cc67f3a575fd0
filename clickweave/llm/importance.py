"""Target-distribution importance resampling with a distributed radix sort.

Words are hashed to feature buckets; a bucket's gain is the scaled log ratio of
its smoothed share in the target texts to its share in the documents. Workers
score documents with arrays (bucket numbers of a batch, gains looked up, sums
per document), a seeded Gumbel number is added, and the highest scores are
drawn. The order comes from :func:`radix_ranks`, an LSD radix sort whose
counting passes are Spark jobs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickweave.llm.common import drop_path, fresh, per_worker
from clickweave.session import work_path

#: Distinct features that a worker remembers the bucket of before it starts anew.
CACHE_FEATURES = 500_000
#: Digits of the radix sort, and places of a block (the unit that is counted and ranked in one task).
DIGIT_BITS, BLOCK_BITS = 11, 12

#: Every byte that is no word byte becomes a blank; A-Z become a-z. Bytes of other characters are word bytes.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


class Buckets(dict):
    """Bucket of a feature's bytes: its crc32 modulo ``buckets``."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= CACHE_FEATURES:
            self.clear()
        out = self[feature] = zlib.crc32(feature) % self.buckets
        return out

    def of(self, text: str | None, max_run: int) -> tuple[int, list[int]]:
        """Number of words, and the buckets of all runs of 1 to ``max_run`` words."""
        words = (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()
        found = list(map(self.__getitem__, words))
        for n in range(2, max_run + 1):
            found += [self[b" ".join(words[i : i + n])] for i in range(len(words) - n + 1)]
        return len(words), found


def feature_counts(texts: DataFrame, buckets: int = 10_000, max_run: int = 1) -> DataFrame:
    """``bucket``, ``n``: how many features of all ``text`` fall into each
    bucket. A task adds up its own texts in an array and sends at most
    ``buckets`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = per_worker(("feature_buckets", buckets), lambda: Buckets(buckets))
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                found = known.of(text.as_py(), max_run)[1]
                total += np.bincount(np.array(found, np.int64), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    parts = texts.select(F.col("text").cast("string")).mapInArrow(run, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = 10_000, max_run: int = 1) -> np.ndarray:
    """Gain of each bucket: ``floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets))))``
    with s of S document features and t of T target features in it. Bounded by
    ``buckets`` numbers, whatever the tables."""
    both = feature_counts(docs, buckets, max_run).select("bucket", "n", F.lit(0).alias("side"))
    both = both.unionByName(feature_counts(target, buckets, max_run).select("bucket", "n", F.lit(1).alias("side")))
    counts = np.zeros((2, buckets))
    for r in both.collect():
        counts[r["side"], r["bucket"]] = r["n"]
    (s, t), (all_s, all_t) = counts, counts.sum(axis=1)
    return np.floor(1000 * np.log((t + 1) * (all_s + buckets) / ((s + 1) * (all_t + buckets)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, max_run: int = 1) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and ``weight`` (the floored mean
    gain of a document's features; 0 without any) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)  # one number a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.value
        known = per_worker(("feature_buckets", len(gain)), lambda: Buckets(len(gain)))
        for batch in batches:
            n_words, n, total = np.zeros((3, batch.num_rows), np.int64)
            for i, value in enumerate(batch.column(1)):
                n_words[i], found = known.of(value.as_py(), max_run)
                n[i] = len(found)
                total[i] = gain[np.array(found, np.int64)].sum()
            arrays = [batch.column(0), pa.array(n_words), pa.array(n), pa.array(total // np.maximum(n, 1))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_features", "weight"])

    read = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return read.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def radix_ranks(rows: DataFrame, keys: list[Column], rank: str = "rank") -> DataFrame:
    """``rows`` with the column ``rank``: 1, 2, 3... in the ascending order of
    ``keys`` (long columns without nulls, the first counts most).

    LSD radix sort. A key less its minimum is cut into digits of 11 bits, as
    many as its range needs. A pass is a stable counting sort: rows are counted
    by digit and block (4,096 places in a row), the counts' prefix sums over
    (digit, block) tell where each of these groups begins, and a row's new
    place is that beginning plus its rank among the group's rows. So only rows
    of one block and digit are ever sorted together, however often a key
    repeats, and only the 2,048 digit totals meet in one task. Each pass is a
    table in the shared folder: a lost executor costs one pass at most.

    Rows equal in all keys get neighbouring ranks in an arbitrary order. An
    empty table gives an empty table.
    """
    spark = rows.sparkSession
    place, digit, block, start, within = (fresh(rows, c) for c in ("place", "digit", "block", "start", "within"))
    names = [fresh(rows, f"key{i}") for i in range(len(keys))]
    path = work_path(spark, "radix", unique=True)
    # the first places need only be distinct, with few of them to a block
    first = rows.select("*", *(k.cast("long").alias(c) for k, c in zip(keys, names)), F.monotonically_increasing_id().alias(place))
    first.write.parquet(path)
    state = spark.read.parquet(path)
    ends = state.agg(*(f(c).alias(f"{f.__name__}_{c}") for c in names for f in (F.min, F.max))).first()
    passes = []
    for name in reversed(names):
        low, high = ends[f"min_{name}"] or 0, ends[f"max_{name}"] or 0
        # a range of 63 bits and more would overflow: the sign bit is turned instead
        wide = high - low >= 2**63
        key = F.col(name).bitwiseXOR(F.lit(-(2**63))) if wide else F.col(name) - F.lit(low)
        passes += [(key, shift) for shift in range(0, 64 if wide else (high - low).bit_length(), DIGIT_BITS)]
    # equal rows need one pass too: it makes the places dense
    for key, shift in passes or [(F.col(names[-1]) - F.col(names[-1]), 0)]:
        now = state.withColumns(
            {block: F.shiftright(place, BLOCK_BITS), digit: F.shiftrightunsigned(key, shift).bitwiseAND(F.lit(2**DIGIT_BITS - 1))}
        )
        counts = now.groupBy(digit, block).agg(F.count(F.lit(1)).alias("n"))
        smaller = W.orderBy(digit).rowsBetween(W.unboundedPreceding, -1)  # 2,048 rows at most
        digits = counts.groupBy(digit).agg(F.sum("n").alias("n"))
        digits = digits.select(digit, F.coalesce(F.sum("n").over(smaller), F.lit(0)).alias("of_digit"))
        earlier = W.partitionBy(digit).orderBy(block).rowsBetween(W.unboundedPreceding, -1)
        starts = counts.withColumn("of_block", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(digits, digit)
        starts = starts.select(digit, block, (F.col("of_digit") + F.col("of_block")).alias(start))
        ranked = now.withColumn(within, F.row_number().over(W.partitionBy(digit, block).orderBy(place)) - 1)
        moved = ranked.join(starts, [digit, block]).withColumn(place, F.col(start) + F.col(within))
        old, path = path, work_path(spark, "radix", unique=True)
        moved.select(*rows.columns, *names, place).write.parquet(path)
        drop_path(spark, old)
        state = spark.read.parquet(path)
    return state.select(*rows.columns, (F.col(place) + 1).alias(rank))


def gumbel(doc_id: Column, seed: int) -> Column:
    """``floor(-1000 ln(-ln((h + 0.5) / 2^32)))``, h being the first 32 bits of
    sha256(``seed:doc_id``). A null id counts as the empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296
    return F.floor(-1000 * F.log(-F.log(share))).cast("long")


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    min_words: int = 20,
    seed: int = 2024,
    buckets: int = 10_000,
    max_run: int = 1,
) -> DataFrame:
    """Draw ``percent`` of the documents of ``min_words`` words and more, so
    that the drawn ones resemble the texts of ``target``.

    Returns, for every row of ``docs`` (``doc_id``, ``text``): doc_id,
    n_features, weight, score (weight and a seeded Gumbel number), rank
    (1, 2, 3... by falling score, ties to the smaller doc_id; null if not
    drawn). Words are runs of ASCII letters (A-Z as a-z), digits and any
    characters beyond ASCII; features are runs of 1 to ``max_run`` words.

    Null and empty texts have no features and weight 0. A null doc_id stays
    null and ranks behind equal scores. Rows that repeat an id count and rank
    each. Texts are read whole, whatever their length. Without target texts,
    or without documents, the gains come from the smoothing alone. An empty
    table gives an empty table. Other columns are not read, whatever they are
    called.
    """
    weighed = weigh(docs, gains(docs, target, buckets, max_run), max_run)
    weighed = weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    path = work_path(docs.sparkSession, "weighed", unique=True)
    weighed.write.parquet(path)
    scored = docs.sparkSession.read.parquet(path)
    columns = ["doc_id", "n_features", "weight", "score"]
    enough = scored.filter(F.col("n_words") >= min_words).select(columns)
    order = [-F.col("score"), F.col("doc_id").isNull().cast("long"), F.coalesce("doc_id", F.lit(0))]
    ranked = radix_ranks(enough, order)
    drawn = percent * ranked.count() // 100
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    others = scored.filter(F.col("n_words") < min_words).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(others)
