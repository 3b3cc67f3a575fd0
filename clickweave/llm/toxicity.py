"""Toxicity by compression distance.

Two zstandard dictionaries are built from labelled text, one ordinary and one
toxic. The ordinary one holds the words that ordinary documents share; the
toxic one holds the same words behind those that toxic documents share and
ordinary ones do not. A text is compressed window by window with both: a
window that the toxic dictionary makes shorter speaks the toxic vocabulary.
The windows' savings, calibrated on the labelled sample, give the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickweave.llm.common import fresh
from clickweave.llm.language_id import letters_only
from clickweave.session import materialize

#: Window lengths in words, and savings in bytes from which a window counts as toxic, to choose from.
WINDOW_WORDS = (4, 12)
WINDOW_THRESHOLDS = ((2, 4), (2, 3, 4, 5, 6, 7, 8))


@dataclass
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray | None = None
    window_words: int = WINDOW_WORDS[0]
    thresholds: tuple[int, ...] = WINDOW_THRESHOLDS[0]


def _compressor(words: bytes):
    import zstandard as z

    settings = z.ZstdCompressionParameters(
        window_log=17, hash_log=14, chain_log=14, search_log=3, min_match=4, target_length=8,
        strategy=z.STRATEGY_LAZY, write_content_size=0, write_checksum=0, write_dict_id=0,
    )
    words = words if len(words) >= 8 else words + b" " * 8
    return z.ZstdCompressor(dict_data=z.ZstdCompressionDict(words, dict_type=z.DICT_TYPE_RAWCONTENT), compression_params=settings)


def savings(text: str | None, ordinary, toxic, window_words: int) -> np.ndarray:
    """What the toxic dictionary saves on each window of a text, in bytes."""
    words = letters_only(text or "").split()
    saved = []
    for at in range(0, len(words), window_words):
        window = b" " + b" ".join(words[at : at + window_words]) + b" "
        saved.append(len(ordinary.compress(window)) - len(toxic.compress(window)))
    return np.array(saved, int)


def window_features(saved: np.ndarray, thresholds: tuple[int, ...]) -> list[float]:
    """What the windows of a text save: on average, at most, and how many of
    them reach each threshold; the last is 1."""
    n = max(len(saved), 1)
    reached = [int((saved >= t).sum()) for t in thresholds]
    most = max(0, int(saved.max(initial=0)))
    return [float(saved.sum()) / n, float(most), *(r / n for r in reached), *(float(min(r, 4)) for r in reached), 1.0]


def _calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Ridge logistic regression."""
    w = np.zeros(x.shape[1])
    share = np.full(len(y), 1 / len(y))
    penalty = ridge * np.diag([1.0] * (x.shape[1] - 1) + [1e-3])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (share * (p - y)) + penalty @ w
        hess = (x * (share * p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(hess + 1e-9 * np.eye(len(w)), grad)
        w -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
    return w


def _held_out_loss(x: np.ndarray, y: np.ndarray, folds: int = 5) -> float:
    """Mean log loss of rows under weights that the other folds gave."""
    fold, loss = np.arange(len(y)) % folds, 0.0
    for k in range(folds):
        z = np.clip(x[fold == k] @ _calibrate(x[fold != k], y[fold != k]), -30, 30)
        loss += float(np.log1p(np.exp(np.where(y[fold == k] == 1, -z, z))).sum())
    return loss / len(y)


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    toxic_docs: int = 2000,
    ordinary_docs: int = 3000,
    common_bytes: int = 8192,
    toxic_bytes: int = 4096,
    min_docs: int = 5,
    min_evidence: float = 25.0,
    window_words: tuple[int, ...] = WINDOW_WORDS,
    thresholds: tuple[tuple[int, ...], ...] = WINDOW_THRESHOLDS,
) -> ToxicityModel:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    The sample is bounded: of each label the documents first by the hash of
    their id, ``toxic_docs`` and ``ordinary_docs`` of them, whole; of rows that
    repeat an id the text that sorts first. Null labels and null ids teach nothing. A toxic word is one that at least ``min_docs``
    toxic documents have, behind different words (so copies of one passage
    count little), and ordinary documents hardly have: a log-likelihood ratio of
    at least ``min_evidence`` and a rate over eight times theirs. Of ``window_words`` and
    ``thresholds`` the pair is taken whose calibration has the smallest loss on
    parts of the sample it was not calibrated on (ties: the first). Without documents of
    both labels every score is 0.
    """
    limits = {1: toxic_docs, 0: ordinary_docs}
    labelled = labels.filter("doc_id is not null and toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int")).distinct()
    held = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    # hashes below a label's share leave about twice as many ids as wanted, whatever the table holds
    draw = F.xxhash64("doc_id")
    share = (draw / F.lit(float(1 << 63)) + 1) / 2
    low = [(F.col("toxic") == k) & (share * held.get(k, 0) <= 2 * limit + 100) for k, limit in limits.items()]
    rank = F.row_number().over(W.partitionBy("toxic").orderBy(draw, "doc_id"))
    limit = F.when(F.col("toxic") == 1, limits[1]).otherwise(limits[0])
    chosen = labelled.filter(low[0] | low[1]).withColumn("rank", rank).filter(F.col("rank") <= limit).select("doc_id", "toxic")
    # one text an id, however many rows repeat it
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    sample = materialize(sample.select("toxic", "text"), "toxicity_sample")

    def first_uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, word, before = [], [], []
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = letters_only(text.as_py() or "").split()
                uses: dict[bytes, bytes] = {}
                for previous, w in zip([b"", *words], words):
                    uses.setdefault(w, previous)
                toxic += [label] * len(uses)
                word += [w.decode() for w in uses]
                before += [w.decode() for w in uses.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(toxic, pa.int32()), pa.array(word, pa.string()), pa.array(before, pa.string())],
                names=["toxic", "word", "before"],
            )

    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_ordinary = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_ordinary:
        return ToxicityModel(b"", b"")
    is_toxic = F.col("toxic") == 1
    uses = sample.select(F.col("toxic").cast("int"), "text").mapInArrow(first_uses, "toxic int, word string, before string")
    counts = uses.groupBy("word").agg(
        F.count(F.when(is_toxic, 1)).alias("t"),
        F.count(F.when(~is_toxic, 1)).alias("o"),
        F.countDistinct(F.when(is_toxic, F.col("before"))).alias("contexts"),
    )
    common = counts.filter("o > 0").orderBy(F.desc("o"), "word").limit(common_bytes).select("word").collect()
    both = F.col("t") + F.col("o")
    expected = [both * n / (n_toxic + n_ordinary) for n in (n_toxic, n_ordinary)]
    evidence = 2 * sum(
        (F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / e)).otherwise(0.0) for c, e in zip("to", expected)), F.lit(0.0)
    )
    often = counts.filter(
        (F.col("t") >= min_docs)
        & (F.char_length("word") > 3)
        & (F.col("contexts") >= F.greatest(F.lit(min_docs), F.least(F.col("t"), F.lit(200)) * 0.3))
        & (F.col("t") / n_toxic > 8 * F.col("o") / n_ordinary)
        & (evidence >= min_evidence)
    )
    toxic = often.orderBy(F.desc("t"), "word").limit(toxic_bytes).select("word").collect()

    def content(rows: list, size: int) -> bytes:
        out = b""
        for r in rows:  # most common last
            if len(out) + len(r["word"].encode()) + 1 > size:
                break
            out = b" " + r["word"].encode() + out
        return out

    shared = content(common, common_bytes) + b" "
    model = ToxicityModel(shared, content(toxic, toxic_bytes) + shared)

    pairs = [(n, t) for n in window_words for t in thresholds]

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _compressor(model.ordinary), _compressor(model.toxic)
        for batch in batches:
            rows = []
            for text in batch.column(1):
                saved = {n: savings(text.as_py(), a, b, n) for n in window_words}
                rows.append([window_features(saved[n], t) for n, t in pairs])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.list_(pa.list_(pa.float64())))], names=["toxic", "x"]
            )

    seen = sample.select(F.col("toxic").cast("int"), "text").mapInArrow(features, "toxic int, x array<array<double>>").collect()
    seen.sort(key=lambda r: (r["toxic"], r["x"]))
    y = np.array([r["toxic"] for r in seen], float)
    of_pair = [np.array([r["x"][i] for r in seen]) for i in range(len(pairs))]
    best = min(range(len(pairs)), key=lambda i: (_held_out_loss(of_pair[i], y), i))
    model.window_words, model.thresholds = pairs[best]
    model.weights = _calibrate(of_pair[best], y)
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: likelier toxic) and
    ``predicted`` (1 from 0.5 on).

    Only ``text`` is read, whole, however long; null and empty texts get the
    score of a text that saves nothing. Columns named like those added are
    replaced. An empty table gives an empty table.
    """
    added = ("score", "predicted")
    columns = [c for c in docs.columns if c.lower() not in added]
    read = fresh(docs, "read")
    rows = docs.select(*columns, F.col("text").cast("string").alias(read))
    schema = rows.drop(read).withColumns({"score": F.lit(0.0), "predicted": F.lit(0)}).schema
    m = model  # goes to the workers with the function: its dictionaries are of bounded size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _compressor(m.ordinary), _compressor(m.toxic)
        for batch in batches:
            score = np.zeros(batch.num_rows)
            if m.weights is not None and batch.num_rows:
                x = np.array([window_features(savings(t.as_py(), a, b, m.window_words), m.thresholds) for t in batch.column(len(columns))])
                score = 1 / (1 + np.exp(-np.clip(x @ m.weights, -30, 30)))
            new = [pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], *new], names=[*columns, *added])

    return rows.mapInArrow(run, schema)
