import inspect
import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from clickweave.llm import gru_lm as G
from clickweave.llm.common import hashed_fold

from .helpers import AWKWARD, awkward, empty, words


def brute_base(rows):
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 10 == 0 for r in rows]
    counts = Counter()
    for r, h in zip(rows, held):
        if not h:
            counts.update(words(r[1]))
            counts["end"] += 1
    n, v = sum(counts.values()), len(counts)
    out = []
    for r, h in zip(rows, held):
        tokens = [*words(r[1]), "end"]
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        out.append((str(r[0]), h, len(tokens), sum(counts[t] > 0 for t in tokens), n, round(base, 6)))
    return sorted(out)


def test_counts_and_base_scores(spark):
    docs = awkward(spark).selectExpr("*", "'x' as score", "1 as word", "2 as row")
    for frequent in (1 << 18, 4, 0):  # all words in the dictionary, few, none
        rows = G.score_documents(docs, hashed_fold(F.col("doc_id"), 10) == 0, frequent_words=frequent, warm_docs=5, warm_passes=1).collect()
        got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)
        assert got == brute_base(AWKWARD)
        assert all(r.score < 0 and math.isfinite(r.score) for r in rows)
    out = lambda d, c: G.score_documents(d, c, warm_docs=5, warm_passes=1)
    assert out(empty(spark), hashed_fold(F.col("doc_id"), 10) == 0).count() == 0
    assert {(r.base_score, r.score, r.train_tokens) for r in out(docs, F.lit(True)).collect()} == {(0.0, 0.0, 0)}


def test_model_beats_the_unigrams_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = G.score_documents(docs, hashed_fold(F.col("doc_id"), 10) == 0).filter("held_out")
    base, score = got.agg(F.sum("base_score"), F.sum("score")).first()
    assert score > base


def small(monkeypatch):
    for name, value in (("CLASSES", 3), ("PER_CLASS", 4), ("HIDDEN", 5), ("EMBEDDED", 4), ("VOCABULARY", 12)):
        monkeypatch.setattr(G, name, value)


def test_probabilities_sum_to_one(monkeypatch):
    small(monkeypatch)
    p = G.first_params(np.full(12, 1 / 12))
    states = np.random.default_rng(0).standard_normal((7, 5)).astype(np.float32)
    total = sum(np.exp(G.log_probs(p, states, np.full(7, w))[0]) for w in range(12))
    assert np.allclose(total, 1, atol=1e-5)


def test_gradients(monkeypatch):
    small(monkeypatch)
    rng = np.random.default_rng(1)
    p = {k: v.astype(np.float64) + 0.1 * rng.standard_normal(v.shape) for k, v in G.first_params(np.full(12, 1 / 12)).items()}
    reads, follows = rng.integers(0, 12, (6, 3)), rng.integers(0, 12, (6, 3))
    start = np.zeros((6, 3), bool)
    start[0] = True
    start[3, 1] = True
    weight = np.ones(18)

    def loss():
        after, kept = G.forward(p, reads, start, np.zeros((3, 5)))
        logs, _ = G.log_probs(p, after.reshape(-1, 5).astype(np.float64), follows.ravel())
        return -float(logs.sum()), after, kept

    grads = {k: np.zeros_like(v) for k, v in p.items()}
    _, after, kept = loss()
    _, d = G.log_probs(p, after.reshape(-1, 5).astype(np.float64), follows.ravel(), grads, weight)
    G.backward(p, grads, reads, start, kept, d.reshape(after.shape))
    for k, v in p.items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in v.shape)
            old, step = v[at], 1e-2
            v[at] = old + step
            up = loss()[0]
            v[at] = old - step
            down = loss()[0]
            v[at] = old
            assert abs((up - down) / (2 * step) - grads[k][at]) < 2e-2 * max(1, abs(grads[k][at])), k


def test_state_is_carried_across_windows(monkeypatch):
    """A text's score does not depend on the window length, the lanes or its neighbours."""
    small(monkeypatch)
    rng = np.random.default_rng(2)
    p = G.first_params(np.full(12, 1 / 12))
    texts = [rng.integers(0, 12, n).astype(np.int32) for n in (1, 40, 7, 13, 2, 40)]
    alone = [G.score_texts(p, [t], 0, 1, 100)[0] for t in texts]
    for width, steps in ((1, 3), (2, 8), (6, 5), (100, 64)):
        assert np.allclose(G.score_texts(p, texts, 0, width, steps), alone, atol=1e-3)


def test_training_lowers_the_loss(monkeypatch):
    small(monkeypatch)
    p = G.first_params(np.full(12, 1 / 12))
    texts = [np.array([1, 2, 3, 4] * 10 + [0], np.int32) for _ in range(20)]
    before, adam = G.score_texts(p, texts, 0, 4, 8).sum(), G.Adam(p, 0.02)
    for _ in range(15):
        G.train_texts(p, adam, texts, 0, 4, 8)
    assert G.score_texts(p, texts, 0, 4, 8).sum() > 0.4 * before


def test_units_and_vocabulary_are_parameters(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    defaults = {k: v.default for k, v in inspect.signature(G.score_documents).parameters.items()}
    assert defaults["units"] >= 12 and defaults["vocabulary"] >= 2048

    def gain(**sizes):
        got = G.score_documents(docs, hashed_fold(F.col("doc_id"), 10) == 0, **sizes).filter("held_out")
        return got.agg(F.sum(F.col("score") - F.col("base_score"))).first()[0]

    gains = [gain(units=1, vocabulary=65), gain(vocabulary=500), gain()]  # 500: classes of unlike size are filled up
    assert all(map(math.isfinite, gains)) and gains == sorted(set(gains))


def test_memory_follows_the_tokens_not_the_longest_text():
    import tracemalloc

    texts = [np.zeros(1_000_000, np.int32)] + [np.ones(200, np.int32)] * 511
    tracemalloc.start()
    seen = sum(int((text >= 0).sum()) for _, _, _, text, _ in G.windows(texts, 512, 64, 0))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == 1_000_000 + 511 * 200 and peak < 100e6


def test_windows_read_each_text_in_order():
    texts = [np.array([k * 10 + i + 1 for i in range(n)], np.int32) for k, n in enumerate((7, 1, 3, 3, 12, 2))]
    for width in (1, 2, 4, 10):
        read, follow = {}, {}
        for reads, follows, starts, text, n in G.windows(texts, width, 5, 99):
            assert reads.shape[1] == n
            for at, k in np.ndenumerate(text):
                if k >= 0:
                    assert starts[at] == (k not in follow)
                    read.setdefault(k, []).append(int(reads[at]))
                    follow.setdefault(k, []).append(int(follows[at]))
        assert {k: v for k, v in follow.items()} == {k: t.tolist() for k, t in enumerate(texts)}
        assert {k: v for k, v in read.items()} == {k: [99, *t.tolist()[:-1]] for k, t in enumerate(texts)}


def test_texts_are_read_into_ids_once(spark, monkeypatch):
    """Training and scoring read ids, not texts."""
    plans, plain = {}, G.materialize

    def kept(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return plain(df, name)

    monkeypatch.setattr(G, "materialize", kept)
    docs = awkward(spark)
    assert G.score_documents(docs, hashed_fold(F.col("doc_id"), 10) == 0, warm_docs=5, warm_passes=1).count() == docs.count()
    assert "text#" in plans["encoded_texts"]
    assert all("text#" not in plans[name] and "ids#" in plans[name] for name in ("model_copies", "scored_texts"))
