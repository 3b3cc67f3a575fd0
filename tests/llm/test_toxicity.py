from pyspark.sql import functions as F

from clickweave.llm.common import hashed_fold
from clickweave.llm.toxicity import fit_toxicity, score_toxicity

from .helpers import awkward, empty

SF = "/root/testdata/sf0.1"


def test_held_out_ranking(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    held_out = hashed_fold(F.col("doc_id"), 5) == 0
    model = fit_toxicity(docs, labels.filter(~held_out), toxic_docs=300, ordinary_docs=600)
    rows = score_toxicity(docs.filter(held_out).join(labels, "doc_id"), model).collect()
    bad, good = ([r.score for r in rows if r.toxic == k] for k in (1, 0))
    assert len(bad) > 20 and len(good) > 200
    assert sum(x > y for x in bad for y in good) / (len(bad) * len(good)) > 0.85  # small table: few documents teach the rarer toxic words
    assert sum(y >= 0.5 for y in good) / len(good) < 0.05
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1), (2, 1), (6, 0), (7, 0), (None, 1), (8, None), (3, 0)], "doc_id long, toxic int")
    model = fit_toxicity(awkward(spark), labels, min_docs=2, min_evidence=0.0)
    docs = awkward(spark).selectExpr("*", "'x' as score", "'y' as read")
    rows = score_toxicity(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r["read"] == "y" for r in rows)
    same = {r.score for r in rows if not (r.text or "").strip()}
    assert len(same) == 1  # null, empty and blank texts
    none = fit_toxicity(awkward(spark), labels.filter("toxic = 0"))
    assert {r.score for r in score_toxicity(docs, none).collect()} == {0.0}
    assert score_toxicity(empty(spark), model).count() == 0
    assert fit_toxicity(empty(spark), labels).weights is None


def test_every_language_group_is_found(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    held_out = hashed_fold(F.col("doc_id"), 5) == 0
    model = fit_toxicity(docs, labels.filter(~held_out))
    rows = score_toxicity(docs.filter(held_out).join(labels, "doc_id"), model).collect()
    figures = {}
    for english in (True, False):
        bad, good = ([r.score for r in rows if (r.lang == "en") == english and r.toxic == k] for k in (1, 0))
        auc = sum((x > y) + (x == y) / 2 for x in bad for y in good) / (len(bad) * len(good))
        recall, marked = (sum(x >= 0.5 for x in part) / len(part) for part in (bad, good))
        figures["en" if english else "other"] = (round(auc, 3), round(recall, 3), round(marked, 3))
    print(model.window_words, model.thresholds, figures)
    for auc, recall, marked in figures.values():
        assert auc > 0.88 and recall > 0.5 and marked < 0.05, figures


def test_one_id_on_a_third_of_the_rows_stays_one_text(spark, monkeypatch):
    from clickweave.llm import toxicity

    rows = [(5, f"insult{i % 7} same words")  for i in range(6000)] + [(i, f"plain words here {i % 50}") for i in range(10, 12_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(5, 1), (6, 1)] + [(i, i % 2) for i in range(10, 5000)], "doc_id long, toxic int")
    seen = []
    kept = toxicity.materialize
    monkeypatch.setattr(toxicity, "materialize", lambda df, name: seen.append(kept(df, name)) or seen[-1])
    fit_toxicity(docs, labels.filter("doc_id = 5 or toxic = 0"), toxic_docs=2, ordinary_docs=3)
    assert seen[0].count() == 4


def test_scores_equal_a_plain_computation(spark):
    """Dictionaries, savings, calibration and scores of a tiny table, each computed again in plain Python."""
    import math

    import numpy as np
    import zstandard as z

    from clickweave.llm import toxicity as T

    common = "the of and to in house garden street winter summer".split()
    rude = "scumbag moronic filthy idiotic".split()
    rows, marks = [], []
    for i in range(60):
        toxic = i % 3 == 0
        words = [common[(i * 7 + 3 * k) % len(common)] for k in range(20)]
        if toxic:
            for k in range(5):
                words.insert(2 + 3 * k, rude[(i + k) % 4])
        rows.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    model = fit_toxicity(docs, labels, min_docs=5, min_evidence=5.0, common_bytes=300, toxic_bytes=200)

    held = {k: [t.split() for (_, t), (_, m) in zip(rows, marks) if m == k] for k in (0, 1)}
    uses = {w: [sum(w in d for d in held[k]) for k in (0, 1)] for w in common + rude}
    listed = sorted((w for w in uses if uses[w][0]), key=lambda w: (-uses[w][0], w))
    shared = b"".join(b" " + w.encode() for w in reversed(listed)) + b" "
    worst = sorted((w for w in rude if not uses[w][0]), key=lambda w: (-uses[w][1], w))
    assert model.ordinary == shared
    assert model.toxic == b"".join(b" " + w.encode() for w in reversed(worst)) + shared

    settings = z.ZstdCompressionParameters(window_log=17, hash_log=14, chain_log=14, search_log=3, min_match=4, target_length=8,
                                           strategy=z.STRATEGY_LAZY, write_content_size=0, write_checksum=0, write_dict_id=0)
    size = lambda words, text: len(z.ZstdCompressor(
        dict_data=z.ZstdCompressionDict(words, dict_type=z.DICT_TYPE_RAWCONTENT), compression_params=settings).compress(text))

    def features(text):
        words = text.split()
        windows = [f" {' '.join(words[i : i + model.window_words])} ".encode() for i in range(0, len(words), model.window_words)]
        saved = [size(model.ordinary, w) - size(model.toxic, w) for w in windows]
        reached = [sum(s >= t for s in saved) for t in model.thresholds]
        return [sum(saved) / len(saved), max(0, *saved), *(r / len(saved) for r in reached), *(min(r, 4) for r in reached), 1.0]

    x, y = np.array([features(t) for _, t in rows]), np.array([m for _, m in marks])
    p = 1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30)))
    ridge = 1e-3 * np.append(model.weights[:-1], 1e-3 * model.weights[-1])
    assert np.abs(x.T @ (p - y) / len(y) + ridge).max() < 1e-4  # the loss is at its minimum
    for r in score_toxicity(docs, model).collect():
        assert math.isclose(r.score, p[r.doc_id], abs_tol=1e-9) and r.predicted == (r.score >= 0.5)
    assert T.window_features(np.array([], int), (2, 4)) == [0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0]
