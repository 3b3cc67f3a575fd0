import hashlib
import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

from clickweave.llm.importance import importance_resample, radix_ranks

from .helpers import AWKWARD, LONG, awkward, empty

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def features(text, max_run):
    words = WORD.findall(ascii_lower(text))
    runs = [" ".join(words[i : i + n]) for n in range(1, max_run + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) for r in runs]


def brute_force(docs, target, percent=10, min_words=20, seed=2024, buckets=10_000, max_run=1):
    def histogram(texts):
        found = [0] * buckets
        for text in texts:
            for h in features(text, max_run)[1]:
                found[h % buckets] += 1
        return found

    s, t = histogram(text for _, text in docs), histogram(target)
    all_s, all_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((b + 1) * (all_s + buckets) / ((a + 1) * (all_t + buckets)))) for a, b in zip(s, t)]
    rows = []
    for doc_id, text in docs:
        n_words, found = features(text, max_run)
        weight = sum(gain[h % buckets] for h in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None, n_words])
    enough = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(enough[: percent * len(enough) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    texts = [r.text for r in target.collect()]
    got = found(importance_resample(docs, target))
    assert got == brute_force(rows, texts)
    assert sum(r[4] is not None for r in got) >= 10


@pytest.mark.parametrize("max_run", [1, 2])
def test_awkward_rows(spark, max_run):
    rows = [(r[0], r[1]) for r in AWKWARD] * 2
    docs = spark.createDataFrame(AWKWARD * 2, awkward(spark).schema)
    docs = docs.selectExpr("*", "1 as score", "'x' as `rank`", "2 as weight", "3 as n_words", "4 as place", "5 as digit")
    texts = ["the cat sat", None, "", "École 数据"]
    target = spark.createDataFrame([(t, 1) for t in texts], "text string, doc_id int")
    settings = dict(percent=70, min_words=2, buckets=50, max_run=max_run)
    assert found(importance_resample(docs, target, **settings)) == brute_force(rows, texts, **settings)
    nothing = target.limit(0)
    assert found(importance_resample(docs, nothing, **settings)) == brute_force(rows, [], **settings)
    assert importance_resample(empty(spark), target).count() == 0


def test_very_long_text_and_one_id_on_most_rows(spark):
    rows = [(7, "a b c")] * 60 + [(i, f"w{i} a") for i in range(100, 130)] + [(8, LONG * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([("a wort",)], "text string")
    assert found(importance_resample(docs, target, percent=60, min_words=1)) == brute_force(rows, ["a wort"], 60, 1)


def test_radix_ranks_order_any_longs(spark):
    top = 2**63 - 1
    values = [(a, b) for a in (-top - 1, -5, 0, 3, top) for b in (0, 1, 2**40, -(2**40), top)] * 3
    rows = spark.createDataFrame(values, "a long, place long").repartition(4)
    got = sorted(radix_ranks(rows, [F.col("a"), F.col("place")], "r").collect(), key=lambda r: r.r)
    assert [r.r for r in got] == list(range(1, len(values) + 1))
    assert [(r.a, r.place) for r in got] == sorted(values)
    same = spark.createDataFrame([(4,)] * 9, "a long").repartition(3)
    assert sorted(r.r for r in radix_ranks(same, [F.col("a")], "r").collect()) == list(range(1, 10))
    assert radix_ranks(same.limit(0), [F.col("a")], "r").count() == 0


def test_radix_blocks_are_ordered_across(spark, monkeypatch):
    from clickweave.llm import importance

    monkeypatch.setattr(importance, "BLOCK_BITS", 3)
    monkeypatch.setattr(importance, "DIGIT_BITS", 2)
    values = [(i * 7919 % 101, i) for i in range(500)]
    rows = spark.createDataFrame(values, "a long, i long").repartition(5)
    got = sorted(radix_ranks(rows, [F.col("a"), F.col("i")]).collect(), key=lambda r: r["rank"])
    assert [(r.a, r.i) for r in got] == sorted(values)
