import re
from collections import defaultdict

import pytest

from clickweave.llm.licenses import NOTICES, PHRASES, WORD, scan_licenses, templates_of

from .helpers import AWKWARD, awkward, empty

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

MIT = "MIT\nlicense"
TEXTS = [
    "Released under the MIT License.",
    "mit license mit LICENSE, mit-license x apache license",
    MIT,
    "general public general public license general public license",
    "general license public",
    "word " * 13 + "MIT License" + " word" * 40 + " Apache License",
    "Licensed beneath CC BY-NC 4.0, so there",
    "Licensed under nothing, CC x y z w v u t s r q p o n m BY NC 4 0",
    "permission is hereby granted free of charge to any person who gets a copy of this software and associated "
    "documentation files to deal in the software without a restriction",
    "Licensed under the Apache License, Version 2.0. Licensed under CC BY-SA 4.0.",
    "ſt MİT license éapache license MIT License mit\x00license",
    "mit " * 3000 + "license",
]


def brute_force(rows, phrases=PHRASES, notices=NOTICES, threshold=0.8):
    templates, out = templates_of(phrases, notices, threshold), []
    for doc_id, text in rows:
        words = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        places, base, labels, score = [], set(), set(), 0.0
        blocks = defaultdict(list)
        for t in templates:
            if t.phrase:
                here = [i for i in range(len(words)) if words[i : i + len(t.words)] == t.words]
                places += here
                base |= {t.label} if here else set()
                score = 1.0 if here else score
                continue
            for start in range(0, len(words), t.stride):
                held = set(words[start : start + 2 * t.stride]) & set(t.tokens)
                if len(held) >= threshold * len(t.tokens):
                    blocks[t.stride, start].append((held, t))
        for matches in blocks.values():
            for held, t in matches:
                if not any(held < other for other, _ in matches):
                    labels.add(t.label)
                    score = max(score, len(held) / len(t.tokens))
        first, last = (min(places), max(places)) if places else (None, None)
        out.append((doc_id, len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(base | labels)), score))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=str)


@pytest.mark.parametrize("threshold", [0.8, 0.3, 1.0])
def test_awkward_rows_equal_brute_force(spark, threshold):
    rows = [(r[0], r[1]) for r in AWKWARD] + [(100 + i, t) for i, t in enumerate(TEXTS)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.selectExpr("*", "1 as `row`", "2 as words", "'z' as labels", "3 as stride", "4 as word", "5 as blocks")
    got = found(scan_licenses(docs, threshold=threshold))
    assert got == brute_force(rows, threshold=threshold)
    if threshold == 0.8:
        labels = {r[0]: r[6] for r in got}
        assert labels[106] == "cc-by-nc" and labels[109] == "apache,cc-by-sa" and labels[107] == "" and labels[108] == "mit" and labels[104] == ""
    assert scan_licenses(empty(spark)).count() == 0


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = found(scan_licenses(docs))
    assert got == brute_force(rows)
    assert any(r[6] and not r[5] for r in got)


def test_random_blocks_equal_brute_force(spark):
    import random

    pick = random.Random(5)
    texts = [" ".join(pick.choices("a b c d e f g h i j the of".split(), k=pick.randrange(0, 90))) for _ in range(120)]
    phrases = [("a b", "x"), ("c", "y"), ("a a", "z")]
    notices = [("a b c d e", "x"), ("the of a f g h i j c", "v"), ("j", "w")]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for threshold in (0.5, 0.8, 0.9):
        assert found(scan_licenses(docs, phrases, notices, threshold)) == brute_force(rows, phrases, notices, threshold)


def test_no_python_and_one_broadcast(spark):
    text = scan_licenses(awkward(spark))._jdf.queryExecution().toString()
    assert "Python" not in text and "InArrow" not in text and "CartesianProduct" not in text


def test_long_text_of_a_frequent_line(spark):
    line = "Released under the MIT License. some other words here and there\n"
    rows = [(1, line * 20_000), (2, "x " * 400_000 + "apache license")]
    got = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word) == (20_000, 3, 19_999 * 11 + 3)
    assert (got[2].first_word, got[2].labels) == (400_000, "apache")
