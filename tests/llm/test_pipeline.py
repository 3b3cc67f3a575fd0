"""The pipeline's stages against brute force, each on what its predecessor kept."""

import re
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from clickweave.llm.language_id import compressors, fit_dictionaries, judge
from clickweave.llm.queries import LLM_QUERIES, MIX_DOMAINS, MIX_SEED, MIX_WEIGHTS, tokenizer_path

from .helpers import SPACE, awkward, components, empty, words
from .test_mixing import shares
from .test_simhash_pivots import slow

SF = "/root/testdata/sf0.001"


def test_registered_queries():
    import __spark_entry__ as E

    names = [n for n in E.queries() if n.startswith("op")]
    assert {n.split("_")[0] for n in names} >= {f"op{i}" for i in range(1, 14)} and "pipeline" in E.queries()
    assert set(LLM_QUERIES) <= set(E.queries())


def test_stages(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(awkward(spark))
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, seen[-1], SF).write.parquet(f"{tmp_dir}/{name}")
        seen.append(spark.read.parquet(f"{tmp_dir}/{name}"))
    rows = [[tuple(r) for r in d.collect()] for d in seen]
    assert all(d.columns == docs.columns for d in seen[:-1])

    made = compressors(fit_dictionaries(docs.select("doc_id", "text", "lang")))
    want = []
    for r in rows[0]:
        lang, _, margin = judge(r[1], made, 1024)
        if lang != "und" and margin >= 0.002:
            want.append(r)
    assert sorted(rows[1], key=str) == sorted(want, key=str) and len(want) > 0.9 * len(rows[0])

    keys = [[x.strip(SPACE).lower() if x.isascii() else x.strip(SPACE) for x in r[1].split("\n")] for r in rows[1]]
    often = Counter(k for ks in keys for k in set(ks))
    want = []
    for r, ks in zip(rows[1], keys):
        text = "\n".join(x for x, k in zip(r[1].split("\n"), ks) if not k or often[k] < 10)
        want.append((r[0], text, r[2], r[3], len(text)))
    assert sorted(rows[2], key=str) == sorted(want, key=str)

    prints = {slow(r[1]) for r in rows[2]}
    group = components(prints, [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2])
    best: dict = {}
    for r in rows[2]:
        if r[0] is not None:
            g = group[slow(r[1])]
            best[g] = min(best.get(g, r[0]), r[0])
    assert sorted(r[0] for r in rows[3] if r[0] is not None) == sorted(best.values())

    taken = Counter(str(r) for r in rows[4])
    assert set(taken) <= {str(r) for r in rows[3]} and max(taken.values()) <= 2
    # every leaf: all of its budget, and less than its own longest document more
    def leaf(r):
        number = re.search("([0-9]+)$", r[3] or "")
        return (f"d{int(number[1][-6:]) % MIX_DOMAINS}" if number else None, r[2], r[3])

    held, longest, used = Counter(), Counter(), Counter()
    for r in rows[3]:
        n = len(words(r[1]))
        held[leaf(r)] += n
        longest[leaf(r)] = max(longest[leaf(r)], n)
    for r in rows[4]:
        used[leaf(r)] += len(words(r[1]))
    budgets = leaf_budgets_of(held, MIX_WEIGHTS, 2)
    assert sum(budgets.values()) == sum(held.values())
    for k, budget in budgets.items():
        assert budget <= used[k] < budget + max(1, longest[k]), k
    assert set(used) <= {k for k, b in budgets.items() if b}

    packed = seen[5].groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert all(r[1] <= 2048 for r in packed)
    assert seen[5].filter("start = 0").count() == len(rows[4])


def test_stages_leave_columns_of_any_name_alone(spark):
    """A table with further columns, named like the operators' own, through each filtering stage."""
    names = "fp n_lines epoch bucket edge times score n_tokens row copies digest".split()
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(awkward(spark))
    wide = docs.select("*", *(F.concat(F.lit(f"{n}:"), "doc_id").alias(n) for n in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain, kept = stage(spark, docs, SF), stage(spark, wide, SF)
        assert kept.columns == wide.columns, name
        rows = kept.collect()
        assert Counter(str(r.doc_id) for r in rows) == Counter(str(r.doc_id) for r in plain.collect()), name
        assert all(r[n] is None if r.doc_id is None else r[n] == f"{n}:{r.doc_id}" for r in rows for n in names), name


def leaf_budgets_of(held, weights, epochs):
    """Budgets of the leaves of a tree of three levels, by the plain shares of test_mixing."""
    rooms = Counter()
    for path, tokens in held.items():
        for depth in range(1, 4):
            rooms[path[:depth]] += tokens * epochs
    budgets = {(): sum(held.values())}
    for depth in range(1, 4):
        for parent in [p for p in list(budgets) if len(p) == depth - 1]:
            children = {p[-1]: n for p, n in rooms.items() if len(p) == depth and p[:-1] == parent}
            own = shares(children, {k: weights.get((*parent, k), 1) for k in children}, budgets[parent])
            budgets |= {(*parent, k): n for k, n in own.items()}
    return {p: n for p, n in budgets.items() if len(p) == 3}


def test_run_leaves_no_copies_behind(spark):
    import glob

    from clickweave.session import shared_dir

    base = f"{shared_dir(spark).removeprefix('file://')}/clickweave/{spark.sparkContext.applicationId}"
    before = set(glob.glob(f"{base}/*"))
    rows = corpus_pipeline.run(spark, SF)
    left = {p.split("/")[-1].rsplit("-", 1)[0] for p in set(glob.glob(f"{base}/*")) - before}
    assert left <= {"mixing", "pieces"} and rows.count() > 0


def test_empty_documents(spark, tmp_dir):
    docs = empty(spark)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{tmp_dir}/{name}")
        docs = spark.read.parquet(f"{tmp_dir}/{name}")
        assert docs.count() == 0
    assert MIX_SEED and MIX_WEIGHTS and tokenizer_path()
