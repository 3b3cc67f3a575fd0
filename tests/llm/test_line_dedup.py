from collections import Counter

from clickweave.llm import line_dedup
from clickweave.llm.line_dedup import dedup_lines

from .helpers import AWKWARD, SPACE, awkward, empty

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs, min_chars):
    split = [(r[1] or "").split("\n") for r in rows]
    keys = [[x.strip(SPACE).translate(LOWER) for x in ls] for ls in split]
    often = Counter(k for ks in keys for k in set(ks) if len(k) >= min_chars)
    out = []
    for r, ls, ks in zip(rows, split, keys):
        kept = [x for x, k in zip(ls, ks) if len(k) < min_chars or often[k] < min_docs]
        out.append((r[0], "\n".join(kept), len(ls), len(ls) - len(kept)))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    for min_docs, min_chars in ((2, 1), (3, 1), (2, 8)):
        got = dedup_lines(awkward(spark), min_docs=min_docs, min_chars=min_chars)
        rows = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()]
        assert sorted(rows, key=str) == brute(AWKWARD, min_docs, min_chars)


def test_clashing_columns_and_empty_table(spark):
    docs = awkward(spark).selectExpr("*", "'x' as n_lines", "'y' as _own", "'z' as _KEEP", "'k' as key", "'p' as pos")
    got = dedup_lines(docs, min_docs=2)
    assert [c for c in got.columns if c not in ("n_lines", "n_dropped")] == [c for c in docs.columns if c != "n_lines"]
    row = got.filter("doc_id = 1").first()
    assert (row["_own"], row["_KEEP"], row["key"], row["pos"]) == ("y", "z", "k", "p")
    assert (row.n_lines, row.n_dropped, row.text) == (3, 3, "")
    assert dedup_lines(empty(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = dedup_lines(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_rows_that_share_a_text_hold_each_position_once(spark, monkeypatch):
    collected = []
    for name in ("collect_list", "collect_set"):
        real = getattr(line_dedup.F, name)
        monkeypatch.setattr(line_dedup.F, name, lambda c, real=real, name=name: collected.append(name) or real(c))
    rows = [(1, "same\nline")] * 40 + [(None, "same\nline")] * 3
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_docs=2).collect()
    assert collected == ["collect_set"]  # a list would have one position a row and line
    assert sorted((str(r.doc_id), r.text, r.n_lines, r.n_dropped) for r in got) == sorted((str(i), "", 2, 2) for i, _ in rows)
