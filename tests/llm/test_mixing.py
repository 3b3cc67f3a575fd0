import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from clickweave.llm.mixing import leaf_budgets, mix_sources

from .helpers import AWKWARD, awkward, empty, words

def levels():
    return {"lang": F.col("lang"), "source": F.col("source")}


def shares(rooms, weights, budget):
    """Integer shares of one node's children (sorted by room per weight)."""
    order = sorted(rooms, key=lambda k: (rooms[k] / weights[k], (k is not None, k or "")))
    out, left, i = {}, budget, 0
    while i < len(order) and rooms[order[i]] * sum(weights[k] for k in order[i:]) <= left * weights[order[i]]:
        out[order[i]] = rooms[order[i]]
        left -= rooms[order[i]]
        i += 1
    reached, total = 0, sum(weights[k] for k in order[i:])
    for k in order[i:]:
        out[k] = (reached + weights[k]) * left // total - reached * left // total
        reached += weights[k]
    return out


def brute(rows, weights, total, epochs, seed):
    leaves = defaultdict(list)
    for r in rows:
        leaves[r[2], r[3]].append(r)
    tokens = {k: sum(len(words(r[1])) for r in v) for k, v in leaves.items()}
    langs = {}
    for lang, source in leaves:
        langs.setdefault(lang, {})[source] = tokens[lang, source] * epochs
    rooms = {lang: sum(s.values()) for lang, s in langs.items()}
    wanted = min(sum(tokens.values()) if total is None else total, sum(rooms.values()))
    top = shares(rooms, {k: weights.get((k,), 1) for k in rooms}, wanted)
    out = []
    for lang, sources in langs.items():
        own = shares(sources, {s: weights.get((lang, s), 1) for s in sources}, top[lang])
        for source, budget in own.items():
            if not budget:
                continue
            held, docs = tokens[lang, source], leaves[lang, source]
            whole, rest = divmod(budget, held)
            for e in range(whole):
                out += [(r[0], e, budget) for r in docs]
            key = lambda r: (hashlib.md5(f"{seed}:{whole}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[0] or -1, r[1] or "")
            at = 0
            for r in sorted(docs, key=key):
                if at < rest:
                    out.append((r[0], whole, budget))
                at += len(words(r[1]))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    for weights, total, epochs in (({}, None, 1), ({("de",): 1, ("en",): 5, ("en", "src0"): 3}, 500, 3), ({("fr",): 9}, 10**9, 4)):
        got = mix_sources(awkward(spark), levels(), weights, total, epochs, seed=5, buckets=7)
        assert sorted(((r.doc_id, r.epoch, r.leaf_budget) for r in got.collect()), key=str) == brute(AWKWARD, weights, total, epochs, 5)


def test_shortage_goes_to_siblings_before_ancestors(spark):
    leaves = spark.createDataFrame(
        [("a", "a1", 10), ("a", "a2", 1000), ("b", "b1", 1000), ("b", "b2", 1000)], "d string, s string, tokens long")
    got = {r.s: r.budget for r in leaf_budgets(leaves, ["d", "s"], {}, 400, 1).collect()}
    assert got == {"a1": 10, "a2": 190, "b1": 100, "b2": 100}  # a2 takes all of a1's shortage
    got = {r.s: r.budget for r in leaf_budgets(leaves, ["d", "s"], {("a", "a2"): 0}, 400, 1).collect()}
    assert got == {"a1": 10, "a2": 0, "b1": 195, "b2": 195}  # what a cannot use goes to b
    got = {r.s: r.budget for r in leaf_budgets(leaves, ["d", "s"], {}, 10**9, 2).collect()}
    assert sum(got.values()) == 2 * 3010


def test_clashing_columns_and_empty_table(spark):
    docs = awkward(spark).selectExpr("*", "'x' as epoch", "'y' as bucket_", "'z' as level_lang")
    got = mix_sources(docs, levels(), max_epochs=1)
    assert "level_lang" in got.columns and got.filter("doc_id = 1").first().level_lang == "z"
    assert dict(got.dtypes)["epoch"] == "bigint"
    assert mix_sources(empty(spark), levels()).count() == 0


def test_columns_with_internal_names_keep_their_values(spark):
    names = "edge before tokens bucket order_key times start whole rest budget room weight held column_0 level_0 n".split()
    docs = spark.createDataFrame([(i, f"a b c {i}", "en" if i % 3 else "de") for i in range(60)], "doc_id long, text string, lang string")
    wide = docs.select("*", *(F.concat(F.lit(f"{n}:"), F.col("doc_id")).alias(n) for n in names))
    levels = {"lang": F.col("lang")}
    weights = {("en",): 1, ("de",): 3}
    plain, got = (mix_sources(d, levels, weights, max_epochs=3) for d in (docs, wide))
    assert got.columns == [*wide.columns, "epoch", "n_tokens", "leaf_budget"]
    rows = got.collect()
    assert all(r[n] == f"{n}:{r.doc_id}" for r in rows for n in names)
    assert sorted((r.doc_id, r.epoch) for r in rows) == sorted((r.doc_id, r.epoch) for r in plain.collect())


def test_rows_without_an_id_are_ranked_in_ranges(spark):
    """A third of the rows share one order key; the budget ends among them."""
    rows = [(None if i % 3 == 0 else i, f"{i % 700} " + "w " * (i % 5), "en" if i % 2 else "de", "s") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for total in (2500, 6000):
        got = mix_sources(docs, levels(), {("en",): 2}, total_tokens=total, max_epochs=2, seed=3)
        assert sorted(((r.doc_id, r.epoch, r.leaf_budget) for r in got.collect()), key=str) == brute(rows, {("en",): 2}, total, 2, 3)
