import random

from pyspark.sql import functions as F

from clickweave.llm.simhash_blocks import compare_with_edits, fingerprints, near_fingerprints

from .helpers import AWKWARD, awkward, empty, sha


def edited(text, following):
    n = len(text)
    return text[: n - n // 2] + following[: n // 2]


def test_edits_against_brute_force(spark):
    for rows in (AWKWARD, AWKWARD[:1], AWKWARD[8:10], AWKWARD[10:11]):
        docs = spark.createDataFrame(rows, awkward(spark).schema).selectExpr("*", "'x' as row", "'y' as bucket", "1 as hi")
        digest = {r.text: r.d for r in docs.select(F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("d")).collect()}
        order = sorted(((r[0] is None, r[0] or 0, digest[r[1] or ""], r[1] or "") for r in rows))
        want = []
        for i, (none, doc_id, _, text) in enumerate(order):
            e = edited(text, order[(i + 1) % len(order)][3])
            want.append((str(None if none else doc_id), len(text), sha(e)))
        for buckets in (4, 64):
            got = compare_with_edits(docs, buckets=buckets).collect()
            assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == sorted(want)
        prints = {}
        for r in got:
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and len(r.fingerprint) == 32
        for r, text in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_chars)), [None] * len(got)):
            prints.setdefault((r.n_chars, r.doc_id), set()).add(r.fingerprint)
        assert {r.fingerprint for r in got if r.n_chars == 0} == set(list({r.fingerprint for r in got if r.n_chars == 0})[:1])
    assert compare_with_edits(empty(spark)).count() == 0


def test_votes(spark):
    """Every bit against a plain count of the votes."""
    texts = spark.createDataFrame([(i, r[1]) for i, r in enumerate(AWKWARD)], "k long, text string")
    got = {r.k: (r.hi, r.lo) for r in fingerprints(texts, ["k"]).collect()}
    pairs = []
    for i, r in enumerate(AWKWARD):
        t = texts.filter(F.col("k") == i).select(F.lower(F.coalesce("text", F.lit(""))).alias("t")).first().t.strip(" \t\n\x0b\x0c\r")
        import re

        w = re.split(r"[ \t\n\x0B\f\r]+", t)
        pairs += [(i, a, b) for a, b in zip(w, [*w[1:], None])]
    hashed = spark.createDataFrame(pairs, "k long, a string, b string").select(
        "k", "a", "b", F.xxhash64("a", "b").alias("h0"), F.xxhash64(F.lit(1), "a", "b").alias("h1")).collect()
    for k, want in got.items():
        rows = [(min(16, len(r.a) + len(r.b or "") + 1), r.h0, r.h1) for r in hashed if r.k == k]
        total = sum(w for w, _, _ in rows)
        for at in (0, 1):
            bits = sum(1 << j for j in range(64) if 2 * sum(w for w, *h in rows if h[at] >> j & 1) > total)
            assert want[at] & (2**64 - 1) == bits


def test_block_tables_find_all(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(128) for _ in range(60)]
    prints = set(base) | {b ^ sum({1 << rng.randrange(128) for _ in range(rng.randrange(1, 6))}) for b in base for _ in range(4)}
    prints |= {base[0] ^ (1 << i) ^ (1 << j) for i in range(12) for j in range(i)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    frame = spark.createDataFrame([(signed(x >> 64), signed(x & (2**64 - 1))) for x in prints], "hi long, lo long")
    for radius in (0, 3):
        want = {(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= radius}
        for max_cell in (3, 10**6):
            got = near_fingerprints(frame, radius, max_cell).collect()
            pairs = [tuple(sorted(((r.hi & (2**64 - 1)) << 64 | (r.lo & (2**64 - 1)), (r.hi2 & (2**64 - 1)) << 64 | (r.lo2 & (2**64 - 1))))) for r in got]
            assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_no_python_in_the_plan(spark):
    plan = fingerprints(awkward(spark).withColumn("k", F.lit(1)), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_an_id_on_a_third_of_the_rows_is_cut_by_digest(spark):
    from clickweave.llm.simhash_blocks import _places, edited_documents

    texts = [(7 if i % 3 == 0 else i, f"text {i % 1500} of many") for i in range(3000)] + [(None, "no id"), (None, None), (0, "zero")]
    rows = spark.createDataFrame([(n, i, t) for n, (i, t) in enumerate(texts)], "row long, doc_id long, text string")
    placed, _ = _places(rows.withColumn("text", F.coalesce("text", F.lit(""))), 32)
    sizes = [r["count"] for r in placed.groupBy("bucket").count().collect()]
    assert max(sizes) < 200 and sum(sizes) == 3003
    order = placed.select("row", "doc_id", "digest", "text").collect()
    order.sort(key=lambda r: (r.doc_id is None, r.doc_id or 0, r.digest, r.text))
    want = {}
    for r, after in zip(order, [*order[1:], order[0]]):
        half = len(r.text) // 2
        want[r.row] = (r.text[: len(r.text) - half] + after.text[:half], (after.doc_id, after.text))
    by_row = {r.row: (r.doc_id, r.text) for r in order}
    got = {r.row: (r.edited, by_row[r.next_row]) for r in edited_documents(rows, 32).collect()}
    assert got == want


def test_likeness_columns_equal_brute_force(spark):
    import math

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = compare_with_edits(docs, radius=3).collect()
    prints = {r.doc_id: int(r.fingerprint, 16) for r in got}
    ids = sorted(prints)

    def like(a, b):
        return max(0.0, math.cos((a ^ b).bit_count() * math.pi / 128))

    for r in got:
        after = ids[(ids.index(r.doc_id) + 1) % len(ids)]
        assert math.isclose(r.near_edited, like(prints[r.doc_id], int(r.edited_fingerprint, 16)), abs_tol=1e-12)
        assert math.isclose(r.near_next, like(prints[r.doc_id], prints[after]), abs_tol=1e-12)
        assert r.n_near == sum((prints[r.doc_id] ^ x).bit_count() <= 3 for x in prints.values()) - 1
    # the fingerprint of an edited text is that of the text itself
    texts = dict(docs.collect())
    edits = [(i, texts[i][: len(texts[i]) - len(texts[i]) // 2] + texts[n][: len(texts[i]) // 2]) for i, n in zip(ids, [*ids[1:], ids[0]])]
    again = {r.k: (r.hi, r.lo) for r in fingerprints(spark.createDataFrame(edits, "k long, text string"), ["k"]).collect()}
    for r in got:
        hi, lo = (x & (2**64 - 1) for x in again[r.doc_id])
        assert r.edited_fingerprint == f"{hi:016x}{lo:016x}"
