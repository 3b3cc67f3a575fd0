import random

import xxhash
from pyspark.sql import functions as F

from clickweave.llm.simhash_pivots import drop_near_duplicates, fingerprint_groups, fingerprint_links, simhash, simhash_components

from .helpers import AWKWARD, awkward, components, empty, words


def slow(text, n=3):
    w = words(text)
    grams = [b" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_components(spark):
    got = simhash_components(awkward(spark).withColumn("fp", F.lit("x"))).collect()
    assert sorted((str(r.doc_id), r.fingerprint) for r in got) == sorted((str(r[0]), f"{slow(r[1]):016x}") for r in AWKWARD)
    by_print = {}
    for r in AWKWARD:
        by_print.setdefault(slow(r[1]), []).append(r[0])
    prints = list(by_print)
    links = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2]
    group = components(prints, links)
    first = {g: min((i for p in prints if group[p] == g for i in by_print[p] if i is not None), default=None) for g in group.values()}
    for r in got:
        assert r.component_id == first[group[int(r.fingerprint, 16)]]
    assert simhash_components(empty(spark)).count() == 0


def test_links_of_dense_and_scattered_fingerprints(spark):
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    prints = {centre ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(6))}) for _ in range(300)}
    prints |= {rng.getrandbits(64) for _ in range(200)}
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(signed)], "doc_id long, fp long")
    for max_bits in (0, 1, 2):
        near = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= max_bits]
        want = components(signed, near)
        ids = {x: i for i, x in enumerate(signed)}
        smallest = {}
        for x, g in want.items():
            smallest[g] = min(smallest.get(g, ids[x]), ids[x])
        for max_cell in (4, 10**6):
            links = [(r.a, r.b) for r in fingerprint_links(frame.select("fp"), max_bits, max_cell=max_cell).collect()]
            assert components(signed, links) == want
        got = {r.fp: r.component_id for r in fingerprint_groups(frame, max_bits).collect()}
        assert got == {x: smallest[want[x]] for x in signed}


def test_one_of_each_group_stays(spark):
    docs = awkward(spark)
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    # 1 and the copy without id; 3, 4, 5 and the row of nulls have no words; 6 and 7, and the two rows 9, are copies
    assert sorted(ids) == [1, 2, 3, 6, 8, 9, 12]
    nameless = spark.createDataFrame([(None, "a b c d"), (None, "a b c d")], "doc_id long, text string")
    assert drop_near_duplicates(nameless).count() == 1
    assert drop_near_duplicates(empty(spark)).count() == 0


def test_slices_of_a_long_text(monkeypatch):
    from clickweave.llm import simhash_pivots

    monkeypatch.setattr(simhash_pivots, "SLICE", 5)
    for r in AWKWARD[:3]:
        assert simhash(r[1] or "") == slow(r[1])


def test_dropped_copies_leave_other_columns_alone(spark):
    rows = [(1, "a b c d", "x"), (1, "a b c d", "w"), (2, "a b c d", "y"), (3, "other words stand here", "z"), (None, None, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _f string")
    names = "_d n fp root first_id component_id chosen_fp chosen_id copies rank cell distances".split()
    wide = docs.select("*", *(F.col("_f").alias(n) for n in names))
    kept = drop_near_duplicates(wide)
    assert kept.columns == wide.columns
    got = kept.collect()
    assert sorted(r._f for r in got) == ["q", "w", "z"] and all(r[n] == r._f for r in got for n in names)
    assert drop_near_duplicates(wide.limit(0)).count() == 0
