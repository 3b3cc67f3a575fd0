import numpy as np

from clickweave.llm.ego_join import embedding_components

from .helpers import components

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold):
    fine = []
    for r in rows:
        e = r[1]
        ok = r[2] is not None and e is not None and len(e) and None not in e and np.isfinite(np.float32(e)).all() and np.any(np.float32(e))
        fine.append(np.asarray(np.float32(e), float) if ok else None)
    links = []
    for i, a in enumerate(fine):
        for j, b in enumerate(fine[:i]):
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b):
                if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= threshold:
                    links.append((j, i))
    group, n = components(range(len(rows)), links), [0] * len(rows)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    first = {}
    for i, g in group.items():
        ids = [x for x in (first.get(g), rows[i][0]) if x is not None]
        first[g] = min(ids, default=None)
    return sorted(((r[0], n[i], first[group[i]], r[0] is not None and r[0] == first[group[i]]) for i, r in enumerate(rows)), key=str)


def cloud(seed, n, dim=8):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dim))
    rows = []
    for i in range(n):
        v = centres[rng.integers(12)] + rng.standard_normal(dim) * rng.choice([0.02, 0.15, 0.5])
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(3))))
    return rows


def run(spark, rows, **options):
    got = embedding_components(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as dim", "1 as n", "2 as cid"), **options)
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got.collect()), key=str)


def test_against_brute_force(spark):
    rows = cloud(1, 300)
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(20)]  # copies
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 8, 1), (2003, [1.0, None] * 4, 1), (2004, [float("nan")] * 8, 1),
             (2005, [float("inf")] * 8, 1), (2006, rows[0][1], None), (None, rows[0][1], rows[0][2]), (None, [0.0] * 8, 1),
             (2007, [1.0, 2.0], 1), (2008, [2.0, 4.0], 1), (5, rows[5][1], rows[5][2]), (2009, [1e30] * 8, 1), (2010, [1e-30] * 8, 1)]
    for threshold, block in ((0.93, 2048), (0.93, 16), (0.6, 7)):
        assert run(spark, rows, threshold=threshold, block_rows=block) == brute(rows, threshold)


def test_tables_without_vectors(spark):
    assert run(spark, []) == []
    assert run(spark, [(3, None, 1), (None, None, None)]) == [(3, 0, 3, True), (None, 0, None, False)]
