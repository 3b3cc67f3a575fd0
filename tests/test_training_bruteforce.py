"""Whole-table brute force for the flagship query: qualification and the sampler
re-done sequentially in Python over the weighted events, compared with Spark."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from test_training import sequential

SF = "/root/testdata/sf0.01"
DAY = 86400
AS_OF = 1706659200  # 2024-01-31 00:00:00 UTC


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver data")
def test_train_rows_match_sequential_brute_force(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF}/events.parquet')")
    ev = con.execute(E.oracle_sql()["event_weights"]).fetchall()  # userid, docid, event, t, weight
    per_user = {}
    for u, d, _, t, w in ev:
        per_user.setdefault(u, []).append((u, d, t, w))
    keep = []
    for u, rows in per_user.items():
        ts = [r[2] for r in rows]
        strong = sum(1 for r in rows if 1 <= r[3] <= 3)
        n = len(rows)
        if (strong >= 10 and max(ts) >= AS_OF - 30 * DAY and min(ts) <= AS_OF - 5 * DAY and 2 * strong <= n
                and max(ts) - min(ts) >= 3 * DAY and n <= 20000):
            keep += rows
    want = sequential(keep)
    got = sorted((r.userid, r.r, r.pos, tuple(x for x in (r.neg1, r.neg2, r.neg3) if x is not None))
                 for r in E.queries()["train_rows"](spark, SF).collect())
    assert len(want) > 1000 and got == want
