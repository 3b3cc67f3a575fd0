"""Ranks over groups that span many tasks, seeded permutations, range-partitioned clicks."""

import random

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickweave.operators import click_extract, click_extract_ranged, permute_rows, train_rows, with_position
from clickweave.operators.ranking import ranged, ranked_in_groups


def hot_rows(spark, n=6000):
    pick = random.Random(2)
    rows = [("hot" if i % 3 == 0 else pick.choice(["a", "b", None]), pick.randrange(40), i, pick.random() < 0.3) for i in range(n)]
    return spark.createDataFrame(rows, "g string, t int, id int, flag boolean").repartition(5)


def test_ranks_equal_one_window(spark):
    rows = hot_rows(spark)
    order = [F.col("t").desc(), F.col("id")]
    flag = F.col("flag").cast("int")
    got = ranked_in_groups(rows, ["g"], order, {"flags": flag}, {"all_flags": flag, "size": F.lit(1)}, num_partitions=7)
    w = W.partitionBy("g").orderBy(*order)
    running = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy("g")
    want = rows.select("*", F.row_number().over(w).alias("rank"), F.sum(flag).over(running).alias("flags"),
                       F.sum(flag).over(whole).alias("all_flags"), F.count("*").over(whole).alias("size"))
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert ranked_in_groups(rows.limit(0), ["g"], order).count() == 0


def test_a_group_with_a_third_of_all_rows_lies_in_many_ranges(spark):
    held = ranged(hot_rows(spark), ["g"], [F.col("t").desc(), F.col("id")], 8)
    sizes = [r["count"] for r in held.groupBy("_range").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 3 * sorted(sizes)[4]
    assert held.filter("g = 'hot'").select("_range").distinct().count() >= 3


def test_spread_training_rows_equal_those_of_one_window(spark):
    pick = random.Random(9)
    base, rows = 1_700_000_000, []
    for i in range(4000):
        user = "hot" if i % 3 == 0 else f"u{i % 5}"
        weight = pick.choice([0, 0, 0, 1, 3, 4])
        rows.append((user, f"d{pick.randrange(900)}", "x", base + pick.randrange(20) * 86400 + pick.randrange(3), weight))
    events = spark.createDataFrame(rows, "userid string, docid string, event string, t long, weight int")
    rules = dict(as_of="2023-12-10 00:00:00", tz="UTC", max_events=None, max_rows=None, recent_days=300, min_span_days=0)
    spread, one = (sorted(map(tuple, train_rows(events, spread=s, **rules).collect()), key=str) for s in (True, False))
    assert spread == one and sum(r[0] == "hot" for r in spread) > 50
    capped = train_rows(events, **{**rules, "max_events": 10**6, "max_rows": 250})
    assert sorted((tuple(r) for r in capped.collect()), key=str) == sorted((r for r in spread if r[6] <= 250), key=str)
    # by default the windows are spread exactly when there is no event cap
    plan = train_rows(events, **rules)._jdf.queryExecution().toString()
    assert "_range" in plan and "_range" not in capped._jdf.queryExecution().toString()


def test_permutation_depends_on_seed_and_rows_alone(spark):
    rows = hot_rows(spark, 2000)
    rows = rows.unionByName(rows.limit(300))
    placed = [
        sorted(map(str, with_position(permute_rows(given, 6, seed)).collect()))
        for given, seed in ((rows, 1), (rows.repartition(11, "id"), 1), (rows.coalesce(1), 2))
    ]
    assert placed[0] == placed[1] != placed[2]
    at = with_position(permute_rows(rows, 6, 1)).collect()
    assert {r.partition for r in at} == set(range(6)) and len(at) == 2300
    ids = [r.id for r in sorted(at, key=lambda r: (r.partition, r.position))]
    assert sum(a < b for a, b in zip(ids, ids[1:])) < 0.6 * len(ids)  # not the order that came in
    assert permute_rows(rows.limit(0), 6, 1).count() == 0


def test_ranged_clicks_are_in_one_order(spark, lines):
    recs = [
        {"userid": "hot" if i % 3 else f"u{i % 7}", "appid": "oppobrowser", "type": "click",
         "click": {"event": "like", "docid": f"d{i % 91}", "date": "2024-01-01 10:00:00", "details": {}},
         "view": {"channelType": "selected", "details": {"mashtype": "profile", "pos": str(i % 10)}}}
        for i in range(900)
    ]
    df = lines(recs)
    at = sorted(with_position(click_extract_ranged(df, num_partitions=6)).collect(), key=lambda r: (r.partition, r.position))
    keys = [(r.userid, r.pos, r.docid, r.event) for r in at]
    assert keys == sorted(keys) and len({r.partition for r in at if r.userid == "hot"}) > 2
    assert sorted(keys) == sorted((r.userid, r.pos, r.docid, r.event) for r in click_extract(df).collect())
