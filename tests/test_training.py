"""Training rows: hand-traced cases, qualification boundaries, the cap, and a
property test of the set-based sampler against a direct sequential simulation."""

import random

import pytest

from clickweave.functions.codes import EVENT_WEIGHTS
from clickweave.operators.training import (
    assemble_rows, doc_labels, doc_stats, qualified_users, ranked_slots, removed_counts, train_rows, user_stats,
)
from clickweave.sources.events_tsv import parse_events_tsv, prepare_training_events

CODE = {0: "vw", 1: "clk", 2: "ac", 3: "shr", 4: "dlk"}


def weighted(spark, events):
    """events: (user, doc, t, weight) -> weighted event frame."""
    return spark.createDataFrame(
        [(u, d, CODE[w], int(t), w) for u, d, t, w in events],
        "userid string, docid string, event string, t bigint, weight int",
    )


def sample(spark, events, max_rows=250):
    """Sampler without qualification (all users pass)."""
    ds = doc_stats(weighted(spark, events))
    out = assemble_rows(ranked_slots(doc_labels(ds)), max_rows)
    return sorted(
        (r.userid, r.r, r.pos, tuple(x for x in (r.neg1, r.neg2, r.neg3) if x is not None)) for r in out.collect()
    )


def sequential(events, max_rows=250):
    """Direct simulation of the rules, one user at a time, newest event first.

    Ties in time are taken in docid order, and for one doc the larger weight first.
    """
    by_user = {}
    for u, d, t, w in events:
        by_user.setdefault(u, []).append((t, d, w))
    out = []
    for u, evs in by_user.items():
        evs.sort(key=lambda e: (-e[0], e[1], -e[2]))
        lists = {0: [], 1: [], 4: []}  # weak, strong, strong-negative
        slot = {}  # doc -> (weight, list key, index)
        for _, d, w in evs:
            cls = 0 if w == 0 else (4 if w == 4 else 1)
            if d in slot:
                ow, ok, oi = slot[d]
                if w > ow:
                    if ok in (0, 1):
                        lists[ok][oi] = ""
                    lists[cls].append(d)
                    slot[d] = (w, cls, len(lists[cls]) - 1)
            else:
                lists[cls].append(d)
                slot[d] = (w, cls, len(lists[cls]) - 1)
        pool = lists[4] + lists[0]
        pos, r, emitted = 0, 0, 0
        for x in lists[1]:
            if x == "":
                continue
            r += 1
            if pos + 2 < len(pool) and emitted < max_rows:
                negs = []
                for _ in range(3):
                    while pos < len(pool) and pool[pos] == "":
                        pos += 1
                    if pos < len(pool):
                        negs.append(pool[pos])
                        pos += 1
                emitted += 1
                out.append((u, r, x, tuple(negs)))
    return sorted(out)


def test_hand_traced_case(spark):
    # newest first: 100 d1 vw, 99 d2 clk, 98 d1 shr, 97 d3 dlk, 96 d4 vw, 95 d5 vw, 94 d2 lk, 93 d6 vw, 92 d4 vw
    ev = [("u", "d1", 100, 0), ("u", "d2", 99, 1), ("u", "d1", 98, 3), ("u", "d3", 97, 4), ("u", "d4", 96, 0),
          ("u", "d5", 95, 0), ("u", "d2", 94, 3), ("u", "d6", 93, 0), ("u", "d4", 92, 0)]
    assert sample(spark, ev) == [("u", 1, "d1", ("d3", "d4", "d5"))]
    assert sequential(ev) == sample(spark, ev)


def _tail_case(weak_tail):
    # positives x1 > x2 > x3 (newest first); pool: n1 n2 n3 (strong negatives), then weak slots
    ev = [("u", "x1", 1000, 1), ("u", "x2", 999, 1), ("u", "x3", 998, 1),
          ("u", "n1", 900, 4), ("u", "n2", 899, 4), ("u", "n3", 898, 4)]
    t = 800
    for name in weak_tail:
        if name.startswith("b"):  # a blanked weak slot: newest event weak, older one strong
            ev += [("u", name, t, 0), ("u", name, 10 + t % 7, 3)]
        else:
            ev.append(("u", name, t, 0))
        t -= 1
    return ev


def test_short_tail(spark):
    ev = _tail_case(["b1", "b2", "w1"])
    got = sample(spark, ev)
    assert got == sequential(ev)
    mine = [g for g in got if g[2].startswith("x")]
    assert mine[0] == ("u", 1, "x1", ("n1", "n2", "n3"))
    assert ("u", 2, "x2", ("w1",)) in mine
    assert all(g[2] != "x3" for g in mine)


def test_no_negatives_left(spark):
    ev = _tail_case(["b1", "b2", "b3"])
    got = sample(spark, ev)
    assert got == sequential(ev)
    xs = [g for g in got if g[2].startswith("x")]
    assert ("u", 2, "x2", ()) in xs and all(g[2] != "x3" for g in xs)


def test_row_limit(spark):
    ev = [("u", f"p{i:04d}", 100000 - i, 1) for i in range(300)]
    ev += [("u", f"n{i:04d}", 50000 - i, 0) for i in range(1000)]
    got = sample(spark, ev, max_rows=250)
    assert len(got) == 250 and got == sequential(ev, 250)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_property_against_sequential(spark, seed):
    rnd = random.Random(seed)
    ev = []
    for u in range(120):
        n_docs = rnd.randint(1, 25)
        for _ in range(rnd.randint(1, 60)):
            w = rnd.choice([0, 0, 0, 1, 2, 3, 3, 4])
            # few distinct times -> many ties, within and across docs
            ev.append((f"u{u}", f"d{rnd.randint(0, n_docs)}", rnd.randint(0, 40), w))
    assert sample(spark, ev) == sequential(ev)


DAY = 86400
AS_OF = "2024-01-31 00:00:00"
NOW = 1706659200  # AS_OF in UTC


def _stats(spark, rows):
    return spark.createDataFrame(rows, "userid string, t_max bigint, t_min bigint, n_strong bigint, n_events bigint")


def test_qualification_boundaries(spark):
    base = dict(t_max=NOW - DAY, t_min=NOW - 10 * DAY, n_strong=10, n_events=40)
    cases = {
        "ok": {},
        "strong9": dict(n_strong=9),
        "half": dict(n_strong=10, n_events=20),           # 2 * strong = total passes
        "over_half": dict(n_strong=11, n_events=21),
        "span3d": dict(t_max=NOW - 6 * DAY, t_min=NOW - 9 * DAY),   # exactly 3 days passes
        "span_short": dict(t_max=NOW - 6 * DAY, t_min=NOW - 9 * DAY + 1),
        "last_edge": dict(t_max=NOW - 30 * DAY, t_min=NOW - 40 * DAY),  # exactly as_of - 30 d passes
        "last_old": dict(t_max=NOW - 30 * DAY - 1, t_min=NOW - 40 * DAY),
        "first_edge": dict(t_min=NOW - 5 * DAY),          # exactly as_of - 5 d passes
        "first_new": dict(t_min=NOW - 5 * DAY + 1),
        "cap": dict(n_events=20000),
        "cap_over": dict(n_events=20001),
    }
    rows = []
    for name, over in cases.items():
        d = {**base, **over}
        rows.append((name, d["t_max"], d["t_min"], d["n_strong"], d["n_events"]))
    got = {r.userid for r in qualified_users(_stats(spark, rows), as_of=AS_OF, tz="UTC").collect()}
    assert got == {"ok", "half", "span3d", "last_edge", "first_edge", "cap"}


def test_event_cap_on_events(spark):
    # 20,000 events stay, 20,001 are dropped whole (checked on the statistics path)
    ev = []
    for u, n in (("keep", 20000), ("drop", 20001)):
        ev += [(u, f"d{i % 50}", NOW - 20 * DAY + i * 60, 1 if i % 4 == 0 else 0) for i in range(n)]
    df = weighted(spark, ev)
    q = qualified_users(user_stats(df), as_of=AS_OF, tz="UTC")
    assert {r.userid for r in q.collect()} == {"keep"}
    rows = train_rows(df, as_of=AS_OF, tz="UTC", checkpoint=False).select("userid").distinct().collect()
    assert {r.userid for r in rows} == {"keep"}


def test_tsv_source_rules(spark):
    lines = spark.createDataFrame([(v,) for v in [
        "u\td\tclk\t2024-01-05 10:00:00\tapp_oppo",
        "u\td\tclk\t2024-01-05 10:00:00\tapp_oppo\textra",
        "u\td\tclk\t2024-01-05 10:00:00\t\t\t",           # trailing empties do not count -> 4 fields
        "u\td\tvc\t2024-01-05 10:00:00\tapp_oppo",          # not weighted
        "u\td\tlk\t2024-13-05 10:00:00\tapp_oppo",          # bad date
        "u\td\tshr\t2017-09-28 23:59:59\tapp_oppo",         # before the floor (UTC+8)
        "u\td\tshr\t2017-09-29 00:00:00\tapp_oppo",
    ]], "value string")
    out = prepare_training_events(parse_events_tsv(lines), tz="Asia/Shanghai").collect()
    assert sorted((r.event, r.t, r.weight) for r in out) == sorted([
        ("clk", 1704420000, 1), ("clk", 1704420000, 1), ("shr", 1506614400, 3)])
    assert set(EVENT_WEIGHTS) == {"vw", "clk", "ac", "shr", "lk", "dlk"}


def _two_hot_users(spark):
    # two users hold most rows and are over a (lowered) cap; "ok" qualifies
    ev = [(h, f"d{i % 300}", NOW - 20 * DAY + i * 300, [1, 0, 0, 4, 3][(i + i // 5) % 5]) for h in ("hot1", "hot2") for i in range(3000)]
    ev += [("ok", f"d{i % 40}", NOW - 20 * DAY + i * 3600, [1, 0, 0, 4, 3][i % 5]) for i in range(300)]
    return weighted(spark, ev)


def test_every_user_over_the_cap_is_removed_and_split(spark):
    df = _two_hot_users(spark)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = train_rows(df, as_of=AS_OF, tz="UTC", max_events=2000)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert {r.userid for r in rows.collect()} == {"ok"}
        # the semi join meets two plain exchanges of written tables, which AQE can split at a heavy user
        join = plan[plan.index("SortMergeJoin"):]
        assert "LeftSemi" in join.splitlines()[0]
        sides = [x for x in join.splitlines() if "Exchange hashpartitioning(userid" in x]
        assert len(sides) == 2 and "Aggregate" not in join
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_caps_can_be_switched_off_and_are_counted(spark):
    df = _two_hot_users(spark)
    free = train_rows(df, as_of=AS_OF, tz="UTC", checkpoint=False, max_events=None, max_rows=None, min_strong=1).collect()
    assert {"ok", "hot1", "hot2"} == {r.userid for r in free}
    counts = {r.rule: r.n for r in removed_counts(df, as_of=AS_OF, tz="UTC", checkpoint=False, max_events=2000, max_rows=2).collect()}
    kept = train_rows(df, as_of=AS_OF, tz="UTC", checkpoint=False, max_events=2000, max_rows=None).collect()
    assert counts["under_cap"] == 2 and counts["max_rows"] == sum(r.r > 2 for r in kept) > 0


def test_all_blank_pool_and_short_pool(spark):
    # x1, x2 positives; pool of three blanked weak slots -> x1 alone, with no negatives
    ev = [("u", "x1", 1000, 1), ("u", "x2", 999, 1)]
    for i, b in enumerate(("b1", "b2", "b3")):
        ev += [("u", b, 900 - i, 0), ("u", b, 10 + i, 3)]
    got = [g for g in sample(spark, ev) if g[2].startswith("x")]
    assert got == [("u", 1, "x1", ())] and sample(spark, ev) == sequential(ev)
    # fewer than three pool entries -> no row at all
    ev2 = [("u", "x1", 1000, 1), ("u", "n1", 900, 4), ("u", "w1", 800, 0)]
    assert sample(spark, ev2) == [] == sequential(ev2)
