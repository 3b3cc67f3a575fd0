from clickweave.operators import (
    app_log_extract, click_events, click_extract, normalise_events, platform_classify, quarantine_events,
    view_events,
)
from clickweave.operators.parse import parse_raw


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


V3 = [{"docid": "d1", "date": "2024-01-01 00:00:03"},
      {"docid": "d2", "date": "2024-01-01 00:00:02"},
      {"docid": "d3", "date": "2024-01-01 00:00:01"}]


def test_views_win_over_click(lines):
    df = lines([{"userid": "u", "appid": "oppo", "views": V3,
                 "click": {"event": "clickDoc", "docid": "x", "date": "d", "details": {"dwell": "3"}}}])
    out = normalise_events(df)
    assert rows(out, "userid", "docid", "event", "platform") == [
        ("u", "d1", "vw", "app_oppo"), ("u", "d2", "vw", "app_oppo"), ("u", "d3", "vw", "app_oppo")]


def test_every_second_keeps_index_one_and_quarantines_odd(lines):
    df = lines([{"userid": "u", "appid": "oppo", "views": V3}])
    assert rows(view_events(df, every_second=True), "docid") == [("d2",)]
    q = quarantine_events(df, every_second=True).collect()
    assert [r.reason for r in q] == ["odd_views"]
    assert quarantine_events(df).count() == 0


def test_platforms(lines):
    df = lines([{"userid": "u", "appid": a} for a in ("apple", "xiaomi", "oppobrowser", "mibrowser", "vivobrowser")])
    got = dict(rows(platform_classify(parse_raw(df, "userid", "appid")), "appid", "platform"))
    assert got == {"apple": "app_apple", "xiaomi": "app_xiaomi", "oppobrowser": "oppobrowser",
                   "mibrowser": "mibrowser", "vivobrowser": "other_vivobrowser"}


def test_click_codes_and_quarantine(lines):
    recs = [
        {"userid": "u", "appid": "oppo", "click": {"event": ev, "docid": "d", "date": "t", "details": {"dwell": 5}}}
        for ev in ("clickDoc", "viewComment", "shareDoc", "like", "dislike", "addComment", "play")
    ] + [
        {"userid": "u", "appid": "oppo", "click": {"event": "clickDoc", "docid": "d", "date": "t"}},
        {"userid": "u", "appid": "oppo", "click": {"event": "clickDoc", "docid": "d", "date": "t",
                                                   "details": {"dwell": "n/a"}}},
        {"userid": "u", "click": {"event": "like", "docid": "d", "date": "t"}},
        {"appid": "oppo", "click": {"event": "like", "docid": "d", "date": "t"}},
        {"userid": "u", "appid": "oppo", "click": {"event": "like", "date": "t"}},
        '{"userid": "u", bad json',
        "",
    ]
    df = lines(recs)
    assert [r.event for r in click_events(df).orderBy("event").collect()] == sorted(
        ["clk", "vc", "shr", "lk", "dlk", "ac", "None"])
    assert rows(click_events(df, drop_unknown=True), "event") == sorted(
        [(e,) for e in ["clk", "vc", "shr", "lk", "dlk", "ac"]])
    reasons = sorted(r.reason for r in quarantine_events(df).collect())
    # the empty line is not JSON either
    assert reasons == sorted(["bad_dwell", "bad_dwell", "missing_appid", "missing_userid", "missing_docid",
                              "bad_json", "bad_json"])


def test_min_dwell_and_compound_options(lines):
    recs = [{"userid": "u", "appid": "oppo", "click": {"event": "clickDoc", "docid": d, "date": "t",
                                                       "details": {"dwell": w}}}
            for d, w in (("a", "3"), ("b", "9"), ("c_1", "20"), ("e", "0"))]
    df = lines(recs)
    assert rows(click_events(df), "docid") == [("a",), ("b",), ("c_1",), ("e",)]
    assert rows(click_events(df, min_dwell=True, drop_compound=True), "docid") == [("b",), ("e",)]


def _ce(**kw):
    base = {"userid": "u", "appid": "oppobrowser",
            "click": {"docid": "d", "event": "clickDoc", "details": {"dwell": "12"}},
            "view": {"channelType": "selected", "details": {"mashtype": "profile", "pos": "3"}}}
    for k, v in kw.items():
        if v is None:
            base.pop(k, None)
        else:
            base[k] = v
    return base


def test_click_extract_cases(lines):
    recs = [
        _ce(),                                                      # -> u d clickDoc:12 3
        _ce(click={"docid": "d2", "event": "clickDoc"}),            # dwell missing -> none
        _ce(click={"docid": "d3", "event": "like"}),                # -> u d3 like 3
        _ce(type="views"),                                          # views record -> none
        _ce(type="click", click={"docid": "d4", "event": "play", "details": {"dwell": "7"}}),
        _ce(appid="oppo"),                                          # other app -> none
        _ce(view={"channelType": "hot", "details": {"mashtype": "profile", "pos": "1"}}),
        _ce(view={"channelType": "selected", "details": {"mashtype": "feed", "pos": "1"}}),
        _ce(view={"channelType": "selected", "details": {"mashtype": "profile"}}),
        _ce(view=None),
    ]
    out = rows(click_extract(lines(recs)), "userid", "docid", "event", "pos")
    assert out == [("u", "d", "clickDoc:12", "3"), ("u", "d3", "like", "3"), ("u", "d4", "play:7", "3")]


def test_app_log_extract_keeps_line_unchanged(lines):
    recs = ['{"appid":"vivobrowser","x":1}', '{"appid":"oppo"}', '{"x":2}', "{bad", '{"appid":"vivobrowser"}']
    out = sorted(r.value for r in app_log_extract(lines(recs)).collect())
    assert out == sorted(['{"appid":"vivobrowser"}', '{"appid":"vivobrowser","x":1}'])


def test_click_extract_sorted_partitions_by_user(lines):
    from pyspark.sql import functions as F

    from clickweave.operators import click_extract_sorted

    recs = [_ce(userid=f"u{i % 13}", click={"docid": f"d{i}", "event": "like"}) for i in range(200)]
    out = click_extract_sorted(lines(recs), reducers=5).select("userid", F.spark_partition_id().alias("p"))
    rows = out.collect()
    assert len(rows) == 200 and len({r.p for r in rows}) <= 5
    owner = {}
    for r in rows:
        assert owner.setdefault(r.userid, r.p) == r.p  # one partition per user
    for p in {r.p for r in rows}:
        users = [r.userid for r in rows if r.p == p]
        assert users == sorted(users)  # sorted inside each partition


def test_mistyped_fields(lines):
    recs = [
        _ce(click={"docid": "d1", "event": "like", "details": "None"}),       # kept by click extraction
        _ce(click={"docid": "d2", "event": "clickDoc", "details": "None"}),   # no dwell -> no row
        "[1]",                                                                 # not an object
        {"userid": "u", "appid": "oppo", "views": 5, "click": {"event": "like", "docid": "d", "date": "t"}},
    ]
    df = lines(recs)
    assert rows(click_extract(df), "docid", "event") == [("d1", "like")]
    reasons = sorted(r.reason for r in quarantine_events(df).collect())
    assert reasons == ["bad_json", "bad_shape", "bad_shape", "bad_shape"]
    assert normalise_events(df).count() == 0


def test_single_pass_normalise_with_quarantine_equals_separate_outputs(lines):
    from clickweave.operators.normalise import normalise_with_quarantine, render_tsv

    recs = [{"userid": "u", "appid": "oppo", "views": V3},
            {"userid": "u", "appid": "mibrowser", "click": {"event": "like", "docid": "d", "date": "t"}},
            {"userid": "u", "click": {"event": "like", "docid": "d", "date": "t"}}, "{bad"]
    for es in (False, True):
        df = lines(recs)
        both = normalise_with_quarantine(df, every_second=es).collect()
        ev = sorted(r.value for r in both if r.kind == "events")
        q = sorted(r.value for r in both if r.kind == "quarantine")
        assert ev == sorted(r.value for r in render_tsv(normalise_events(df, every_second=es)).collect())
        assert q == sorted(f"{r.reason}\t{r.value}" for r in quarantine_events(df, every_second=es).collect())


def test_only_the_fields_in_use_are_judged(lines):
    good = {"docid": "d1", "date": "t"}
    recs = [
        {"userid": "a", "appid": "oppo", "views": [good], "click": "x"},
        {"userid": "b", "appid": "oppo", "views": [good, "oops", {"docid": "d3", "date": "t"}]},
        {"userid": "c", "appid": "oppo", "views": [7]},
        {"userid": "d", "appid": "oppo", "views": {"docid": "d1"}},
        {"userid": "e", "appid": "oppo", "click": "x"},
        {"userid": "f", "appid": "oppo", "click": {"event": "like", "docid": "d9", "date": "t", "details": "none"}},
        {"userid": "g", "appid": "oppo", "views": []},
    ]
    df = lines(recs)
    assert rows(normalise_events(df), "userid", "docid") == [("a", "d1"), ("b", "d1")]
    import json

    got = sorted((json.loads(r.value)["userid"], r.reason) for r in quarantine_events(df).collect())
    assert got == [("b", "bad_view"), ("c", "bad_view"), ("d", "bad_shape"), ("e", "bad_shape"), ("f", "bad_shape")]
