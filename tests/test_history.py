from clickweave.operators import active_user_clicks, active_users, user_history


def click(u, doc, date, event="clickDoc", details=True):
    c = {"event": event, "docid": doc, "date": date}
    if details:
        c["details"] = {"dwell": "10"}
    return {"userid": u, "appid": "oppo", "click": c}


def test_history_keeps_latest_per_doc(lines):
    df = lines([click("u", "a", "2024-01-01 00:00:03"), click("u", "b", "2024-01-01 00:00:02"),
                click("u", "a", "2024-01-01 00:00:01")])
    (r,) = user_history(df, min_clicks=1, k=20, checkpoint=False).collect()
    assert r.items == "a 2024-01-01 00:00:03 b 2024-01-01 00:00:02" and r.n_items == 2


def test_threshold_counts_repeats_and_k_limit(lines):
    recs = [click("u", f"d{i:02d}", f"2024-01-01 00:00:{i:02d}") for i in range(25)]
    recs += [click("v", "x", "2024-01-01 00:00:00")] * 3
    recs += [click("w", "x", "2024-01-01 00:00:00", event="like")] * 30      # not clickDoc
    recs += [click("z", "x", "2024-01-01 00:00:00", details=False)] * 30     # no details -> not counted
    df = lines(recs)
    assert {r.userid: r.n_clicks for r in active_users(df, min_clicks=3).collect()} == {"u": 25, "v": 3}
    rows = {r.userid: r for r in user_history(df, min_clicks=20, k=20, checkpoint=False).collect()}
    assert set(rows) == {"u"} and rows["u"].n_items == 20
    assert rows["u"].items.split(" ")[0] == "d24"


def test_active_user_without_dated_click_has_no_history(lines):
    recs = [{"userid": "u", "click": {"event": "clickDoc", "details": {}}}] * 3
    df = lines(recs)
    assert active_users(df, min_clicks=3).count() == 1
    assert active_user_clicks(df, min_clicks=3).count() == 0
    assert user_history(df, min_clicks=3, checkpoint=False).count() == 0
