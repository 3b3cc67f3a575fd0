import datetime as dt
import gzip
import json
import os

from pyspark.sql import functions as F

from clickweave.plans.jobs import (
    click_extract_job, enrich_job, extract_job, history_job, normalise_job, training_job,
)


def _gz(path, recs):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt") as f:
        f.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in recs) + "\n")


def _read(spark, path):
    return sorted(r.value for r in spark.read.text(path).collect())


def _click(u, d, day, h, app="oppobrowser", ev="clickDoc"):
    return {"userid": u, "appid": app, "type": "click",
            "click": {"event": ev, "docid": d, "date": f"2024-01-{day:02d} {h:02d}:00:00", "details": {"dwell": "9"}},
            "view": {"channelType": "selected", "details": {"mashtype": "profile", "pos": "2"}}}


def test_log_jobs_round_trip(spark, tmp_dir):
    base = os.path.join(tmp_dir, "raw")
    _gz(f"{base}/2024-01-01/23/a.gz", [_click("u1", "d1", 1, 23), _click("u2", "d2", 1, 23, app="vivobrowser")])
    _gz(f"{base}/2024-01-02/00/a.gz", [_click("u1", "d3", 2, 0), "{bad"])
    _gz(f"{base}/2024-01-02/05/a.gz", [_click("u3", "d4", 2, 5, app="vivobrowser")])

    m = normalise_job(spark, f"{base}/*/*/*", f"{tmp_dir}/norm")
    assert m == {"events": 4, "quarantined": 1}
    assert len(_read(spark, f"{tmp_dir}/norm/kind=events")) == 4
    assert _read(spark, f"{tmp_dir}/norm/kind=quarantine") == ["bad_json\t{bad"]
    assert normalise_job(spark, f"{base}/*/*/*", f"{tmp_dir}/norm2", with_quarantine=False) == {"events": 4}

    click_extract_job(spark, f"{base}/*/*/*", f"{tmp_dir}/clicks", run="2024-01", reducers=2)
    assert _read(spark, f"{tmp_dir}/clicks/run=2024-01") == ["u1\td1\tclickDoc:9\t2", "u1\td3\tclickDoc:9\t2"]

    history_job(spark, f"{base}/*/*/*", f"{tmp_dir}/hist", min_clicks=2, num_files=1)
    assert _read(spark, f"{tmp_dir}/hist") == ["u1\td3 2024-01-02 00:00:00 d1 2024-01-01 23:00:00"]

    assert extract_job(spark, base, "2024-01-01-23", "2024-01-02-04", f"{tmp_dir}/viv", num_files=3) == {
        "lines": 1, "bad_lines": 1, "missing_hours": [f"2024-01-02-0{h}" for h in range(1, 5)]}
    got = [json.loads(v)["userid"] for v in _read(spark, f"{tmp_dir}/viv")]
    assert got == ["u2"]


def test_training_job(spark, tmp_dir):
    lines = []
    t0 = 1704067200
    for i in range(60):  # one user, 20 days, strong and weak events
        ts = t0 + i * 8 * 3600
        ev = ["clk", "vw", "vw", "dlk", "shr"][i % 5]
        d = dt.datetime.fromtimestamp(ts, dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        lines.append(f"u\td{i % 17}\t{ev}\t{d}\tapp_oppo")
    os.makedirs(f"{tmp_dir}/tsv")
    with open(f"{tmp_dir}/tsv/part-0", "w") as f:
        f.write("\n".join(lines) + "\n")
    with open(f"{tmp_dir}/tsv/part-1", "w") as f:
        f.write("u\td1\tclk\nu\td1\tzzz\t2024-01-01 00:00:00\tx\nu\td1\tclk\t2024-1-1 9:00:00\tx\n"
                "u\td1\tclk\t2010-01-01 00:00:00\tx\n")
    counts = training_job(spark, f"{tmp_dir}/tsv", f"{tmp_dir}/train", as_of="2024-01-22 00:00:00", tz="UTC", num_files=4,
                 min_strong=5)
    assert counts == {"lines": 64, "too_short": 1, "no_weight": 1, "bad_date": 1, "too_early": 1}
    rows = _read(spark, f"{tmp_dir}/train")
    assert rows and all(r.startswith("u\t") for r in rows)
    assert len([f for f in os.listdir(f"{tmp_dir}/train") if f.endswith(".gz")]) == 4


def test_enrich_job_update_and_insert(spark, tmp_dir):
    root = os.path.join(tmp_dir, "docs")
    _gz(f"{root}/2017-06-01/00/a.gz", [{"_id": "1", "ctype": "news", "body": "x"}, {"_id": "2", "ctype": "video"}])
    _gz(f"{root}/2017-06-02/00/a.gz", [{"_id": "3"}, {"body": "no id"}])
    store = spark.createDataFrame([("1",), ("2",), ("9",)], "_id string").select(
        "_id", F.lit(None).cast("array<array<string>>").alias("htc_key"),
        F.lit(None).cast("array<array<double>>").alias("htc_value"))

    def scorer(batch):
        return [{"htc_key": [["k"], []], "htc_value": [[1.0], []]} for _ in batch]

    enriched = enrich_job(spark, [root], "2017-06-01", "2017-06-02", scorer, store, f"{tmp_dir}/snap1")
    assert sorted(r._id for r in enriched.collect()) == ["1", "3"]
    snap = {r._id: r for r in spark.read.parquet(f"{tmp_dir}/snap1").collect()}
    assert set(snap) == {"1", "2", "9"} and snap["1"].updated and not snap["2"].updated
    enrich_job(spark, [root], "2017-06-01", "2017-06-02", scorer, store, f"{tmp_dir}/snap2", mode="insert")
    assert sorted(r._id for r in spark.read.parquet(f"{tmp_dir}/snap2").collect()) == ["1", "2", "3", "9"]


def test_balanced_outputs_without_fixed_count(spark, tmp_dir):
    from clickweave.operators.training import shuffle_rows
    from clickweave.sinks import write_text

    df = spark.range(5000).selectExpr("cast(id as string) as value")
    write_text(df, f"{tmp_dir}/bal", balance=True)
    assert spark.read.text(f"{tmp_dir}/bal").count() == 5000
    assert shuffle_rows(df, None, seed=3).count() == 5000


def _store(spark):
    return spark.createDataFrame(
        [("1", [["old"], []], [[7.0], []]), ("9", [["old"], []], [[8.0], []])],
        "_id string, htc_key array<array<string>>, htc_value array<array<double>>")


def test_failing_scorer_leaves_the_store_unchanged(spark, tmp_dir):
    root = os.path.join(tmp_dir, "docs")
    _gz(f"{root}/2017-06-01/00/a.gz", [{"_id": "1", "body": "x"}, {"_id": "3"}, {"body": "no id"}, "{bad"])

    def scorer(batch):
        raise RuntimeError("service down")

    before = sorted(map(tuple, _store(spark).collect()))
    for mode in ("update", "insert"):
        out = enrich_job(spark, [root], "2017-06-01", "2017-06-01", scorer, _store(spark), f"{tmp_dir}/{mode}", mode=mode,
                         rejects=f"{tmp_dir}/{mode}-rejects", on_error="line")
        assert {r.status for r in out.collect()} == {"error"}
        snap = spark.read.parquet(f"{tmp_dir}/{mode}").select("_id", "htc_key", "htc_value")
        assert sorted(map(tuple, snap.collect())) == before
        assert [x.split("\t")[0] for x in _read(spark, f"{tmp_dir}/{mode}-rejects")] == ["bad_json", "missing_id"]


def test_repeated_ids_change_one_row(spark, tmp_dir):
    root = os.path.join(tmp_dir, "docs")
    _gz(f"{root}/2017-06-01/00/a.gz", [{"_id": "1"}, {"_id": "3"}])
    _gz(f"{root}/2017-06-02/00/a.gz", [{"_id": "1"}, {"_id": "3"}])

    def make():
        return lambda batch: [{"htc_key": [["new"], []], "htc_value": [[1.0], []]} for _ in batch]

    for mode, ids in (("update", ["1", "9"]), ("insert", ["1", "3", "9"])):
        enrich_job(spark, [root], "2017-06-01", "2017-06-02", None, _store(spark), f"{tmp_dir}/{mode}", mode=mode, make_scorer=make)
        assert sorted(r._id for r in spark.read.parquet(f"{tmp_dir}/{mode}").collect()) == ids


def test_mistyped_path_raises_and_keeps_the_output(spark, tmp_dir):
    import pytest

    base = os.path.join(tmp_dir, "raw")
    _gz(f"{base}/2024-01-01/23/a.gz", [_click("u1", "d1", 1, 23)])
    normalise_job(spark, f"{base}/*/*/*", f"{tmp_dir}/norm", with_quarantine=False)
    kept = _read(spark, f"{tmp_dir}/norm")
    for bad in (f"{base}x/*/*/*", [f"{base}/*/*/*", f"{base}x/*/*/*"]):
        with pytest.raises(FileNotFoundError):
            normalise_job(spark, bad, f"{tmp_dir}/norm", with_quarantine=False)
    with pytest.raises(FileNotFoundError):
        extract_job(spark, base, "2025-01-01-00", "2025-01-01-05", f"{tmp_dir}/norm")
    assert _read(spark, f"{tmp_dir}/norm") == kept and len(kept) == 1


def test_enrich_job_keeps_the_row_of_the_stated_day(spark, tmp_dir):
    from clickweave.plans.jobs import enrich_job

    # the features of the old day sort above those of the new one
    for day, text in (("2024-01-01", "zzz old"), ("2024-01-02", "a new"), ("2024-01-03", "m newest")):
        os.makedirs(f"{tmp_dir}/docs/{day}/00")
        with open(f"{tmp_dir}/docs/{day}/00/part.json", "w") as f:
            f.write(json.dumps({"_id": "1", "t": text}) + "\n" + (json.dumps({"_id": "2", "t": text}) + "\n" if day < "2024-01-03" else ""))
    store = spark.createDataFrame([("1", [["old"]], [[0.0]]), ("2", [["old"]], [[0.0]])],
                                  "_id string, htc_key array<array<string>>, htc_value array<array<double>>")

    def scorer(batch):
        return [{"htc_key": [[json.loads(x)["t"]]], "htc_value": [[1.0]]} for x in batch]

    for prefer, want in (("newest", {"1": "m newest", "2": "a new"}), ("oldest", {"1": "zzz old", "2": "zzz old"})):
        for mode in ("update", "insert"):
            target = store if mode == "update" else store.limit(0)
            seen = enrich_job(spark, [f"{tmp_dir}/docs"], "2024-01-01", "2024-01-03", scorer, target,
                              f"{tmp_dir}/{prefer}-{mode}", mode=mode, prefer=prefer)
            got = {r._id: r.htc_key[0][0] for r in spark.read.parquet(f"{tmp_dir}/{prefer}-{mode}").collect()}
            assert got == want, (prefer, mode)
            assert sorted((str(r.day), r.file) for r in seen.collect())[0] == ("2024-01-01", "/00/part.json")
