"""Plan-shape checks: what the optimizer does with our operators."""

import re

from clickweave.operators import click_extract, normalise_events, train_rows, user_history
from clickweave.operators.history import active_user_clicks
from clickweave.sources.events_tsv import prepare_training_events


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def sample_lines(lines):
    recs = []
    for i in range(40):
        recs.append({"userid": f"u{i % 4}", "appid": "oppobrowser", "type": "click",
                     "click": {"event": "clickDoc", "docid": f"d{i % 7}", "date": f"2024-01-{1 + i % 20:02d} 10:00:00",
                               "details": {"dwell": "12"}},
                     "view": {"channelType": "selected", "details": {"mashtype": "profile", "pos": "1"}}})
    return lines(recs)


def test_json_parsed_once_and_no_python(lines):
    df = sample_lines(lines)
    for q in (normalise_events(df), click_extract(df)):
        p = plan(q)
        parsing = [x for x in p.splitlines() if "from_json" in x]
        # one place that parses, and there one parse before the branch for lines that do not fit the types
        assert len(parsing) == 1 and parsing[0].split("CASE WHEN")[0].count("from_json") == 1, p
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_semi_join_and_window_limit(lines):
    df = sample_lines(lines)
    p = df.sparkSession.createDataFrame([], "x int")  # noqa: F841
    assert "LeftSemi" in plan(active_user_clicks(df, min_clicks=1))
    hp = plan(user_history(df, min_clicks=1, k=3, checkpoint=False))
    assert "LeftSemi" in hp and "WindowGroupLimit" in hp


def test_sampler_windows_share_one_user_exchange(lines):
    ev = prepare_training_events(normalise_events(sample_lines(lines)), tz="UTC", floor=None)
    p = plan(train_rows(ev, as_of="2024-01-31 00:00:00", tz="UTC", min_strong=1))
    above_windows, below = p.split("Window [", 1)
    # the final assembly and both windows run without any further shuffle ...
    assert "Exchange" not in above_windows and "Window [" in below
    # ... on the single exchange by userid that feeds the windows
    first_exchange = re.search(r"Exchange (\w+)\(([^,)]*)", below)
    assert first_exchange.group(1) == "hashpartitioning" and first_exchange.group(2).startswith("userid")
    assert "BatchEvalPython" not in p


def test_a_file_of_one_row_group_is_spread(spark, tmp_dir):
    """Splits by bytes that hold no row group are no spread."""
    from pyspark.sql import functions as F

    from clickweave.plans.adapter import load

    spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v")).coalesce(1).write.parquet(f"{tmp_dir}/t.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = load(spark, tmp_dir, "t")
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sum(sizes) == 20_000 and len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) < 6_000
    assert load(spark, tmp_dir, "t", spread=False).count() == 20_000


def test_a_line_is_read_once_for_all_its_rules(spark, tmp_dir):
    """Neither the line, its fields nor its date are worked out once per rule, and both readings share a scan."""
    from pyspark.sql import functions as F

    from clickweave.functions.columns import evaluate_once
    from clickweave.plans.queries import q_events_tsv_odd
    from clickweave.sources.events_tsv import parse_events_tsv, tsv_reject_reason

    rows = [(None,), ("u\td",), ("u\td\tzzz\t2024-02-03 04:05:06\tp",), ("u\td\tclk\tsoon\tp",), ("u\td\tclk\t2024-02-03 4:5:6\tp",),
            ("u\td\tclk\t2024-13-03 04:05:06\tp",), ("u\td\tclk\t2001-01-01 00:00:00\tp",), ("u\td\tclk\t2024-02-03 04:05:06\tp",)]
    lines = spark.createDataFrame(rows, "value string").repartition(1)
    wanted = {False: ["no_weight", "too_short", "no_weight", "bad_date", "bad_date", "bad_date", "too_early", None],
              True: ["no_weight", "too_short", "no_weight", "bad_date", None, None, "too_early", None]}
    for lenient, want in wanted.items():
        reason = tsv_reject_reason(tz="UTC", floor="2024-01-10 12:00:00", lenient=lenient)
        assert [r[0] for r in spark.createDataFrame(rows, "value string").coalesce(1).select(reason).collect()] == want
        kept = lines.select(evaluate_once(reason).alias("reason")).filter("reason is not null")
        assert plan(kept).count("split(") == 1 and plan(kept).count("regexp_extract(") == (6 if lenient else 0)
    assert plan(parse_events_tsv(lines)).count("split(") == 1

    events = "select id as event_id, id as user_id, timestamp'2024-01-09 00:00:00' + make_dt_interval(0, id) as ts from range(80)"
    spark.sql(events).write.parquet(f"{tmp_dir}/events.parquet")
    out = q_events_tsv_odd(spark, tmp_dir)
    physical = plan(out)
    assert physical.count("FileScan") == 1 and physical.count("yesterday") == 1 and physical.count("regexp_extract(") == 6
    n = {(r.lenient, r.reason): r.n for r in out.collect()}
    assert n[False, "too_short"] == n[True, "too_short"] == 10 and n[True, "bad_date"] == 10 and n[True, "too_early"] > n[False, "too_early"]


def test_calls_that_wait_are_dealt_in_equal_shares(spark, tmp_dir, monkeypatch):
    """Files one more than the task slots, or of unequal size, are no tasks of their own."""
    from pyspark.sql import functions as F

    from clickweave.plans import adapter, queries

    slots = spark.sparkContext.defaultParallelism
    n = 1000 * (slots + 1)
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit("web").alias("source"), F.lit("a text").alias("text"))
    docs.repartitionByRange(slots + 1, "doc_id").write.parquet(f"{tmp_dir}/documents.parquet")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a split for each file
    try:
        assert queries._docs(spark, tmp_dir).rdd.getNumPartitions() > slots
        assert queries.q_doc_score_stalls(spark, tmp_dir).rdd.getNumPartitions() == slots
        monkeypatch.setattr(adapter, "DOCS_PER_TASK", 500)
        assert queries.q_doc_score_stalls(spark, tmp_dir).rdd.getNumPartitions() == 2 * (slots + 1) // slots * slots
        shares = adapter.in_equal_shares(queries._docs(spark, tmp_dir), n).groupBy(F.spark_partition_id()).count()
        sizes = [r["count"] for r in shares.collect()]
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sum(sizes) == n and max(sizes) - min(sizes) <= slots + 1
