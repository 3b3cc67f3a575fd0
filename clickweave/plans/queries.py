"""Registered end-to-end queries: each takes (spark, sf_dir) and returns a DataFrame.

Inputs are the driver tables, turned into the reference's shapes by
:mod:`clickweave.plans.adapter`; every query runs over whole tables.
Column names match :mod:`clickweave.plans.oracles`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickweave.functions import strings as S
from clickweave.functions.columns import evaluate_once
from clickweave.functions.time import epoch_seconds, parse_wall_clock
from clickweave.operators import (
    active_user_clicks, active_users, app_log_extract, click_events, click_extract, click_extract_ranged, click_extract_sorted,
    doc_enrich, doc_filter, doc_records, has_key, insert_new, key_states, negative_pool, permute_rows, scored_features, status_counts, normalise_events, parse_raw,
    platform_classify, qualified_doc_labels, qualified_users, quarantine_events, render_tsv,
    shuffle_rows, train_rows, update_matched, user_history, user_stats, view_events, with_position,
)
from clickweave.operators.training import removed_counts, user_rules
from clickweave.plans import adapter as A
from clickweave.plans import jobs
from clickweave.plans.materialize import materialized
from clickweave.session import work_path
from clickweave.sinks import compact_by_size, compact_files, write_text, write_tsv
from clickweave.sinks.store import bucket_of, create_store, read_store, update_store
from clickweave.sources import hour_range_scan, read_text_lines, scan_doc_days, scan_events_tsv, union_logs
from clickweave.sources.events_tsv import parse_events_tsv, prepare_training_events, tsv_reject_reason

# parameters of the registered runs (driver data: UTC wall clock, January 2024)
TZ = "UTC"
AS_OF = "2024-01-31 00:00:00"
MIN_CLICKS = 10
HISTORY_K = 20
#: Thresholds under which each training rule rejects some users, and both limits cut.
TIGHT = {"min_strong": 12, "recent_days": 2, "settle_days": 28, "min_span_days": 27, "max_events": 80}
TIGHT_CAP, TIGHT_ROWS = 80, 3
#: Lines at most in a gzip file of the built trees (a gzip file is one task).
LINES_PER_FILE = 500_000
LATE_FLOOR = "2024-01-10 12:00:00"
RANGE_A = ("2024-01-03-22", "2024-01-06-01")
UNION_A = ("2024-01-02-00", "2024-01-04-23")
UNION_B = ("2024-01-04-00", "2024-01-05-12")
DOC_SPAN = ("2017-06-01", "2018-03-08")
VERSION_SPAN = ("2017-06-01", "2017-12-31")
#: Time limit of a scorer's call: far above what a call takes, so that only stalled ones reach it.
STALL_SECONDS = 5.0
STORE_BUCKETS, PERMUTED_FILES = 64, 10
#: Byte limit of compacted files, and the longest line (a cut falls behind the line that crosses the limit).
COMPACT_BYTES, LINE_BYTES = 64 << 10, 200
HIVE_DAY, HIVE_HOUR = "day={day}", "hour={hour}"


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    """The whole raw log as gzip files of bounded size, like production's
    ~200 MB files; hour-range queries read the day/hour tree instead."""
    return read_text_lines(spark, f"{_raw_flat(spark, sf)}/*", gz_only=True)


def _raw_flat(spark, sf):
    def write(path):
        rec = A.raw_record(A.load(spark, sf, "events")).select("value")
        write_text(rec, path, compression="gzip", max_records_per_file=LINES_PER_FILE)

    return materialized(spark, sf, "raw-log-flat", ("events",), write)


def _normalised(spark: SparkSession, sf: str) -> DataFrame:
    return normalise_events(_lines(spark, sf))


def _weighted(spark: SparkSession, sf: str) -> DataFrame:
    return prepare_training_events(_normalised(spark, sf), tz=TZ)


def _parsed_view(lines: DataFrame) -> DataFrame:
    p = parse_raw(lines, "userid", "appid", "type")
    return p.select(
        F.when(~F.col("_bad"), F.col("userid")).alias("userid"),
        F.when(~F.col("_bad"), F.col("appid")).alias("appid"),
        F.when(~F.col("_bad"), F.col("type")).alias("type"),
    )


# --- parse & normalise -------------------------------------------------------

def q_parse_raw(spark, sf):
    p = parse_raw(_lines(spark, sf))
    return p.filter(~F.col("_bad")).select(
        "userid",
        "appid",
        "type",
        F.when(F.col("views").isNotNull(), F.size("views")).alias("n_views"),
        F.col("click.event").alias("click_event"),
        F.col("click.docid").alias("click_docid"),
        F.col("click.details.dwell").alias("dwell"),
        F.col("view.channelType").alias("channel"),
        F.col("view.details.mashtype").alias("mashtype"),
        F.col("view.details.pos").alias("pos"),
    )


def q_platform_classify(spark, sf):
    return platform_classify(parse_raw(_lines(spark, sf), "userid", "appid"))


def q_view_events(spark, sf):
    return view_events(_lines(spark, sf))


def q_view_events_alternate(spark, sf):
    return view_events(_lines(spark, sf), every_second=True)


def q_click_events(spark, sf):
    return click_events(_lines(spark, sf))


def q_click_events_min_dwell(spark, sf):
    return click_events(_lines(spark, sf), min_dwell=True, drop_compound=True)


def q_normalise_events(spark, sf):
    return _normalised(spark, sf)


def q_quarantine_events(spark, sf):
    return quarantine_events(_lines(spark, sf)).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def q_quarantine_rows(spark, sf):
    """Every rejected record of a log with mistyped fields: user, number and reason, row by row."""
    q = quarantine_events(A.odd_records(spark, sf), every_second=True)
    return q.select(F.regexp_extract("value", '"n":"([0-9]+)"', 1).cast("long").alias("event_id"), "reason")


def q_odd_events(spark, sf):
    """The rows that the same log still yields."""
    return normalise_events(A.odd_records(spark, sf))


def q_click_extract(spark, sf):
    return click_extract(_lines(spark, sf))


def q_click_extract_sorted(spark, sf):
    return click_extract_sorted(_lines(spark, sf))


def q_app_log_extract(spark, sf):
    kept = app_log_extract(_lines(spark, sf))
    p = parse_raw(kept, "userid", "appid", "type", "views", "click")
    return p.select(
        "userid",
        "appid",
        "type",
        F.when(F.col("views").isNotNull(), F.size("views")).alias("n_views"),
        F.col("click.event").alias("click_event"),
    )


# --- history -----------------------------------------------------------------

def q_active_users(spark, sf):
    return active_users(_lines(spark, sf), min_clicks=MIN_CLICKS)


def q_active_user_clicks(spark, sf):
    return active_user_clicks(_lines(spark, sf), min_clicks=MIN_CLICKS)


def q_user_history(spark, sf):
    return user_history(_lines(spark, sf), min_clicks=MIN_CLICKS, k=HISTORY_K)


# --- training ----------------------------------------------------------------

def _events_tsv_dir(spark, sf):
    def write(path):
        write_text(render_tsv(_normalised(spark, sf)), path, compression="gzip")

    return materialized(spark, sf, "events-tsv-v2", ("events",), write)


def q_scan_events_tsv(spark, sf):
    return scan_events_tsv(spark, _events_tsv_dir(spark, sf), tz=TZ)


def q_event_weights(spark, sf):
    return _weighted(spark, sf)


def q_user_stats(spark, sf):
    return user_stats(_weighted(spark, sf))


def q_qualified_users(spark, sf):
    return qualified_users(user_stats(_weighted(spark, sf)), as_of=AS_OF, tz=TZ)


def q_doc_labels(spark, sf):
    return qualified_doc_labels(_weighted(spark, sf), as_of=AS_OF, tz=TZ)


def q_negative_pool(spark, sf):
    return negative_pool(qualified_doc_labels(_weighted(spark, sf), as_of=AS_OF, tz=TZ))


def q_train_rows(spark, sf):
    return train_rows(_weighted(spark, sf), as_of=AS_OF, tz=TZ)


def q_user_rules(spark, sf):
    return user_rules(user_stats(_weighted(spark, sf)), as_of=AS_OF, tz=TZ, **TIGHT)


def q_train_rows_limited(spark, sf):
    return train_rows(_weighted(spark, sf), as_of=AS_OF, tz=TZ, max_rows=TIGHT_ROWS, max_events=TIGHT_CAP)


def q_train_removed(spark, sf):
    return removed_counts(_weighted(spark, sf), as_of=AS_OF, tz=TZ, max_rows=TIGHT_ROWS, max_events=TIGHT_CAP)


def q_event_weights_floor(spark, sf):
    return prepare_training_events(_normalised(spark, sf), tz=TZ, floor=LATE_FLOOR)


def q_train_rows_shuffled(spark, sf):
    return shuffle_rows(train_rows(_weighted(spark, sf), as_of=AS_OF, tz=TZ), num_partitions=100, seed=7)


def _hot_lines(spark, sf):
    """The raw log with a third of its records by one user."""
    def write(path):
        rec = A.raw_record(A.hot_events(A.load(spark, sf, "events"))).select("value")
        write_text(rec, path, compression="gzip", max_records_per_file=LINES_PER_FILE)

    return read_text_lines(spark, f"{materialized(spark, sf, 'raw-log-hot', ('events',), write)}/*", gz_only=True)


def q_train_rows_uncapped(spark, sf):
    """Training rows without either cap, where one user has a third of all events."""
    events = prepare_training_events(normalise_events(_hot_lines(spark, sf)), tz=TZ)
    return train_rows(events, as_of=AS_OF, tz=TZ, max_events=None, max_rows=None)


def q_click_extract_ranged(spark, sf):
    """Range-partitioned clicks of the log with the heavy user: each row's place through all partitions."""
    path = work_path(spark, "clicks-ranged", unique=True)
    rows = with_position(click_extract_ranged(_hot_lines(spark, sf), num_partitions=16))
    rows.write.parquet(path)  # the bounds are sampled: once
    at = spark.read.parquet(path)
    sizes = at.groupBy("partition").agg(F.count(F.lit(1)).alias("n"))  # a row a partition
    earlier = W.orderBy("partition").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("partition", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    placed = at.join(starts, "partition")
    return placed.select("userid", "docid", "event", "pos", (F.col("start") + F.col("position") + 1).alias("place"))


def q_train_rows_permuted(spark, sf):
    """Training rows in their seeded order: the partition and place of each, for two layouts of the input."""
    rows = train_rows(_weighted(spark, sf), as_of=AS_OF, tz=TZ)
    out = None
    for layout, given in (("given", rows), ("dealt", rows.repartition(13, "pos"))):
        placed = with_position(permute_rows(given, num_partitions=PERMUTED_FILES, seed=7)).withColumn("layout", F.lit(layout))
        out = placed if out is None else out.unionByName(placed)
    return out


# --- scans & sinks -------------------------------------------------------------

def _raw_tree(spark, sf):
    def write(path):
        # rows of an hour may come from many tasks: no hour is written by one task alone
        rec = A.raw_record(A.load(spark, sf, "events")).hint("rebalance", "day", "hour")
        write_text(rec, path, compression="gzip", partition_by=("day", "hour"), max_records_per_file=LINES_PER_FILE)

    return materialized(spark, sf, "raw-log-v2", ("events",), write)


def q_scan_raw_log(spark, sf):
    base = _raw_tree(spark, sf)
    return _parsed_view(read_text_lines(spark, f"{base}/*/*/*", gz_only=True))


def q_hour_range_scan(spark, sf):
    base = _raw_tree(spark, sf)
    return _parsed_view(hour_range_scan(spark, base, *RANGE_A, day_dir=HIVE_DAY, hour_dir=HIVE_HOUR))


def q_union_logs(spark, sf):
    from clickweave.sources.raw_log import hour_range_glob

    base = _raw_tree(spark, sf)
    globs = [hour_range_glob(base, *r, day_dir=HIVE_DAY, hour_dir=HIVE_HOUR) for r in (UNION_A, UNION_B)]
    return _parsed_view(union_logs(spark, globs))


def _doc_tree(spark, sf):
    def write(path):
        d = A.load(spark, sf, "documents")
        rec = A.doc_record(d.filter(F.col("lang") == "en")).hint("rebalance", "day")
        write_text(rec, f"{path}/documents_info", compression="gzip", partition_by=("day",), max_records_per_file=LINES_PER_FILE)
        rec = A.doc_record(d.filter(~(F.col("lang") == "en") | F.col("lang").isNull())).hint("rebalance", "day")
        write_text(rec, f"{path}/vertical_documents", compression="gzip", partition_by=("day",), max_records_per_file=LINES_PER_FILE)

    return materialized(spark, sf, "doc-days-v2", ("documents",), write)


def q_doc_scan_days(spark, sf):
    base = _doc_tree(spark, sf)
    lines = scan_doc_days(spark, [f"{base}/documents_info", f"{base}/vertical_documents"], *DOC_SPAN,
                          day_dir="day={day}", depth=1)
    rec = doc_records(lines)
    return rec.select("_id", "ctype", F.length(F.get_json_object("raw", "$.text")).alias("n_chars"))


def q_sink_tsv(spark, sf):
    def write(path):
        write_tsv(_normalised(spark, sf), path, compression="gzip", run="r1")

    path = materialized(spark, sf, "sink-tsv-v2", ("events",), write)
    lines = spark.read.text(path)  # run=<label> becomes a column
    f = F.split("value", "\t")
    return lines.select(*[f[i].alias(c) for i, c in enumerate(("userid", "docid", "event", "date", "platform"))],
                        F.col("run"))


def q_compact_files(spark, sf):
    def write(path):
        write_text(render_tsv(_normalised(spark, sf)), f"{path}/small", num_files=16)
        compact_files(spark, f"{path}/small", f"{path}/compact", num_files=3, compression="gzip")

    path = materialized(spark, sf, "compact-v2", ("events",), write)
    f = F.split("value", "\t")
    return spark.read.text(f"{path}/compact").select(
        *[f[i].alias(c) for i, c in enumerate(("userid", "docid", "event", "date", "platform"))]
    )


def q_compact_by_size(spark, sf):
    """The lines of files packed by size, and whether each file keeps to the limit and most are well filled."""
    def write(path):
        write_text(render_tsv(_normalised(spark, sf)), f"{path}/small", num_files=64)
        compact_by_size(spark, f"{path}/small", f"{path}/compact", target_bytes=COMPACT_BYTES)

    path = materialized(spark, sf, "compact-size", ("events",), write)
    f = F.split("value", "\t")
    size = F.col("_metadata.file_size")
    return spark.read.text(f"{path}/compact").select(
        *[f[i].alias(c) for i, c in enumerate(("userid", "docid", "event", "date", "platform"))],
        (size <= COMPACT_BYTES + LINE_BYTES).alias("fits"),
    )


def q_key_states(spark, sf):
    """What the probed keys hold, and whether they count as there under either policy."""
    states = key_states(A.probed_records(spark, sf), "views", "click", "click.docid", "click.event")
    return states.select(
        F.regexp_extract("value", '"n":"([0-9]+)"', 1).cast("long").alias("event_id"), "views", "click", "click_docid", "click_event",
        *(has_key(F.col(c), policy).alias(f"{c}_{policy}") for c in ("views", "click_docid") for policy in ("absent", "present")),
    )


def q_events_tsv_lenient(spark, sf):
    """Training events of lines whose dates are written in many ways, read leniently."""
    events = prepare_training_events(parse_events_tsv(A.lenient_tsv(spark, sf)), tz=TZ, floor=LATE_FLOOR, lenient=True)
    return events.select(F.col("docid").cast("long").alias("event_id"), "t")


def q_events_tsv_odd(spark, sf):
    """Why lines of the same table are dropped, read strictly and leniently."""
    reads = (F.struct(F.lit(x).alias("lenient"), tsv_reject_reason(tz=TZ, floor=LATE_FLOOR, lenient=x).alias("reason")) for x in (False, True))
    reasons = A.lenient_tsv(spark, sf).select(F.inline(F.array(*reads))).filter("reason is not null")
    return reasons.groupBy("reason", "lenient").agg(F.count(F.lit(1)).alias("n")).select("reason", "n", "lenient")


def q_scan_gz_only(spark, sf):
    """A tree in which plain text files stand beside the gzip ones: only the latter are read."""
    def write(path):
        lines = _lines(spark, sf)
        is_odd = F.crc32(F.col("value").cast("binary")) % 2 == 1
        write_text(lines.filter(~is_odd), path, compression="gzip", mode="append")
        write_text(lines.filter(is_odd), path, mode="append")

    path = materialized(spark, sf, "raw-log-mixed", ("events",), write)
    parts = [
        _parsed_view(read_text_lines(spark, f"{path}/*", gz_only=gz)).agg(F.count(F.lit(1)).alias("n")).withColumn("of", F.lit(of))
        for gz, of in ((True, "gz"), (False, "all"))
    ]
    odd = _lines(spark, sf).agg(F.count_if(F.crc32(F.col("value").cast("binary")) % 2 == 1).alias("n")).withColumn("of", F.lit("odd"))
    counts = parts[0].unionByName(parts[1]).unionByName(odd)
    one = counts.agg(*(F.max(F.when(F.col("of") == k, F.col("n"))).alias(k) for k in ("gz", "all", "odd")))
    return one.select((F.col("gz") + F.col("odd") == F.col("all")).alias("gz_is_the_rest"), F.col("all").alias("n_lines"), (F.col("gz") < F.col("all")).alias("fewer"))


def q_sink_overwrite(spark, sf):
    """A single-file output written twice: the second run replaces the first."""
    def write(path):
        write_tsv(_normalised(spark, sf), path, num_files=3)
        write_tsv(_normalised(spark, sf).filter("event = 'clk'"), path, num_files=1)

    lines = spark.read.text(materialized(spark, sf, "sink-overwrite", ("events",), write))
    f = F.split("value", "\t")
    files = F.col("_metadata.file_name")
    numbered = lines.select(*[f[i].alias(c) for i, c in enumerate(("userid", "docid", "event", "date", "platform"))], files.alias("file"))
    return numbered.groupBy("userid", "event").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("file").alias("n_files"))


def q_app_log_partitions(spark, sf):
    """One app's lines spread over a stated number of partitions, none of them empty or twice the mean."""
    sizes = with_position(app_log_extract(_lines(spark, sf), num_partitions=7)).groupBy("partition").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.count(F.lit(1)).alias("n_partitions"), F.sum("n").alias("n"), (F.max("n") < 2 * F.avg("n")).alias("even"))


def q_click_reducers(spark, sf):
    """Five sorted reducers: whether each row stands behind a smaller or equal user, and how many reducers a user is in."""
    path = work_path(spark, "reducers", unique=True)
    with_position(click_extract_sorted(_lines(spark, sf), 5)).write.parquet(path)
    at = spark.read.parquet(path)
    one_before = F.lag("userid").over(W.partitionBy("partition").orderBy("position"))
    judged = at.withColumn("in_order", F.coalesce(F.col("userid") >= one_before, F.lit(True)))
    return judged.groupBy("userid").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("partition").alias("n_reducers"), F.min("in_order").alias("in_order")
    )


def q_user_rules_now(spark, sf):
    """The rules at the present time: without ``as_of`` no user of the driver data is recent."""
    judged = user_rules(user_stats(_weighted(spark, sf)), tz=TZ)
    return judged.select("userid", "recent", "settled", "enough_strong")


# --- documents -----------------------------------------------------------------

def _doc_lines(spark, sf):
    """All document records as gzip files of bounded size; day-range scans read the day tree."""
    def write(path):
        rec = A.doc_record(A.load(spark, sf, "documents")).select("value")
        write_text(rec, path, compression="gzip", max_records_per_file=LINES_PER_FILE)

    return read_text_lines(spark, f"{materialized(spark, sf, 'docs-flat', ('documents',), write)}/*", gz_only=True)


def _docs(spark, sf):
    return doc_records(_doc_lines(spark, sf))


def _json_features(df: DataFrame) -> list:
    return [F.to_json("htc_key").alias("htc_key"), F.to_json("htc_value").alias("htc_value")]


def q_doc_filter(spark, sf):
    return doc_filter(_docs(spark, sf)).select("_id", "ctype")


def q_doc_enrich(spark, sf):
    e = doc_enrich(doc_filter(_docs(spark, sf)), A.label_replies(spark, sf))
    return e.select("_id", "ctype", *_json_features(e), "status")


def _old_features(store: DataFrame) -> DataFrame:
    """Existing features that differ from every reply: [["old"],[]] and [[id],[]]."""
    return store.withColumns({
        "htc_key": F.array(F.array(F.lit("old")), F.array().cast("array<string>")),
        "htc_value": F.array(F.array(F.col("_id").cast("double")), F.array().cast("array<double>")),
    })


def _repeated_replies(spark, sf) -> DataFrame:
    """Scorer replies, a third of them followed by a second version (values + 10)."""
    first = A.label_replies(spark, sf)
    again = first.filter(F.col("_id").cast("long") % 3 == 0).withColumn(
        "htc_value", F.transform("htc_value", lambda v: F.transform(v, lambda x: x + 10)))
    return first.withColumn("version", F.lit(1)).unionByName(again.withColumn("version", F.lit(2)))


def q_features_update_matched(spark, sf):
    target = _old_features(_docs(spark, sf).filter(F.col("_id").isNotNull()).select("_id", "ctype"))
    u = update_matched(target, _repeated_replies(spark, sf), order=("version",))
    return u.select("_id", "ctype", *_json_features(u), "updated")


def q_features_insert_new(spark, sf):
    """The store holds old features of the even ids; every scored document is offered, some twice."""
    store = _old_features(A.label_replies(spark, sf).filter(F.col("_id").cast("long") % 2 == 0).select("_id"))
    replies = _repeated_replies(spark, sf)
    new = None
    for v in (1, 2):
        scored = scored_features(doc_enrich(doc_filter(_docs(spark, sf)), replies.filter(F.col("version") == v)))
        scored = scored.withColumn("version", F.lit(v))
        new = scored if new is None else new.unionByName(scored)
    out = insert_new(store, new, order=("version",))
    return out.select("_id", *_json_features(out))


def make_length_scorer():
    """A local scorer: the lengths of a document's text; nothing for every
    fourth id, and an error whenever a batch holds an id that ends in 77."""
    import json

    def score(lines):
        out = []
        for line in lines:
            d = json.loads(line)
            if d["_id"].endswith("77"):
                raise ValueError("cannot score")
            n = len(d.get("text") or "")
            out.append(None if int(d["_id"]) % 4 == 1 else {"htc_key": [["chars"], [d["lang"]]], "htc_value": [[float(n)], [n / 2]]})
        return out

    return score


def _scored(spark, sf):
    return doc_enrich(doc_filter(_docs(spark, sf)), make_scorer=make_length_scorer, on_error="line")


def q_doc_score(spark, sf):
    e = _scored(spark, sf)
    return e.select("_id", "ctype", *_json_features(e), "status")


def q_doc_score_counts(spark, sf):
    return status_counts(_scored(spark, sf))


def _doc_versions_tree(spark, sf):
    def write(path):
        rec = A.doc_versions(A.load(spark, sf, "documents")).hint("rebalance", "day")
        write_text(rec, path, compression="gzip", partition_by=("day",), max_records_per_file=LINES_PER_FILE)

    return materialized(spark, sf, "doc-versions", ("documents",), write)


def q_features_update_days(spark, sf):
    """The enrichment job over a tree in which many documents stand on two days, once for either order of days."""
    tree = _doc_versions_tree(spark, sf)
    store = _old_features(_docs(spark, sf).filter(F.col("_id").isNotNull()).select("_id", "ctype"))
    out = None
    for prefer in ("newest", "oldest"):
        path = work_path(spark, f"store-{prefer}", unique=True)
        jobs.enrich_job(spark, [tree], *VERSION_SPAN, None, store, path, day_dir="day={day}", depth=1,
                        make_scorer=make_length_scorer, on_error="line", prefer=prefer)
        snapshot = spark.read.parquet(path).withColumn("prefer", F.lit(prefer))
        out = snapshot if out is None else out.unionByName(snapshot)
    return out.select("_id", "ctype", *_json_features(out), "updated", "prefer")


def q_features_update_buckets(spark, sf):
    """A small update of a store of 64 buckets: the rows after it, and which buckets it wrote anew."""
    store = _old_features(_docs(spark, sf).filter(F.col("_id").isNotNull()).select("_id", "ctype"))
    path = work_path(spark, "feature-store", unique=True)
    create_store(store, path, buckets=STORE_BUCKETS)
    few = _repeated_replies(spark, sf).filter(bucket_of("_id", STORE_BUCKETS) < 8)
    update_store(spark, path, few, order=("version",))
    rows = read_store(spark, path, with_places=True)
    return rows.select("_id", "ctype", *_json_features(rows), F.col("bucket").cast("long").alias("bucket"), (F.col("version") == 2).alias("rewritten"))


def make_stalling_scorer():
    """A scorer that never returns (an hour) when a batch holds an id that ends in 77."""
    import time

    plain = make_length_scorer()

    def score(lines):
        if any('77","ctype"' in line or '77","lang"' in line for line in lines):
            time.sleep(3600)
        return plain(lines)

    return score


def q_doc_score_stalls(spark, sf):
    """Calls in flight with a time limit: only the documents whose own call stalls fail, whatever their batch."""
    docs = A.in_equal_shares(doc_filter(_docs(spark, sf)), A.load(spark, sf, "documents", spread=False).count())
    e = doc_enrich(docs, make_scorer=make_stalling_scorer, batch_size=20, on_error="line", in_flight=8, timeout=STALL_SECONDS)
    return e.select("_id", "ctype", *_json_features(e), "status")


def make_batch_size_scorer():
    """A scorer that replies with the size of the batch it was called with."""
    def score(lines):
        return [{"htc_key": [["batch"], []], "htc_value": [[float(len(lines))], []]}] * len(lines)

    return score


def q_doc_score_batches(spark, sf):
    """How many documents were scored, and the largest batch that the scorer was given."""
    e = doc_enrich(doc_filter(_docs(spark, sf)), make_scorer=make_batch_size_scorer, batch_size=10)
    return e.agg(F.count(F.lit(1)).alias("n"), F.max(F.col("htc_value")[0][0]).cast("long").alias("largest_batch"))


def q_events_tsv_rejects(spark, sf):
    """Why lines of the whole normalised log are no training events after the late floor."""
    lines = spark.read.text(_events_tsv_dir(spark, sf))
    reason = evaluate_once(tsv_reject_reason(tz=TZ, floor=LATE_FLOOR))
    return lines.select(reason.alias("reason")).filter("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# --- scalar functions ------------------------------------------------------------

def q_fn_string(spark, sf):
    e = _normalised(spark, sf)
    line = F.concat_ws("\t", "userid", "docid", "event")
    return e.select(
        "userid",
        "docid",
        S.day_part("date").alias("day"),
        S.hour_part("date").alias("hour"),
        S.java_split(S.day_part("date"), "-")[0].alias("year"),
        F.col("docid").contains("_").alias("is_compound"),
        line.alias("line"),
        S.utf8_length(line).alias("line_bytes"),
        F.trim(F.concat(F.lit("  "), F.col("docid"), F.lit(" "))).alias("trimmed"),
    )


def q_fn_time(spark, sf):
    e = _normalised(spark, sf)
    wall = parse_wall_clock("date")
    return e.select(
        "userid",
        "date",
        epoch_seconds("date", "UTC").alias("t_utc"),
        epoch_seconds("date", "Asia/Shanghai").alias("t_cn"),
        F.date_format(wall, "yyyy-MM-dd-HH").alias("hour_key"),
        F.date_format(wall + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd HH:mm:ss").alias("next_hour"),
        F.date_format(F.date_add(F.to_date(wall), 1), "yyyy-MM-dd").alias("next_day"),
        F.dayofmonth(F.last_day(F.to_date(wall))).alias("days_in_month"),
    )


def q_fn_cast(spark, sf):
    p = parse_raw(_lines(spark, sf), "userid", "click", "view")
    p = p.filter(~F.col("_bad") & F.col("click").isNotNull())
    dwell = F.col("click.details.dwell").try_cast("float")
    return p.select(
        "userid",
        F.col("click.details.dwell").alias("dwell"),
        F.round(dwell * 100).cast("bigint").alias("dwell_x100"),
        F.substring("click.date", 12, 2).try_cast("int").alias("hour"),
        F.col("view.details.pos").try_cast("int").alias("pos"),
        F.col("userid").try_cast("bigint").alias("user_num"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_raw": q_parse_raw,
    "platform_classify": q_platform_classify,
    "view_events": q_view_events,
    "view_events_alternate": q_view_events_alternate,
    "click_events": q_click_events,
    "click_events_min_dwell": q_click_events_min_dwell,
    "normalise_events": q_normalise_events,
    "quarantine_events": q_quarantine_events,
    "quarantine_rows": q_quarantine_rows,
    "odd_events": q_odd_events,
    "click_extract": q_click_extract,
    "click_extract_sorted": q_click_extract_sorted,
    "app_log_extract": q_app_log_extract,
    "active_users": q_active_users,
    "active_user_clicks": q_active_user_clicks,
    "user_history": q_user_history,
    "scan_events_tsv": q_scan_events_tsv,
    "event_weights": q_event_weights,
    "user_stats": q_user_stats,
    "qualified_users": q_qualified_users,
    "doc_labels": q_doc_labels,
    "negative_pool": q_negative_pool,
    "train_rows": q_train_rows,
    "train_rows_shuffled": q_train_rows_shuffled,
    "user_rules": q_user_rules,
    "train_rows_limited": q_train_rows_limited,
    "train_removed": q_train_removed,
    "event_weights_floor": q_event_weights_floor,
    "scan_raw_log": q_scan_raw_log,
    "hour_range_scan": q_hour_range_scan,
    "union_logs": q_union_logs,
    "doc_scan_days": q_doc_scan_days,
    "sink_tsv": q_sink_tsv,
    "compact_files": q_compact_files,
    "doc_filter": q_doc_filter,
    "doc_enrich": q_doc_enrich,
    "features_update_matched": q_features_update_matched,
    "features_insert_new": q_features_insert_new,
    "doc_score": q_doc_score,
    "doc_score_counts": q_doc_score_counts,
    "features_update_days": q_features_update_days,
    "doc_score_stalls": q_doc_score_stalls,
    "doc_score_batches": q_doc_score_batches,
    "train_rows_uncapped": q_train_rows_uncapped,
    "click_extract_ranged": q_click_extract_ranged,
    "train_rows_permuted": q_train_rows_permuted,
    "compact_by_size": q_compact_by_size,
    "key_states": q_key_states,
    "scan_gz_only": q_scan_gz_only,
    "sink_overwrite": q_sink_overwrite,
    "app_log_partitions": q_app_log_partitions,
    "click_reducers": q_click_reducers,
    "user_rules_now": q_user_rules_now,
    "events_tsv_lenient": q_events_tsv_lenient,
    "events_tsv_odd": q_events_tsv_odd,
    "features_update_buckets": q_features_update_buckets,
    "events_tsv_rejects": q_events_tsv_rejects,
    "fn_string": q_fn_string,
    "fn_time": q_fn_time,
    "fn_cast": q_fn_cast,
}
