"""Adapters: the driver's tables -> the reference's input shapes, built by Spark.

Every rule below is mirrored column-for-column by the DuckDB oracles in
:mod:`clickweave.plans.oracles` (which never build JSON).

events -> raw JSON log record (one line per event):
  userid        user_id as text
  docid         props.k as text; ``a_<k>`` when event_id % 13 = 0 (compound id)
  date          ts as ``yyyy-MM-dd HH:mm:ss``
  appid         by event_id % 7: apple oppo xiaomi oppobrowser mibrowser vivobrowser other;
                missing when event_id % 53 = 0
  type          ``views`` for view events; else missing when event_id is even, ``click`` when odd
  views         view events: 1 + event_id % 4 elements; element i: docid (k + 7 i) % 100,
                date ts - i minutes
  click         every non-view event, and view events with event_id % 3 = 0;
                event: view/click -> clickDoc, purchase -> shareDoc, error -> dislike,
                signup -> by event_id % 4: viewComment like addComment play
  click.details missing when event_id % 17 = 0; dwell = value with 2 decimals,
                missing when event_id % 11 = 0, ``n/a`` when event_id % 29 = 0
  view          missing when event_id % 19 = 0; channelType selected (even event_id) / hot;
                details.mashtype feed (event_id % 3 = 0) / profile; details.pos = event_id % 10
  bad line      event_id % 101 = 0: the JSON text gets a stray leading ``{``

documents -> document NDJSON record: _id = doc_id (missing when doc_id % 23 = 0),
  ctype missing when doc_id % 7 = 0, ``video`` when doc_id % 5 = 0, else ``news``;
  lang, source, text whole. Day directory: 2017-06-01 + doc_id % 281 days.
labels -> scorer reply: htc_key [["quality"], ["toxic"]], htc_value [[quality], [toxic]].
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.functions.codes import DATE_TIME_FORMAT
from clickweave.functions.columns import evaluate_once

# fixed adapter values
ADAPTER_APPS = ["apple", "oppo", "xiaomi", "oppobrowser", "mibrowser", "vivobrowser", "other"]
ADAPTER_SIGNUP_EVENTS = ["viewComment", "like", "addComment", "play"]
DOC_DAY0 = "2017-06-01"
DOC_DAYS = 281


def load(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    """Read a driver table; spread it only when the scan is under-partitioned.

    A large table arrives in many splits and is left alone (no shuffle); a
    single-row-group file would otherwise put all downstream JSON work in
    one task. Only splits that hold rows count: a file is cut by its bytes, but
    a row group is read whole by one of them.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    par = spark.sparkContext.defaultParallelism
    if spread and (df.rdd.getNumPartitions() < par or _filled_splits(df) < par):
        df = df.repartition(par)
    return df


def _filled_splits(df: DataFrame) -> int:
    """The splits that hold rows; no column is read for it."""
    return df.select(F.spark_partition_id().alias("split")).distinct().count()


#: Documents in a task whose calls wait. A task ends with up to two time limits in which its places fall idle, so it holds many.
DOCS_PER_TASK = 50_000


def in_equal_shares(docs: DataFrame, n_docs: int) -> DataFrame:
    """``docs``, of about ``n_docs`` rows, in equal shares, one or several for each task slot.

    A task that waits for calls takes as long as its share has stalls: eight
    files in six slots would take twice as long as one of them, and many small
    files the time limits of each.
    """
    par = docs.sparkSession.sparkContext.defaultParallelism
    return docs.repartition(par * max(1, round(n_docs / (par * DOCS_PER_TASK))))


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def raw_record(events: DataFrame) -> DataFrame:
    """events -> (value, day, hour): the raw JSON line and its hour directory."""
    eid = F.col("event_id")
    et = F.col("event_type")
    kstr = F.get_json_object("props", "$.k")
    k = kstr.cast("int")
    ts = F.col("ts")
    date = F.date_format(ts, DATE_TIME_FORMAT)
    docid = F.when(eid % 13 == 0, F.concat(F.lit("a_"), kstr)).otherwise(kstr)
    is_view = et == "view"
    views = F.when(
        is_view,
        F.transform(
            F.sequence(F.lit(0), (eid % 4).cast("int")),
            lambda i: F.struct(
                ((k + i * 7) % 100).cast("string").alias("docid"),
                F.date_format(ts - F.make_dt_interval(F.lit(0), F.lit(0), i, F.lit(0)), DATE_TIME_FORMAT).alias("date"),
            ),
        ),
    )
    click_event = (
        F.when(is_view | (et == "click"), F.lit("clickDoc"))
        .when(et == "purchase", F.lit("shareDoc"))
        .when(et == "error", F.lit("dislike"))
        .otherwise(_pick(ADAPTER_SIGNUP_EVENTS, eid % 4))
    )
    dwell = (
        F.when(eid % 11 == 0, F.lit(None).cast("string"))
        .when(eid % 29 == 0, F.lit("n/a"))
        .otherwise(F.format_string("%.2f", F.col("value")))
    )
    details = F.when(eid % 17 != 0, F.struct(dwell.alias("dwell")))
    click = F.when(
        ~is_view | (eid % 3 == 0),
        F.struct(click_event.alias("event"), date.alias("date"), docid.alias("docid"), details.alias("details")),
    )
    view = F.when(
        eid % 19 != 0,
        F.struct(
            F.when(eid % 2 == 0, F.lit("selected")).otherwise(F.lit("hot")).alias("channelType"),
            F.struct(
                F.when(eid % 3 == 0, F.lit("feed")).otherwise(F.lit("profile")).alias("mashtype"),
                (eid % 10).cast("string").alias("pos"),
            ).alias("details"),
        ),
    )
    rec = F.struct(
        F.col("user_id").cast("string").alias("userid"),
        F.when(eid % 53 != 0, _pick(ADAPTER_APPS, eid % 7)).alias("appid"),
        F.when(is_view, F.lit("views")).when(eid % 2 == 1, F.lit("click")).alias("type"),
        views.alias("views"),
        click.alias("click"),
        view.alias("view"),
    )
    js = F.to_json(rec)
    line = F.when(eid % 101 == 0, F.concat(F.lit("{"), js)).otherwise(js)
    return events.select(
        line.alias("value"), F.date_format(ts, "yyyy-MM-dd").alias("day"), F.date_format(ts, "HH").alias("hour")
    )


def hot_events(events: DataFrame) -> DataFrame:
    """``events`` with a third of them given to user 0, on documents of their own."""
    third = F.col("event_id") % 3 == 0
    props = F.concat(F.lit('{"k": '), F.col("event_id").cast("string"), F.lit("}"))
    return events.withColumns(
        {"user_id": F.when(third, F.lit(0)).otherwise(F.col("user_id")), "props": F.when(third, props).otherwise(F.col("props"))}
    )


#: What a probed key may hold; N is the event's number.
PROBED = {"views": ["", '"views":null,', '"views":[{"docid":"N"}],', '"views":"",'],
          "click": ["", '"click":null,', '"click":{"docid":null,"event":"like"},', '"click":{"docid":"N","event":null},', '"click":{},']}


def probed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value``: per event a record whose keys are absent, null or there; every 31st line is no object."""
    ev, eid = load(spark, sf_dir, "events"), F.col("event_id")
    parts = [_pick(v, F.floor(eid / step) % len(v)) for v, step in ((PROBED["views"], 1), (PROBED["click"], 4))]
    line = F.replace(F.concat(F.lit('{'), *parts, F.lit('"n":"N"}')), F.lit("N"), eid.cast("string"))
    return ev.select(F.when(eid % 31 == 0, F.concat(F.lit("["), line)).otherwise(line).alias("value"))


#: Ways to write a date, by event_id % 8: as it is, unpadded, month 13 and more, day 0, hours over 23, text behind, no date, a field missing.
LENIENT_FORMS = 8


def lenient_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value``: a TSV line per event whose date is written in one of :data:`LENIENT_FORMS` ways."""
    ev, eid, ts = load(spark, sf_dir, "events"), F.col("event_id"), F.col("ts")
    clock = F.date_format(ts, "HH:mm:ss")
    forms = [
        F.date_format(ts, DATE_TIME_FORMAT),
        F.date_format(ts, "yyyy-M-d H:m:s"),
        F.concat((F.year(ts) - 1).cast("string"), F.lit("-"), (F.month(ts) + 12).cast("string"), F.lit("-"), F.date_format(ts, "dd "), clock),
        F.concat(F.date_format(F.add_months(F.trunc(ts, "MM"), 1), "yyyy-MM"), F.lit("-0 "), clock),
        F.concat(F.date_format(F.date_sub(ts, 1), "yyyy-MM-dd "), (F.hour(ts) + 24).cast("string"), F.date_format(ts, ":mm:ss")),
        F.concat(F.date_format(ts, DATE_TIME_FORMAT), F.lit(".123 +08:00")),
        F.lit("yesterday"),
    ]
    date = forms[-1]
    for i, form in enumerate(forms[:-1]):
        date = F.when(eid % LENIENT_FORMS == i, form).otherwise(date)
    short = F.concat_ws("\t", F.lit("u"), eid.cast("string"), F.lit("clk"))
    whole = F.concat_ws("\t", F.lit("u"), eid.cast("string"), F.lit("clk"), date, F.lit("app_oppo"))
    return ev.select(evaluate_once(F.when(eid % LENIENT_FORMS == 7, short).otherwise(whole)).alias("value"))


#: Records with mistyped or missing fields, by event_id % 12; N is the event's number.
ODD_RECORDS = [
    '{"n":"N","userid":"u","appid":"oppo","views":[{"docid":"aN","date":"t"},{"docid":"bN","date":"t"}],"click":"x"}',
    '{"n":"N","userid":"u","appid":"oppo","views":[{"docid":"aN","date":"t"},"oops",{"docid":"cN","date":"t"}]}',
    '{"n":"N","userid":"u","appid":"oppo","views":{"docid":"aN"}}',
    '{"n":"N","userid":"u","appid":"oppo","click":"x"}',
    '{"n":"N","userid":"u","appid":"oppo","click":{"event":"like","docid":"dN","date":"t","details":"none"}}',
    '{"n":"N","appid":"oppo","views":[]}',
    '{"n":"N","userid":"u","views":[]}',
    '{"n":"N","userid":"u","appid":"oppo","click":{"event":"like","date":"t"}}',
    '{"n":"N","userid":"u","appid":"oppo","click":{"event":"clickDoc","docid":"dN","date":"t","details":{"dwell":"n/a"}}}',
    '{"n":"N","userid":"u","appid":"oppo","views":[{"docid":"aN","date":"t"},{"docid":"bN","date":"t"},{"docid":"cN","date":"t"}]}',
    '[{"n":"N","userid":"u"}]',
    '{"n":"N","userid":"u","appid":"oppo","click":{"event":"like","docid":"dN","date":"t"}}',
]


def odd_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value``: one record of :data:`ODD_RECORDS` per event."""
    ev = load(spark, sf_dir, "events")
    record = _pick(ODD_RECORDS, F.col("event_id") % len(ODD_RECORDS))
    return ev.select(F.replace(record, F.lit("N"), F.col("event_id").cast("string")).alias("value"))


def raw_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log as a ``value`` DataFrame, derived from ``events``."""
    return raw_record(load(spark, sf_dir, "events")).select("value")


def doc_record(documents: DataFrame) -> DataFrame:
    """documents -> (value, day): document NDJSON line and its day directory."""
    did = F.col("doc_id")
    ctype = F.when(did % 7 == 0, F.lit(None)).when(did % 5 == 0, F.lit("video")).otherwise(F.lit("news"))
    rec = F.struct(
        F.when(did % 23 != 0, did.cast("string")).alias("_id"),
        ctype.alias("ctype"),
        F.col("lang"),
        F.col("source"),
        F.col("text"),
    )
    day = F.date_format(F.date_add(F.lit(DOC_DAY0).cast("date"), (did % DOC_DAYS).cast("int")), "yyyy-MM-dd")
    return documents.select(F.to_json(rec).alias("value"), day.alias("day"))


def doc_versions(documents: DataFrame) -> DataFrame:
    """documents -> (value, day): every document on one of 100 days, every third one again 100 days later, with
    a longer text if its id is even and an empty one if it is odd."""
    did = F.col("doc_id")
    again = documents.filter(did % 3 == 0).withColumn(
        "text", F.when(did % 2 == 0, F.concat("text", F.lit(" again"))).otherwise(F.lit(""))
    )
    first_day = F.lit(DOC_DAY0).cast("date")
    both = [
        doc_record(d).select("value", F.get_json_object("value", "$._id").cast("long").alias("id")).select(
            "value", F.date_format(F.date_add(first_day, (F.coalesce("id", F.lit(0)) % 100).cast("int") + later), "yyyy-MM-dd").alias("day")
        )
        for d, later in ((documents, 0), (again, 100))
    ]
    return both[0].unionByName(both[1])


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doc_record(load(spark, sf_dir, "documents")).select("value")


def label_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels -> scorer replies (_id, htc_key, htc_value)."""
    lab = load(spark, sf_dir, "labels", spread=False)  # a join side: no per-row work to spread
    return lab.select(
        F.col("doc_id").cast("string").alias("_id"),
        F.array(F.array(F.lit("quality")), F.array(F.lit("toxic"))).alias("htc_key"),
        F.array(F.array(F.col("quality").cast("double")), F.array(F.col("toxic").cast("double"))).alias("htc_value"),
    )
