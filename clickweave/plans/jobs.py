"""End-to-end jobs: read files, run the operators, write files. One lazy plan and
one write per output; every knob of the original batch jobs is a keyword.

=========================  =====================================================
job                        does
=========================  =====================================================
normalise_job              raw JSON logs -> ``userid docid event date platform`` TSV
                           (+ quarantined records with their reason)
click_extract_job          one app's clicks -> ``userid docid event pos`` TSV in
                           ``reducers`` files, hash-partitioned and sorted by user,
                           under a run-labelled directory
history_job                raw logs -> ``user\\tdoc date doc date ...`` of active users
training_job               normalised TSV -> ``user\\tpos\\tneg...`` rows, shuffled
                           into ``num_files`` gzip files
extract_job                hour range of raw logs -> one app's raw lines, gzip
enrich_job                 document day range -> scored features -> new snapshot
                           of a feature table (matched-only update or insert-new)
=========================  =====================================================
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clickweave.functions.codes import CLICK_EXTRACT_APP, DEFAULT_TIME_ZONE, EVENT_TIME_FLOOR, LOG_EXTRACT_APP
from clickweave.functions.columns import evaluate_once
from clickweave.operators.app_extract import app_lines
from clickweave.operators.click_extract import click_extract_sorted
from clickweave.operators.enrich import (
    doc_enrich, doc_filter, doc_records, doc_rejects, insert_new, scored_features, update_matched,
)
from clickweave.operators.history import render_history, user_history
from clickweave.operators.normalise import normalise_events, normalise_with_quarantine, render_tsv
from clickweave.operators.parse import parse_raw
from clickweave.operators.training import render_train_rows, shuffle_rows, train_rows
from clickweave.session import materialize
from clickweave.sinks.text import write_snapshot, write_text, write_tsv
from clickweave.sources.documents import scan_doc_days
from clickweave.sources.events_tsv import TSV_REASONS, parse_events_tsv, prepare_training_events, tsv_reject_reason
from clickweave.sources.raw_log import hour_range_scan, missing_hours, read_text_lines


def normalise_job(
    spark: SparkSession,
    inputs: str | Sequence[str],
    output: str,
    with_quarantine: bool = True,
    gz_only: bool = False,
    **options,
) -> dict:
    """Raw logs -> ``output/kind=events`` (TSV) and ``output/kind=quarantine``
    (``reason\tline``) from one scan and parse of the input; with
    ``with_quarantine=False`` only the events, directly under ``output``.
    Returns run metrics collected while writing (no extra pass)."""
    lines = read_text_lines(spark, inputs, gz_only=gz_only, allow_empty=False)
    if not with_quarantine:
        obs = Observation("normalise")
        events = normalise_events(lines, **options).observe(obs, F.count(F.lit(1)).alias("events"))
        write_text(render_tsv(events), output)
        return dict(obs.get)
    obs = Observation("normalise")
    both = normalise_with_quarantine(lines, **options).observe(
        obs,
        F.count_if(F.col("kind") == "events").alias("events"),
        F.count_if(F.col("kind") == "quarantine").alias("quarantined"),
    )
    write_text(both, output, partition_by=("kind",))
    return dict(obs.get)


def click_extract_job(
    spark: SparkSession,
    inputs: str | Sequence[str],
    output: str,
    run: str,
    reducers: int | None = None,
    app: str = CLICK_EXTRACT_APP,
    gz_only: bool = False,
) -> None:
    rows = click_extract_sorted(
        read_text_lines(spark, inputs, gz_only=gz_only, allow_empty=False), reducers, app
    )
    write_tsv(rows, output, run=run)


def history_job(
    spark: SparkSession,
    inputs: str | Sequence[str],
    output: str,
    min_clicks: int = 20,
    k: int = 20,
    num_files: int | None = None,
    gz_only: bool = False,
) -> None:
    lines = read_text_lines(spark, inputs, gz_only=gz_only, allow_empty=False)
    write_text(render_history(user_history(lines, min_clicks=min_clicks, k=k)), output, num_files=num_files)


def training_job(
    spark: SparkSession,
    inputs: str | Sequence[str],
    output: str,
    as_of: str | None = None,
    tz: str = DEFAULT_TIME_ZONE,
    floor: str | None = EVENT_TIME_FLOOR,
    num_files: int | None = None,
    seed: int = 0,
    **thresholds,
) -> dict:
    """``num_files=None``: AQE-sized random partitions (the original fixed 100 is ``num_files=100``).
    Returns how many input lines were read and dropped, by reason (counted in the same pass)."""
    lines = read_text_lines(spark, inputs, gz_only=False, skip_blank=False, allow_empty=False)
    obs = Observation("training")
    reason = tsv_reject_reason(tz=tz, floor=floor)
    counted = lines.withColumn("_reason", evaluate_once(reason)).observe(
        obs,
        F.count(F.lit(1)).alias("lines"),
        *(F.count_if(F.col("_reason") == r).alias(r) for r in TSV_REASONS),
    )
    events = prepare_training_events(parse_events_tsv(counted), tz=tz, floor=floor)
    rows = train_rows(events, as_of=as_of, tz=tz, **thresholds)
    write_text(shuffle_rows(render_train_rows(rows), num_files, seed), output, compression="gzip")
    return dict(obs.get)


def extract_job(
    spark: SparkSession,
    base: str,
    start: str,
    end: str,
    output: str,
    app: str = LOG_EXTRACT_APP,
    num_files: int | None = None,
    day_dir: str = "{day}",
    hour_dir: str = "{hour}",
    gz_only: bool = False,
) -> dict:
    """``num_files=None``: AQE-sized output files (the original fixed 100 is ``num_files=100``).
    Returns ``{"lines": n written, "bad_lines": n not JSON or without a usable
    appid, "missing_hours": [...]}``."""
    lines = hour_range_scan(
        spark, base, start, end, day_dir=day_dir, hour_dir=hour_dir, gz_only=gz_only, allow_empty=False
    )
    obs, read = Observation("extract"), Observation("extract_read")
    parsed = parse_raw(lines, "appid", keep_line=True).observe(
        read, F.count_if(F.col("_bad") | F.col("appid").isNull()).alias("bad_lines")
    )
    kept = app_lines(parsed, app).observe(obs, F.count(F.lit(1)).alias("lines"))
    write_text(kept, output, compression="gzip", num_files=num_files, balance=True)
    return {**obs.get, **read.get, "missing_hours": missing_hours(spark, base, start, end, day_dir, hour_dir)}


def enrich_job(
    spark: SparkSession,
    roots: Sequence[str],
    start: str,
    end: str,
    scorer: Callable | DataFrame | None,
    store: DataFrame,
    output: str,
    mode: str = "update",
    batch_size: int = 100,
    day_dir: str = "{day}",
    depth: int = 2,
    make_scorer: Callable | None = None,
    on_error: str = "batch",
    rejects: str | None = None,
    prefer: str = "newest",
    in_flight: int = 1,
    timeout: float | None = None,
) -> DataFrame:
    """Score the documents of days ``start..end`` and write a new feature-table snapshot.

    ``mode="update"`` sets features of ``_id``s already in ``store`` (no insert);
    ``mode="insert"`` appends ``_id``s absent from ``store``. Only documents the
    scorer replied to (``status = "ok"``) reach the store, one row per ``_id``:
    of an ``_id`` in several days that of the ``"newest"`` or ``"oldest"`` day
    (``prefer``), within a day that of the file whose path sorts last, within a
    file the greatest features. After a failure the stored features stay as
    they were. ``scorer`` or ``make_scorer``, ``on_error``, ``in_flight`` and
    ``timeout`` as in :func:`score_batches`; ``rejects`` names a path for the
    lines that cannot be scored, with their reason. Returns the per-doc
    enrichment (with ``status``, ``day`` and ``file``) for reporting.
    """
    if prefer not in ("newest", "oldest"):
        raise ValueError("prefer must be 'newest' or 'oldest'")
    lines = scan_doc_days(spark, roots, start, end, day_dir, depth, allow_empty=False, with_origin=True)
    records = doc_records(lines, keep=("day", "file"))
    if rejects is not None:
        write_tsv(doc_rejects(records), rejects, columns=("reason", "raw"))
    # written once: the scorer (possibly a remote service) runs exactly once per
    # document, for the snapshot and for whatever the caller does with the result
    enriched = doc_enrich(
        doc_filter(records), scorer, batch_size=batch_size, make_scorer=make_scorer, on_error=on_error,
        in_flight=in_flight, timeout=timeout,
    )
    enriched = materialize(enriched, "enriched")
    age = F.datediff("day", F.lit("1970-01-01")) * (1 if prefer == "newest" else -1)
    order = ("__age", "file")
    feats = scored_features(enriched.withColumn("__age", age), keep=order)
    snap = update_matched(store, feats, order=order) if mode == "update" else insert_new(store, feats, order=order)
    write_snapshot(snap, output)
    return enriched
