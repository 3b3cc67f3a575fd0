"""The map-only log operators under Structured Streaming.

Normalisation is a per-record projection + explode with no state, so the
batch operator runs unchanged on a streaming text source; every micro-batch
writes its good rows and its quarantined records through ``foreachBatch``
into per-batch directories (``batch_id=<n>``, overwritten on replay), with the
query checkpoint in the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clickweave.operators.normalise import (
    events_from_parsed, normalise_events, parse_with_reason, quarantine_from_parsed,
)


def _text_stream(spark: SparkSession, source_dir: str, gz_only: bool = True, max_files: int = 100) -> DataFrame:
    r = spark.readStream.format("text").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files)
    if gz_only:
        r = r.option("pathGlobFilter", "*.gz")
    return r.load(source_dir)


def normalise_stream(spark: SparkSession, source_dir: str, gz_only: bool = True, **options) -> DataFrame:
    """Streaming DataFrame of normalised events from raw log files arriving under ``source_dir``."""
    return normalise_events(_text_stream(spark, source_dir, gz_only), **options)


def start_normalise_stream(
    spark: SparkSession,
    source_dir: str,
    out_dir: str,
    checkpoint: str,
    available_now: bool = True,
    gz_only: bool = True,
    max_files: int = 100,
    **options,
) -> StreamingQuery:
    """Write normalised events to ``out_dir/events`` and rejects to ``out_dir/quarantine`` (parquet).

    ``checkpoint`` names the query's checkpoint folder: a restart with the same
    one goes on where the last run stopped. A micro-batch takes ``max_files``
    files at most, so a backlog is never held as one batch.
    """
    lines = _text_stream(spark, source_dir, gz_only, max_files)
    every_second = bool(options.get("every_second", False))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # one micro-batch (bounded) is parsed once and feeds two outputs; each
        # batch owns its directories and overwrites them, so a batch replayed
        # after a failure rewrites, never duplicates
        parsed = parse_with_reason(batch, every_second).persist()
        try:
            events_from_parsed(parsed, **options).write.mode("overwrite").parquet(
                f"{out_dir}/events/batch_id={batch_id}"
            )
            quarantine_from_parsed(parsed).write.mode("overwrite").parquet(
                f"{out_dir}/quarantine/batch_id={batch_id}"
            )
        finally:
            parsed.unpersist()

    w = lines.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
