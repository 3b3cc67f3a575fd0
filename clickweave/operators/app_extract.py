"""Keep the raw lines of one app (default ``vivobrowser``), unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.functions.codes import LOG_EXTRACT_APP
from clickweave.operators.parse import parse_raw


def app_log_extract(lines: DataFrame, app: str = LOG_EXTRACT_APP, num_partitions: int | None = None) -> DataFrame:
    """``value`` lines whose ``appid`` equals ``app``; bad JSON and missing appid drop.

    Only ``appid`` is parsed. ``num_partitions`` spreads the (unsplittable,
    gzip-sized) input partitions over that many output files; leave it None
    to keep input partitioning (no shuffle).
    """
    out = app_lines(parse_raw(lines, "appid", keep_line=True), app)
    return out.repartition(num_partitions) if num_partitions else out


def app_lines(parsed: DataFrame, app: str = LOG_EXTRACT_APP) -> DataFrame:
    """:func:`app_log_extract` on the output of ``parse_raw(lines, "appid", keep_line=True)``."""
    return parsed.filter(~F.col("_bad") & (F.col("appid") == app)).select("value")
