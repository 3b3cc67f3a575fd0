"""Normalised-event TSV source (``userid docid event date platform``).

Rule of the training job: a line needs at least 5 tab-separated fields
(trailing empty fields do not count), a weighted event code, a parsable
date and a time at or after the floor; anything else is dropped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.functions.codes import DATE_TIME_FORMAT, DEFAULT_TIME_ZONE, EVENT_TIME_FLOOR, EVENT_WEIGHTS
from clickweave.functions.columns import bind, evaluate_once
from clickweave.functions.strings import java_split
from clickweave.functions.time import epoch_seconds, wall_clock_literal_epoch


def prepare_training_events(
    events: DataFrame,
    tz: str = DEFAULT_TIME_ZONE,
    floor: str | None = EVENT_TIME_FLOOR,
    fmt: str = DATE_TIME_FORMAT,
    weights: Mapping[str, int] = EVENT_WEIGHTS,
    lenient: bool = False,
) -> DataFrame:
    """(userid, docid, event, date) rows -> (userid, docid, event, t, weight).

    ``t`` is epoch seconds of ``date`` read in zone ``tz``; times before 1970
    are dropped even without a floor. ``lenient`` rolls dates over instead of
    dropping those out of range (see :func:`lenient_wall_clock`).
    """
    wmap = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(v))])
    tw = F.struct(epoch_seconds("date", tz, fmt, lenient).alias("t"), wmap[F.col("event")].alias("weight"))
    df = events.filter(F.col("event").isin(list(weights))).select(
        "userid", "docid", "event", evaluate_once(tw).alias("_tw")
    ).select("userid", "docid", "event", "_tw.t", "_tw.weight")
    # t >= 0 always: the sampler packs (weight, t) into one bigint, which needs
    # non-negative epoch seconds; the default floor (2017) is far above it
    cond = F.col("t").isNotNull() & (F.col("t") >= 0)
    if floor is not None:
        cond = cond & (F.col("t") >= wall_clock_literal_epoch(floor, tz, fmt))
    return df.filter(cond)


def parse_events_tsv(lines: DataFrame, min_fields: int = 5) -> DataFrame:
    """``value`` TSV lines -> (userid, docid, event, date, platform) strings."""
    f = evaluate_once(java_split("value", "\t"))
    return (
        lines.select(f.alias("f"))
        .filter(F.size("f") >= min_fields)
        .select(*[F.col("f")[i].alias(n) for i, n in enumerate(("userid", "docid", "event", "date", "platform"))])
    )


#: Why a line is no training event, in the order in which the rules apply.
TSV_REASONS = ("too_short", "no_weight", "bad_date", "too_early")


def tsv_reject_reason(
    tz: str = DEFAULT_TIME_ZONE,
    floor: str | None = EVENT_TIME_FLOOR,
    fmt: str = DATE_TIME_FORMAT,
    weights: Mapping[str, int] = EVENT_WEIGHTS,
    min_fields: int = 5,
    lenient: bool = False,
) -> Column:
    """The first of :data:`TSV_REASONS` that keeps the line ``value`` out, else NULL.

    The line is split once, and its date read once if the rules get that far. A
    caller that filters by the reason takes it through :func:`evaluate_once`.
    """

    def by_time(t: Column) -> Column:
        early = t < 0 if floor is None else (t < 0) | (t < wall_clock_literal_epoch(floor, tz, fmt))
        return F.when(t.isNull(), F.lit("bad_date")).when(early, F.lit("too_early"))

    def reason(f: Column) -> Column:
        return (
            F.when(F.size(f) < min_fields, F.lit("too_short"))
            .when(~F.coalesce(f[2].isin(list(weights)), F.lit(False)), F.lit("no_weight"))
            .otherwise(bind(epoch_seconds(f[3], tz, fmt, lenient), by_time))
        )

    return bind(java_split("value", "\t"), reason)


def scan_events_tsv(
    spark: SparkSession,
    paths: str | Sequence[str],
    tz: str = DEFAULT_TIME_ZONE,
    floor: str | None = EVENT_TIME_FLOOR,
    fmt: str = DATE_TIME_FORMAT,
    lenient: bool = False,
) -> DataFrame:
    """Read normalised-event TSV files and keep the rows the training job uses."""
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths))
    return prepare_training_events(parse_events_tsv(lines), tz=tz, floor=floor, fmt=fmt, lenient=lenient)
