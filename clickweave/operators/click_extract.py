"""Click extraction for one app: ``userid docid event pos`` rows.

Keeps records of the app (default ``oppobrowser``) that are not ``views``
records (a missing ``type`` passes), have a click with ``docid`` and
``event``, and a ``view`` with channel ``selected``, mashtype ``profile`` and
a ``pos``. ``clickDoc``/``play`` events carry ``:<dwell>`` and are dropped
without a dwell. Map-only: a single projection + filter over the lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.functions.codes import CLICK_EXTRACT_APP, DWELL_SUFFIX_EVENTS, PROFILE_MASHTYPE, SELECTED_CHANNEL
from clickweave.operators.parse import parse_raw

FIELDS = ("userid", "appid", "type", "click", "view")


def click_extract(lines: DataFrame, app: str = CLICK_EXTRACT_APP) -> DataFrame:
    p = parse_raw(lines, *FIELDS)
    ev = F.col("click.event")
    dwell = F.col("click.details.dwell")
    suffixed = ev.isin(*DWELL_SUFFIX_EVENTS)
    # like the line-by-line mapper: only a line that is not a JSON object is
    # skipped outright; a mistyped field is NULL and fails only the checks
    # that need it (a string "details" does not stop a "like" click)
    cond = (
        ~F.col("_not_object")
        & (F.col("appid") == app)
        & F.col("userid").isNotNull()
        & ~F.col("type").eqNullSafe("views")
        & F.col("click.docid").isNotNull()
        & ev.isNotNull()
        & (~suffixed | dwell.isNotNull())
        & (F.col("view.channelType") == SELECTED_CHANNEL)
        & (F.col("view.details.mashtype") == PROFILE_MASHTYPE)
        & F.col("view.details.pos").isNotNull()
    )
    event = F.when(suffixed, F.concat_ws(":", ev, dwell)).otherwise(ev)
    return p.filter(cond).select(
        "userid", F.col("click.docid").alias("docid"), event.alias("event"), F.col("view.details.pos").alias("pos")
    )


def click_extract_sorted(lines: DataFrame, reducers: int | None = 5, app: str = CLICK_EXTRACT_APP) -> DataFrame:
    """Same rows, hash-partitioned by ``userid`` into ``reducers`` partitions and
    sorted by ``userid`` inside each (the streaming job's identity reducers).

    ``reducers=None`` uses ``spark.sql.shuffle.partitions`` (sized for the
    cluster); all rows of one user always land in one partition.
    """
    rows = click_extract(lines, app)
    spread = rows.repartition(reducers, "userid") if reducers else rows.repartition("userid")
    return spread.sortWithinPartitions("userid")


def click_extract_ranged(lines: DataFrame, num_partitions: int | None = None, app: str = CLICK_EXTRACT_APP) -> DataFrame:
    """Same rows, dealt by sampled ranges of (userid, pos, docid, event) and
    sorted by them: partition after partition the rows are in one order, and a
    heavy user's lie in several neighbouring partitions instead of one.

    The reducers of :func:`click_extract_sorted` hold whole users each; use this
    where a user may have more rows than a task should.
    """
    rows = click_extract(lines, app)
    keys = ("userid", "pos", "docid", "event")
    dealt = rows.repartitionByRange(num_partitions, *keys) if num_partitions else rows.repartitionByRange(*keys)
    return dealt.sortWithinPartitions(*keys)
