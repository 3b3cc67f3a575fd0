"""Recent-click history of active users.

1. ``active_users``: users with at least ``min_clicks`` ``clickDoc`` clicks
   (records with ``userid`` and ``click.event`` + ``click.details`` present;
   repeats count). Partial + final hash aggregate.
2. ``active_user_clicks``: their clicks with ``date`` and ``docid`` — a
   ``left_semi`` join; the optimizer broadcasts the user set only when its
   measured size is under the broadcast threshold, else shuffles both sides.
3. ``user_history``: per user the ``k`` most recently clicked distinct docs,
   newest first, each with its latest click date.

Skew: the (user, doc) aggregate spreads a hot user over many tasks, and the
``row_number() <= k`` filter becomes a partial WindowGroupLimit before the
shuffle on ``userid``, so no task ever holds more than ``k`` rows per user
per input partition plus the final merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweave.operators.parse import parse_raw
from clickweave.session import materialize

HISTORY_FIELDS = ("userid", "click")


def _clicks(lines: DataFrame) -> DataFrame:
    p = parse_raw(lines, *HISTORY_FIELDS)
    return p.filter(
        ~F.col("_bad")
        & F.col("userid").isNotNull()
        & (F.col("click.event") == "clickDoc")
        & F.col("click.details").isNotNull()
    ).select("userid", F.col("click.docid").alias("docid"), F.col("click.date").alias("date"))


def active_users(lines: DataFrame, min_clicks: int = 20) -> DataFrame:
    """(userid, n_clicks) with ``n_clicks >= min_clicks``."""
    return _clicks(lines).groupBy("userid").agg(F.count(F.lit(1)).alias("n_clicks")).filter(
        F.col("n_clicks") >= min_clicks
    )


def active_user_clicks(lines: DataFrame, min_clicks: int = 20, checkpoint: bool = True) -> DataFrame:
    """(userid, docid, date) of every click with a date and docid by an active user.

    ``checkpoint`` writes the narrow click projection once (one JSON parse)
    and feeds both the count and the semi join from it.
    """
    clicks = _clicks(lines)
    if checkpoint:
        clicks = materialize(clicks, "clicks")
    users = clicks.groupBy("userid").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_clicks)
    return clicks.filter(F.col("docid").isNotNull() & F.col("date").isNotNull()).join(
        users.select("userid"), "userid", "left_semi"
    )


def user_history(lines: DataFrame, min_clicks: int = 20, k: int = 20, checkpoint: bool = True) -> DataFrame:
    """(userid, items, n_items): ``items`` = ``doc date doc date ...`` newest first.

    One scan (``checkpoint``): clicks are first reduced to one row per (user, doc) holding the
    click count and latest date (map-side combined); the activity threshold is
    a sum over those rows, and only then are an active user's docs ranked.
    """
    per_doc = _clicks(lines).groupBy("userid", "docid").agg(
        F.count(F.lit(1)).alias("n"), F.max("date").alias("date")
    )
    if checkpoint:  # one scan of the raw log feeds both branches
        per_doc = materialize(per_doc, "click-docs")
    users = per_doc.groupBy("userid").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_clicks)
    # top-k first: the partial WindowGroupLimit keeps <= k rows per user in every
    # map task, so even a user holding a large share of all clicks ships only
    # k rows per task into the user-keyed shuffle; the activity filter commutes.
    w = Window.partitionBy("userid").orderBy(F.col("date").desc(), F.col("docid"))
    ranked = per_doc.filter(F.col("docid").isNotNull() & F.col("date").isNotNull())
    top = ranked.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    top = top.join(users.select("userid"), "userid", "left_semi")
    entries = F.array_sort(F.collect_list(F.struct("rank", "docid", "date")))
    return top.groupBy("userid").agg(entries.alias("e")).select(
        "userid",
        F.array_join(F.flatten(F.transform("e", lambda x: F.array(x["docid"], x["date"]))), " ").alias("items"),
        F.size("e").alias("n_items"),
    )


def render_history(history: DataFrame) -> DataFrame:
    """History -> ``user\\tdoc date doc date ...`` text lines."""
    return history.select(F.concat_ws("\t", "userid", "items").alias("value"))
