"""Training rows: one positive doc and up to three negative docs per row.

Input: weighted events (userid, docid, event, t, weight) — see
:func:`clickweave.sources.events_tsv.prepare_training_events`.

Rules (per user, events newest first): a doc's slot is taken at its newest
event and moves to a higher class at the newest event of each greater weight,
blanking the old slot. Positives are docs whose greatest weight is 1..3;
the negative pool is the strong negatives (weight 4) followed by the weak
docs (weight 0 at their newest event), blanked slots included. Positive
``r`` (newest first) takes the next three non-blank pool entries, and is
emitted while at least three pool slots (blank or not) remain and ``r <= 250``.

Set-based form used here (no per-user list is ever built):

* per (user, doc): ``w`` = max weight, ``tm`` = latest time at weight ``w``,
  ``tl`` = latest time, ``wl`` = weight at ``tl`` (ties: larger weight). Two
  packed ``bigint`` maxima (``w*2^40+t`` and ``t*8+weight``) keep this a
  hash aggregate with a map-side combine.
* positives ``w in 1..3`` ranked by (tm desc, docid); pool rows are
  ``w = 4`` at ``tm`` (class 0) and ``wl = 0`` at ``tl`` (class 1, blank when
  ``w > 0``), ranked by (class, time desc, docid) -> ``raw_pos``; ``n`` is the
  running count of non-blank pool rows and ``size`` the pool size.
* negatives of row ``r`` = non-blank pool rows with ``ceil(n/3) = r``; row ``r``
  needs ``size - end(r-1) >= 3`` with ``end(0) = 0`` and ``end(g)`` the
  ``raw_pos`` of the third member of group ``g``.

Shuffles: (user, doc) aggregate with partial combine -> per-user statistics
(small, one aggregate, written) -> semi join of qualified users -> ONE exchange
on ``userid`` shared by all windows and the final per-(user, slot) assembly.
Users above the event cap never reach a window, so a window partition holds at
most ``cap`` docs. Both caps are rules of the original job; ``None`` switches
either off, and :func:`removed_counts` says what each rule removes. Without the
event cap the ranks come from ranges of a user's slots (``spread``), so a user
with a third of all events is ranked by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.functions.codes import DATE_TIME_FORMAT, DEFAULT_TIME_ZONE, MAX_EVENTS_PER_USER, MAX_ROWS_PER_USER
from clickweave.functions.time import wall_clock_literal_epoch
from clickweave.operators.ranking import ranked_in_groups
from clickweave.session import materialize

_SHIFT = 40
_MASK = (1 << _SHIFT) - 1
DAY = 86400


def doc_stats(events: DataFrame) -> DataFrame:
    """(userid, docid, pw, pl, t_min, n_strong, n): per (user, doc) aggregates."""
    w, t = F.col("weight").cast("bigint"), F.col("t").cast("bigint")
    return events.groupBy("userid", "docid").agg(
        F.max(F.shiftleft(w, _SHIFT) + t).alias("pw"),
        F.max(t * 8 + w).alias("pl"),
        F.min(t).alias("t_min"),
        F.count_if(F.col("weight").between(1, 3)).alias("n_strong"),
        F.count(F.lit(1)).alias("n"),
    )


def user_stats(events: DataFrame) -> DataFrame:
    """(userid, t_max, t_min, n_strong, n_events) straight from events."""
    return events.groupBy("userid").agg(
        F.max("t").alias("t_max"),
        F.min("t").alias("t_min"),
        F.count_if(F.col("weight").between(1, 3)).alias("n_strong"),
        F.count(F.lit(1)).alias("n_events"),
    )


def user_stats_from_docs(docs: DataFrame) -> DataFrame:
    """Same statistics from :func:`doc_stats` rows (avoids a second pass over events)."""
    return docs.groupBy("userid").agg(
        F.max(F.shiftright("pl", 3)).alias("t_max"),
        F.min("t_min").alias("t_min"),
        F.sum("n_strong").alias("n_strong"),
        F.sum("n").alias("n_events"),
    )


def _as_of_epoch(as_of: str | None, tz: str, fmt: str) -> Column:
    if as_of is None:
        return F.unix_seconds(F.current_timestamp())
    return wall_clock_literal_epoch(as_of, tz, fmt)


def user_rules(
    stats: DataFrame,
    as_of: str | None = None,
    tz: str = DEFAULT_TIME_ZONE,
    min_strong: int = 10,
    recent_days: int = 30,
    settle_days: int = 5,
    min_span_days: int = 3,
    max_events: int | None = MAX_EVENTS_PER_USER,
    fmt: str = DATE_TIME_FORMAT,
) -> DataFrame:
    """``stats`` with one boolean per rule (``as_of`` wall clock in ``tz``; None = now).

    strong >= min_strong; last event >= as_of - recent_days; first event <=
    as_of - settle_days; 2 * strong <= events; span >= min_span_days; events
    <= max_events (None: no cap).
    """
    now = _as_of_epoch(as_of, tz, fmt)
    return stats.withColumns(
        {
            "enough_strong": F.col("n_strong") >= min_strong,
            "recent": F.col("t_max") >= now - recent_days * DAY,
            "settled": F.col("t_min") <= now - settle_days * DAY,
            "mostly_weak": F.col("n_strong") * 2 <= F.col("n_events"),
            "long_enough": F.col("t_max") - F.col("t_min") >= min_span_days * DAY,
            "under_cap": F.lit(True) if max_events is None else F.col("n_events") <= max_events,
        }
    )


USER_RULES = ("enough_strong", "recent", "settled", "mostly_weak", "long_enough", "under_cap")


def qualified_users(stats: DataFrame, as_of: str | None = None, tz: str = DEFAULT_TIME_ZONE, **thresholds) -> DataFrame:
    """Users fit for training: those that keep every rule of :func:`user_rules`."""
    judged = user_rules(stats, as_of, tz, **thresholds)
    for rule in USER_RULES:
        judged = judged.filter(rule)
    return judged.drop(*USER_RULES)


def removed_counts(
    events: DataFrame,
    as_of: str | None = None,
    tz: str = DEFAULT_TIME_ZONE,
    max_rows: int | None = MAX_ROWS_PER_USER,
    checkpoint: bool = True,
    **thresholds,
) -> DataFrame:
    """(rule, n): users that break each rule (a user may break several), and
    under ``max_rows`` the training rows that the row limit cuts off."""
    judged = user_rules(user_stats(events), as_of, tz, **thresholds)
    users = judged.agg(*(F.count_if(~F.col(r)).alias(r) for r in USER_RULES))
    broken = users.select(F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(r).alias("n")) for r in USER_RULES))).alias("x")).select("x.*")
    rows = train_rows(events, as_of, tz, max_rows=None, checkpoint=checkpoint, **thresholds)
    over = F.lit(False) if max_rows is None else F.col("r") > max_rows
    return broken.unionByName(rows.agg(F.lit("max_rows").alias("rule"), F.count_if(over).alias("n")))


def doc_labels(docs: DataFrame) -> DataFrame:
    """(userid, docid, w, tm, tl, wl) from :func:`doc_stats` rows."""
    return docs.select(
        "userid",
        "docid",
        F.shiftright("pw", _SHIFT).cast("int").alias("w"),
        F.col("pw").bitwiseAND(F.lit(_MASK)).alias("tm"),
        F.shiftright("pl", 3).alias("tl"),
        F.col("pl").bitwiseAND(F.lit(7)).cast("int").alias("wl"),
    )


def _items(labels: DataFrame) -> DataFrame:
    """One row per positive / strong-negative / weak slot of each doc.

    kind 0 = positive, 1 = strong negative, 2 = weak (blank when w > 0).
    """
    def item(kind: int, time: str, blank: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(time).alias("time"), blank.alias("blank"))

    slots = F.array(
        F.when(F.col("w").between(1, 3), item(0, "tm", F.lit(False))),
        F.when(F.col("w") == 4, item(1, "tm", F.lit(False))),
        F.when(F.col("wl") == 0, item(2, "tl", F.col("w") > 0)),
    )
    return labels.select("userid", "docid", F.explode(F.filter(slots, lambda x: x.isNotNull())).alias("s")).select(
        "userid", "docid", "s.kind", "s.time", "s.blank"
    )


def ranked_slots(labels: DataFrame, spread: bool = False) -> DataFrame:
    """Slots with ``r`` (positives), ``raw_pos``/``n`` (pool) and pool ``size``.

    All windows share the partitioning by ``userid`` (one exchange); with
    ``spread`` a user's slots lie in as many tasks as they need (see
    :mod:`clickweave.operators.ranking`), for users without an event cap.
    """
    items = _items(labels)
    is_pool = (F.col("kind") > 0).cast("int")
    is_positive = (F.col("kind") == 0).cast("int")
    nonblank_pool = ((F.col("kind") > 0) & ~F.col("blank")).cast("int")
    order = [is_pool, F.col("kind"), F.col("time").desc(), F.col("docid")]
    if spread:
        x = ranked_in_groups(items, ["userid"], order, {"_n": nonblank_pool}, {"_npos": is_positive, "size": is_pool}, "_rn")
    else:
        ordered = Window.partitionBy("userid").orderBy(*order)
        running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        per_user = Window.partitionBy("userid")
        x = items.select(
            "*",
            F.row_number().over(ordered).alias("_rn"),
            F.sum(nonblank_pool).over(running).alias("_n"),
            F.sum(is_positive).over(per_user).alias("_npos"),
            F.sum(is_pool).over(per_user).alias("size"),
        )
    pool = F.col("kind") > 0
    return x.select(
        "userid",
        "docid",
        "kind",
        "time",
        "blank",
        F.when(~pool, F.col("_rn")).alias("r"),
        F.when(pool, F.col("_rn") - F.col("_npos")).alias("raw_pos"),
        F.when(pool & ~F.col("blank"), F.col("_n")).alias("n"),
        "size",
    )


def negative_pool(labels: DataFrame) -> DataFrame:
    """(userid, raw_pos, docid, cls, blank, n, size): the ordered negative pool."""
    s = ranked_slots(labels)
    return s.filter(F.col("kind") > 0).select(
        "userid", "raw_pos", "docid", (F.col("kind") - 1).alias("cls"), "blank", "n", "size"
    )


def assemble_rows(slots: DataFrame, max_rows: int | None = MAX_ROWS_PER_USER) -> DataFrame:
    """(userid, pos, neg1, neg2, neg3, n_negs, r) from :func:`ranked_slots` (``max_rows`` None: no limit)."""
    g = F.floor((F.col("n") + 2) / 3).cast("int")
    j = ((F.col("n") - 1) % 3).cast("int")
    contrib = F.struct  # (slot, pos, j, neg, end)
    entries = F.when(
        F.col("kind") == 0,
        F.array(contrib(F.col("r").alias("slot"), F.col("docid").alias("pos"), F.lit(None).cast("int").alias("j"),
                        F.lit(None).cast("string").alias("neg"), F.lit(None).cast("bigint").alias("end"))),
    ).when(
        F.col("n").isNotNull(),
        F.filter(
            F.array(
                contrib(g.alias("slot"), F.lit(None).cast("string").alias("pos"), j.alias("j"),
                        F.col("docid").alias("neg"), F.lit(None).cast("bigint").alias("end")),
                # the third member of group g fixes where group g+1 starts
                F.when(j == 2, contrib((g + 1).alias("slot"), F.lit(None).cast("string").alias("pos"),
                                       F.lit(None).cast("int").alias("j"), F.lit(None).cast("string").alias("neg"),
                                       F.col("raw_pos").cast("bigint").alias("end"))),
            ),
            lambda x: x.isNotNull(),
        ),
    )
    e = slots.select("userid", "size", F.explode(entries).alias("e")).select("userid", "size", "e.*")
    agg = e.groupBy("userid", "slot").agg(
        F.max("pos").alias("pos"),
        F.max(F.when(F.col("j") == 0, F.col("neg"))).alias("neg1"),
        F.max(F.when(F.col("j") == 1, F.col("neg"))).alias("neg2"),
        F.max(F.when(F.col("j") == 2, F.col("neg"))).alias("neg3"),
        F.max("end").alias("prev_end"),
        F.max("size").alias("size"),
    )
    prev_end = F.when(F.col("slot") == 1, F.lit(0)).otherwise(F.col("prev_end"))
    keep = F.col("pos").isNotNull() & (F.col("size") - prev_end >= 3)
    if max_rows is not None:
        keep = keep & (F.col("slot") <= max_rows)
    return agg.filter(keep).select(
        "userid",
        "pos",
        "neg1",
        "neg2",
        "neg3",
        (F.col("neg1").isNotNull().cast("int") + F.col("neg2").isNotNull().cast("int")
         + F.col("neg3").isNotNull().cast("int")).alias("n_negs"),
        F.col("slot").alias("r"),
    )


def qualified_doc_labels(
    events: DataFrame,
    as_of: str | None = None,
    tz: str = DEFAULT_TIME_ZONE,
    checkpoint: bool = True,
    **thresholds,
) -> DataFrame:
    """Doc labels of qualified users only (unqualified users never reach a window).

    ``checkpoint`` materialises the (user, doc) aggregate and the qualified
    users once (see :func:`materialize`); turn it off for tiny inputs.

    Skew: the qualified users are a written table of known size, so Spark
    either broadcasts them and every other user is dropped map-side, or joins
    two plain exchanges, in which AQE splits the rows of any heavy user. A user
    over the cap thus never lands whole in one task, however many there are.
    """
    ds = doc_stats(events)
    if checkpoint:
        ds = materialize(ds, "doc-stats")
    q = qualified_users(user_stats_from_docs(ds), as_of=as_of, tz=tz, **thresholds).select("userid")
    if checkpoint:
        q = materialize(q, "qualified-users")
    return doc_labels(ds.join(q, "userid", "left_semi"))


def train_rows(
    events: DataFrame,
    as_of: str | None = None,
    tz: str = DEFAULT_TIME_ZONE,
    max_rows: int | None = MAX_ROWS_PER_USER,
    checkpoint: bool = True,
    spread: bool | None = None,
    **thresholds,
) -> DataFrame:
    """(userid, pos, neg1, neg2, neg3, n_negs, r) training rows.

    ``spread`` ranks each user's slots in several tasks; by default it is on
    when ``max_events=None`` lets users of any size through.
    """
    labels = qualified_doc_labels(events, as_of, tz, checkpoint=checkpoint, **thresholds)
    if spread is None:
        spread = thresholds.get("max_events", MAX_EVENTS_PER_USER) is None
    return assemble_rows(ranked_slots(labels, spread), max_rows)


def render_train_rows(rows: DataFrame) -> DataFrame:
    """Rows -> ``user\\tpos\\tneg...`` text lines (absent negatives are not printed)."""
    return rows.select(F.concat_ws("\t", "userid", "pos", "neg1", "neg2", "neg3").alias("value"))


def shuffle_rows(rows: DataFrame, num_partitions: int | None = 100, seed: int = 0) -> DataFrame:
    """Spread rows over ``num_partitions`` and put them in random order in each.

    ``num_partitions=None`` spreads them round-robin into partitions of the
    advisory size chosen by AQE (``rebalance``), for volumes where a fixed
    count would make partitions too large. The order differs from run to run;
    see :func:`permute_rows` for one that does not.
    """
    spread = rows.repartition(num_partitions) if num_partitions else rows.hint("rebalance")
    return spread.sortWithinPartitions(F.rand(seed))


def permute_rows(rows: DataFrame, num_partitions: int = 100, seed: int = 0) -> DataFrame:
    """Rows in a random order that depends on ``seed`` and the rows alone.

    A row's key is the MD5 of the seed and its columns' JSON text: the key's
    first 32 bits deal it to a partition, the whole key orders it there (ties
    are equal rows). So the same rows give the same files however the input
    was laid out or read, and a task that is run again writes the same rows.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.to_json(F.struct(*(F.col(f"`{c}`") for c in rows.columns)), {"ignoreNullFields": "false"})))
    keyed = rows.withColumn("__key", key)
    part = F.conv(F.substring("__key", 1, 8), 16, 10).cast("long") % num_partitions
    return keyed.repartitionById(num_partitions, part.cast("int")).sortWithinPartitions("__key").drop("__key")


def with_position(rows: DataFrame, partition: str = "partition", position: str = "position") -> DataFrame:
    """``rows`` with the number of their partition and their place in it (0, 1, 2...)."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return rows.select("*", F.spark_partition_id().alias(partition), place.alias(position))
