"""Raw log -> normalised events ``userid docid event date platform``.

A record with ``views`` yields one ``vw`` row per element; otherwise a record
with ``click`` yields one row with the event code; ``views`` wins when both are
present. Everything happens in ONE pass over the lines (an ``explode`` of a
per-record array), so the input is scanned and parsed once; no shuffle.

Records the reference job would have turned into an exception text are kept
out of the data and returned by :func:`quarantine_events` with a reason:

  bad_json          not a JSON object (syntax error, or e.g. an array)
  bad_shape         a JSON object with a field of the wrong type (e.g. ``views``
                    not a list, ``details`` not an object): the original
                    parser throws there
  missing_userid    no ``userid``
  missing_appid     no ``appid``
  missing_docid     a click without ``docid``
  bad_dwell         a ``clickDoc`` click without ``details.dwell`` or with a
                    dwell that is not a number
  bad_view          a ``views`` element that is no object: the elements before
                    it are kept, it and those behind it are not
  odd_views         (every_second only) a ``views`` list of odd length

Only the fields that a record uses are judged: with ``views`` present, its
``click`` is not looked at. Every line is parsed once, with the declared types;
lines that do not fit them are read again, ``views`` elements and ``click`` as
JSON text that is parsed where it is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave.functions.codes import CLICK_EVENT_CODES, UNKNOWN_EVENT_CODE, VIEW_EVENT_CODE
from clickweave.functions.columns import bind
from clickweave.operators.parse import not_an_object, platform_of
from clickweave.sources.schemas import CLICK, CORRUPT, VIEW_ITEM, raw_log_schema

EVENT_COLUMNS = ("userid", "docid", "event", "date", "platform")


def event_code(event: Column) -> Column:
    """click.event -> short code; unknown or missing -> ``"None"``."""
    m = F.create_map(*[x for k, v in CLICK_EVENT_CODES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[event], F.lit(UNKNOWN_EVENT_CODE))


def _dwell_value() -> Column:
    return F.col("click.details.dwell").try_cast("float")


def _reason(every_second: bool) -> Column:
    has_views = F.col("views").isNotNull()
    click_only = ~has_views & F.col("_has_click")
    r = (
        F.when(F.col("_not_object"), F.lit("bad_json"))
        .when(F.col("_bad") | (click_only & F.col("_bad_click")), F.lit("bad_shape"))
        .when(F.col("userid").isNull(), F.lit("missing_userid"))
        .when(F.col("appid").isNull(), F.lit("missing_appid"))
        .when(click_only & F.col("click.docid").isNull(), F.lit("missing_docid"))
        .when(click_only & (F.col("click.event") == "clickDoc") & _dwell_value().isNull(), F.lit("bad_dwell"))
    )
    r = r.when(has_views & (F.size("views") < F.col("_n_views")), F.lit("bad_view"))
    if every_second:
        r = r.when(has_views & (F.col("_n_views") % 2 == 1), F.lit("odd_views"))
    return r


#: Reasons of records that still yield rows.
PARTIAL_REASONS = ("bad_view", "odd_views")


def _with_corrupt(fields: T.StructType) -> T.StructType:
    return T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])


_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
_TEXT_FIELDS = f"userid string, appid string, views array<string>, click string, {CORRUPT} string"


def _typed_record(r: Column) -> Column:
    """The fields that :func:`_reason` reads, of a line that fits the declared types."""
    return F.struct(
        r["userid"].alias("userid"), r["appid"].alias("appid"), r["views"].alias("views"), r["click"].alias("click"),
        F.lit(False).alias("_bad"), F.lit(False).alias("_not_object"), r["click"].isNotNull().alias("_has_click"),
        F.size(r["views"]).alias("_n_views"), F.lit(False).alias("_bad_click"),
    )


def _text_record(r: Column) -> Column:
    """The same fields of any other line; ``r`` holds ``views`` elements and ``click`` as JSON text.

    ``views`` keeps the elements before the first one that is no object; the
    click of a record with views is not parsed.
    """
    corrupt = r[CORRUPT]
    views = F.transform(r["views"], lambda v: F.from_json(v, _with_corrupt(VIEW_ITEM), _PERMISSIVE))
    click = F.when(r["views"].isNull(), F.from_json(r["click"], _with_corrupt(CLICK), _PERMISSIVE))
    item = VIEW_ITEM.simpleString()

    def judged(v: Column) -> Column:
        at = F.array_position(F.transform(v, lambda x: x.isNull() | x[CORRUPT].isNotNull()), F.lit(True))
        whole = F.transform(v, lambda x: F.struct(*(x[c].alias(c) for c in VIEW_ITEM.fieldNames())))
        return F.when(at > 0, F.slice(whole, F.lit(1), (at - 1).cast("int"))).otherwise(whole).cast(f"array<{item}>")

    def record(c: Column) -> Column:
        return F.struct(
            r["userid"].alias("userid"), r["appid"].alias("appid"), bind(views, judged).alias("views"),
            F.when(c.isNotNull(), F.struct(*(c[f].alias(f) for f in CLICK.fieldNames()))).alias("click"),
            (r.isNull() | corrupt.isNotNull()).alias("_bad"), not_an_object(r, corrupt).alias("_not_object"),
            r["click"].isNotNull().alias("_has_click"), F.size(r["views"]).alias("_n_views"),
            (c.isNull() | c[CORRUPT].isNotNull()).alias("_bad_click"),
        )

    return bind(click, record)


def _parse_events(lines: DataFrame) -> DataFrame:
    """value, userid, appid, views, click and the flags that :func:`_reason` reads.

    One ``explode`` of a one-element array (see :func:`evaluate_once`): a good
    line is parsed once, and only a line that does not fit goes on to the text form.
    """

    def record(r: Column) -> Column:
        odd = r.isNull() | r[CORRUPT].isNotNull() | F.coalesce(F.exists(r["views"], lambda v: v.isNull()), F.lit(False))
        return F.when(odd, bind(F.from_json("value", _TEXT_FIELDS, _PERMISSIVE), _text_record)).otherwise(_typed_record(r))

    typed = F.from_json("value", raw_log_schema("userid", "appid", "views", "click"), _PERMISSIVE)
    return lines.select("value", F.explode(F.transform(F.array(typed), record)).alias("p")).select("value", "p.*")


def parse_with_reason(lines: DataFrame, every_second: bool = False) -> DataFrame:
    """Parsed records with their line and ``_reason`` (NULL = good record)."""
    return _parse_events(lines).withColumn("_reason", _reason(every_second))


_with_reason = parse_with_reason


def _items(every_second: bool, min_dwell: bool, drop_compound: bool, drop_unknown: bool) -> Column:
    """Per-record array of (docid, event, date) rows to explode."""
    views = F.col("views")
    if every_second:
        # the reference consumes two elements per step and keeps the second
        views = F.filter(views, lambda x, i: i % 2 == 1)
    view_rows = F.transform(
        views,
        lambda v: F.struct(v["docid"].alias("docid"), F.lit(VIEW_EVENT_CODE).alias("event"), v["date"].alias("date")),
    )
    code = event_code(F.col("click.event"))
    keep = F.lit(True)
    if drop_unknown:
        keep = keep & (code != UNKNOWN_EVENT_CODE)
    if min_dwell:
        d = _dwell_value()
        keep = keep & ~((code == "clk") & (d > 0) & (d < 8))
    if drop_compound:
        keep = keep & ~F.col("click.docid").contains("_")
    click_row = F.struct(
        F.col("click.docid").alias("docid"), code.alias("event"), F.col("click.date").alias("date")
    )
    empty = F.array().cast("array<struct<docid:string,event:string,date:string>>")
    return (
        F.when(F.col("views").isNotNull(), view_rows)
        .when(F.col("click").isNotNull() & keep, F.array(click_row))
        .otherwise(empty)
    )


def normalise_events(
    lines: DataFrame,
    every_second: bool = False,
    min_dwell: bool = False,
    drop_compound: bool = False,
    drop_unknown: bool = False,
    kinds: tuple[str, ...] = ("views", "click"),
) -> DataFrame:
    """Raw JSON lines -> (userid, docid, event, date, platform).

    Options re-create the reference's variants: ``every_second`` keeps only the
    odd-indexed view elements; ``min_dwell`` drops ``clk`` with 0 < dwell < 8;
    ``drop_compound`` drops click docids containing ``_``; ``drop_unknown``
    drops the ``"None"`` code. ``kinds`` restricts to view or click records.
    """
    return events_from_parsed(_with_reason(lines, every_second), every_second, min_dwell, drop_compound,
                              drop_unknown, kinds)


def events_from_parsed(
    parsed: DataFrame,
    every_second: bool = False,
    min_dwell: bool = False,
    drop_compound: bool = False,
    drop_unknown: bool = False,
    kinds: tuple[str, ...] = ("views", "click"),
) -> DataFrame:
    """:func:`normalise_events` on the output of :func:`parse_with_reason`."""
    reason = F.col("_reason")
    p = parsed.filter(reason.isNull() | reason.isin(*PARTIAL_REASONS))
    if kinds == ("views",):
        p = p.filter(F.col("views").isNotNull())
    elif kinds == ("click",):
        p = p.filter(F.col("views").isNull())
    item = F.explode(_items(every_second, min_dwell, drop_compound, drop_unknown)).alias("e")
    return p.select("userid", platform_of("appid").alias("platform"), item).select(
        "userid", "e.docid", "e.event", "e.date", "platform"
    )


def view_events(lines: DataFrame, every_second: bool = False) -> DataFrame:
    return normalise_events(lines, every_second=every_second, kinds=("views",))


def click_events(
    lines: DataFrame, min_dwell: bool = False, drop_compound: bool = False, drop_unknown: bool = False
) -> DataFrame:
    return normalise_events(
        lines, min_dwell=min_dwell, drop_compound=drop_compound, drop_unknown=drop_unknown, kinds=("click",)
    )


def quarantine_events(lines: DataFrame, every_second: bool = False) -> DataFrame:
    """(value, reason) for every record kept out of :func:`normalise_events`.

    Records with a :data:`PARTIAL_REASONS` reason (a bad ``views`` element; with
    ``every_second`` an odd-length list) are reported here AND still yield rows.
    """
    return quarantine_from_parsed(_with_reason(lines, every_second))


def quarantine_from_parsed(parsed: DataFrame) -> DataFrame:
    """:func:`quarantine_events` on the output of :func:`parse_with_reason`."""
    return parsed.filter(F.col("_reason").isNotNull()).select("value", F.col("_reason").alias("reason"))


def normalise_with_quarantine(
    lines: DataFrame,
    every_second: bool = False,
    min_dwell: bool = False,
    drop_compound: bool = False,
    drop_unknown: bool = False,
) -> DataFrame:
    """(kind, value) text lines from ONE pass: ``kind = "events"`` lines are the
    normalised TSV (see :func:`render_tsv`), ``kind = "quarantine"`` lines are
    ``reason\traw line``. Write with ``partitionBy("kind")`` to get both outputs
    from a single scan and parse.
    """
    p = _with_reason(lines, every_second)
    items = _items(every_second, min_dwell, drop_compound, drop_unknown)
    platform = platform_of("appid")

    def nul(c: Column) -> Column:
        return F.coalesce(c, F.lit("null"))

    events = F.transform(
        items,
        lambda e: F.struct(
            F.lit("events").alias("kind"),
            F.concat_ws("\t", nul(F.col("userid")), nul(e["docid"]), nul(e["event"]), nul(e["date"]),
                        nul(platform)).alias("value"),
        ),
    )
    reject = F.array(F.struct(F.lit("quarantine").alias("kind"),
                              F.concat_ws("\t", F.col("_reason"), F.col("value")).alias("value")))
    reason = F.col("_reason")
    out = (
        F.when(reason.isNull(), events)
        .when(reason.isin(*PARTIAL_REASONS), F.concat(events, reject))
        .otherwise(reject)
    )
    return p.select(F.explode(out).alias("o")).select("o.kind", "o.value")


def render_tsv(events: DataFrame, columns=EVENT_COLUMNS) -> DataFrame:
    """Events -> one ``value`` TSV line each; a missing value prints as ``null``."""
    return events.select(
        F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns]).alias("value")
    )
