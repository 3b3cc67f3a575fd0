"""JSON record parsing: one ``from_json`` per line with a declared, narrow schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.functions.codes import APP_IDS, BROWSER_IDS
from clickweave.functions.columns import evaluate_once
from clickweave.sources.schemas import CORRUPT, raw_log_schema

PARSED = "r"


def parse_raw(lines: DataFrame, *fields: str, keep_line: bool = False) -> DataFrame:
    """``value`` JSON lines -> one column per requested top-level field.

    Adds two flags:

    * ``_bad``: the line does not fit the declared shape — not a JSON object,
      or a declared field of the wrong JSON type (that field is then NULL, the
      others are still parsed).
    * ``_not_object``: the line is not a JSON object at all (syntax error or
      e.g. an array). Checked with a second parse only for the lines already
      flagged by the first, so the common path parses once.
    """
    schema = raw_log_schema(*fields)
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    cols = [F.col(f"{PARSED}.{n}").alias(n) for n in (fields or schema.fieldNames()[:-1])]
    corrupt = F.col(f"{PARSED}.{CORRUPT}")
    bad = F.col(PARSED).isNull() | corrupt.isNotNull()
    not_object = not_an_object(F.col(PARSED), corrupt)
    out = lines.select("value", parse_once(parsed).alias(PARSED))
    return out.select(
        *(["value"] if keep_line else []), *cols, bad.alias("_bad"), not_object.alias("_not_object")
    )


def not_an_object(parsed: Column, corrupt: Column) -> Column:
    """Whether the line ``value`` is no JSON object at all; a second parse, only for lines flagged by the first."""
    return parsed.isNull() | F.when(
        corrupt.isNotNull(),
        F.try_parse_json("value").isNull() | ~F.ltrim("value").startswith("{"),
    ).otherwise(F.lit(False))


def parse_once(parsed: Column) -> Column:
    """Evaluate ``parsed`` exactly once per row.

    A plain projection would let the optimizer copy ``from_json`` into every
    filter pushed below it (parsing each line twice or more). Producing the
    struct from a one-element ``explode`` makes it a generator output, which
    filters cannot be pushed beneath (see :func:`evaluate_once`).
    """
    return evaluate_once(parsed)


def key_state(record: Column, path: str) -> Column:
    """``absent``, ``null`` or ``value``: what the variant ``record`` has at
    ``path`` (keys joined by dots). Below a key that is absent, null or no
    object everything is absent."""
    found = F.try_variant_get(record, "$." + path, "variant")
    return F.when(found.isNull(), "absent").when(F.is_variant_null(found), "null").otherwise("value")


def key_states(lines: DataFrame, *paths: str) -> DataFrame:
    """``value`` lines with a column per path (dots as ``_``): the key's state,
    null for lines that are no JSON object. Each line is parsed once."""
    record = F.try_parse_json("value")
    v = lines.select("value", evaluate_once(F.when(F.ltrim("value").startswith("{"), record)).alias("v"))
    return v.select("value", *(F.when(F.col("v").isNotNull(), key_state(F.col("v"), p)).alias(p.replace(".", "_")) for p in paths))


def has_key(state: Column, explicit_null: str = "absent") -> Column:
    """Whether a key counts as there. ``explicit_null="present"`` also takes keys
    whose value is null, as a map's ``containsKey`` does; ``"absent"`` does not."""
    if explicit_null not in ("absent", "present"):
        raise ValueError("explicit_null must be 'absent' or 'present'")
    return F.coalesce(state == "value" if explicit_null == "absent" else state != "absent", F.lit(False))


def platform_of(appid: Column | str = "appid") -> Column:
    """Platform label of an appid: ``app_<id>``, ``<id>`` for browsers, else ``other_<id>``."""
    a = F.col(appid) if isinstance(appid, str) else appid
    return (
        F.when(a.isin(*APP_IDS), F.concat(F.lit("app_"), a))
        .when(a.isin(*BROWSER_IDS), a)
        .otherwise(F.concat(F.lit("other_"), a))
    )


def platform_classify(parsed: DataFrame) -> DataFrame:
    """(userid, appid, platform) for every well-formed record with an appid."""
    return parsed.filter(~F.col("_bad") & F.col("appid").isNotNull()).select(
        "userid", "appid", platform_of("appid").alias("platform")
    )
