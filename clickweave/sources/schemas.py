"""Declared schemas for every source; nothing is inferred.

Each operator parses with the narrowest schema it needs, so ``from_json`` only
materialises the fields that are read.
"""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

VIEW_ITEM = T.StructType([T.StructField("docid", T.StringType()), T.StructField("date", T.StringType())])
CLICK = T.StructType(
    [
        T.StructField("event", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("docid", T.StringType()),
        T.StructField("details", T.StructType([T.StructField("dwell", T.StringType())])),
    ]
)
VIEW = T.StructType(
    [
        T.StructField("channelType", T.StringType()),
        T.StructField(
            "details",
            T.StructType([T.StructField("mashtype", T.StringType()), T.StructField("pos", T.StringType())]),
        ),
    ]
)

RAW_FIELDS = {
    "userid": T.StringType(),
    "appid": T.StringType(),
    "type": T.StringType(),
    "views": T.ArrayType(VIEW_ITEM),
    "click": CLICK,
    "view": VIEW,
}


def raw_log_schema(*fields: str, corrupt: bool = True) -> T.StructType:
    """Raw log record schema restricted to ``fields`` (all when none given)."""
    names = fields or tuple(RAW_FIELDS)
    cols = [T.StructField(n, RAW_FIELDS[n]) for n in names]
    if corrupt:
        cols.append(T.StructField(CORRUPT, T.StringType()))
    return T.StructType(cols)


DOC_RECORD = T.StructType(
    [
        T.StructField("_id", T.StringType()),
        T.StructField("ctype", T.StringType()),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

# scorer reply: two parallel nested lists
HTC_KEY = T.ArrayType(T.ArrayType(T.StringType()))
HTC_VALUE = T.ArrayType(T.ArrayType(T.DoubleType()))
REPLY = T.StructType([T.StructField("htc_key", HTC_KEY), T.StructField("htc_value", HTC_VALUE)])

NORMALISED_EVENT_COLUMNS = ("userid", "docid", "event", "date", "platform")
