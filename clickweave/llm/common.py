"""Helpers shared by the operators."""

from __future__ import annotations

import sys
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of the contracts: blank, tab, LF, VT, FF, CR (what ``bytes.split()`` splits at).
ASCII_SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(c: Column) -> Column:
    """``c`` with A-Z lower-cased and every other character unchanged."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def hashed_fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds`` (a null key: as the empty text)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % F.lit(folds)


def per_worker(key: Any, make: Callable[[], Any]) -> Any:
    """``make()`` once per Python worker process and ``key``."""
    store = sys.__dict__.setdefault("_clickweave_worker", {})
    if key not in store:
        store[key] = make()
    return store[key]


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a stage table that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
