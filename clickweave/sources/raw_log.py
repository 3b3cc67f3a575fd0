"""Raw behaviour-log scans: text lines from gzip files, hour-range selection, unions.

Layout of a raw log tree: ``<base>/<day dir>/<hour dir>/<file>.gz`` where the day
and hour directory names come from templates (``{day}`` = yyyy-MM-dd,
``{hour}`` = HH), e.g. ``2024-01-01/05`` or ``dt=2024-01-01/hour=05``.

An hour range becomes ONE Hadoop brace glob, so only the wanted directories are
listed; whole days in the middle are matched with one ``day/*`` alternative.
Each gzip file is one (unsplittable) task; callers that need more parallelism
downstream repartition after their filters, not here.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from clickweave.functions.time import hours_in_range

TEXT_SCHEMA = T.StructType([T.StructField("value", T.StringType())])


def _empty(spark: SparkSession, with_path: bool = False) -> DataFrame:
    return spark.createDataFrame([], "value string, path string" if with_path else TEXT_SCHEMA)


def _matches(spark: SparkSession, pattern: str) -> bool:
    """True when the Hadoop glob ``pattern`` matches at least one path (driver-side listing)."""
    try:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(pattern)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    except Exception:  # no JVM gateway (e.g. a remote client): let the reader decide
        return True
    found = fs.globStatus(path)
    return found is not None and len(found) > 0


_WHITESPACE = " \t\r\n\f\v"


def _not_blank(value: Column) -> Column:
    """False for an empty or whitespace-only line.

    A blank line must start with whitespace, so the (copying) trim runs only
    for the rare lines that do; every other line is kept after a one-character
    test.
    """
    first = F.substring(value, 1, 1)
    return F.when(
        (F.length(value) == 0) | first.isin(*_WHITESPACE), F.length(F.btrim(value, F.lit(_WHITESPACE))) > 0
    ).otherwise(F.lit(True))


def read_text_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    gz_only: bool = False,
    skip_blank: bool = True,
    allow_empty: bool = True,
    with_path: bool = False,
) -> DataFrame:
    """``value`` string (``with_path``: and ``path``, the file's) per text line of every file matched by ``paths`` (globs ok).

    ``gz_only`` keeps only ``*.gz`` files (decoded transparently by extension).
    ``allow_empty`` turns a glob with no match into an empty result; without it
    every given path must match something, or :class:`FileNotFoundError` is
    raised before anything is read (the jobs do so, lest a mistyped path
    overwrite good output with nothing).
    """
    reader = spark.read
    if gz_only:
        reader = reader.option("pathGlobFilter", "*.gz")
    plist = [paths] if isinstance(paths, str) else list(paths)
    if not allow_empty and (missing := [p for p in plist if not _matches(spark, p)]):
        raise FileNotFoundError(f"no input matches {', '.join(missing)}")
    if allow_empty and len(plist) > 1:
        plist = [p for p in plist if _matches(spark, p)]
        if not plist:
            return _empty(spark, with_path)
    try:
        df = reader.text(plist)
    except AnalysisException as e:
        if allow_empty and "PATH_NOT_FOUND" in str(e):
            return _empty(spark, with_path)
        raise
    df = df.select("value", F.col("_metadata.file_path").alias("path")) if with_path else df.select("value")
    if skip_blank:  # whitespace-only lines (any whitespace, as str.strip) carry no record
        df = df.filter(_not_blank(F.col("value")))
    return df


def scan_raw_log(spark: SparkSession, paths: str | Sequence[str], gz_only: bool = True) -> DataFrame:
    """Scan raw JSON log lines (one record per line) from gzip files."""
    return read_text_lines(spark, paths, gz_only=gz_only)


def hour_range_glob(
    base: str,
    start: str,
    end: str,
    day_dir: str = "{day}",
    hour_dir: str = "{hour}",
) -> str:
    """One brace glob selecting hours ``start..end`` (``yyyy-MM-dd-HH``, inclusive).

    Partial first/last days list their hours; whole days match ``<day>/*``.
    Each hour is selected exactly once.
    """
    hours = hours_in_range(start, end)
    by_day: dict[str, list[str]] = {}
    for h in hours:
        by_day.setdefault(h.strftime("%Y-%m-%d"), []).append(h.strftime("%H"))
    alts: list[str] = []
    for day, hs in by_day.items():
        ddir = day_dir.format(day=day)
        if len(hs) == 24:
            alts.append(f"{ddir}/*")
        else:
            alts.extend(f"{ddir}/{hour_dir.format(hour=h)}" for h in hs)
    inner = alts[0] if len(alts) == 1 else "{" + ",".join(alts) + "}"
    return f"{base.rstrip('/')}/{inner}/*"


def hour_range_scan(
    spark: SparkSession,
    base: str,
    start: str,
    end: str,
    day_dir: str = "{day}",
    hour_dir: str = "{hour}",
    gz_only: bool = True,
    allow_empty: bool = True,
) -> DataFrame:
    """Raw lines of every file in hours ``start..end``; missing hours are skipped (see :func:`missing_hours`)."""
    return read_text_lines(
        spark, hour_range_glob(base, start, end, day_dir, hour_dir), gz_only=gz_only, allow_empty=allow_empty
    )


def missing_hours(
    spark: SparkSession, base: str, start: str, end: str, day_dir: str = "{day}", hour_dir: str = "{hour}"
) -> list[str]:
    """The hours (``yyyy-MM-dd-HH``) of ``start..end`` without a directory that holds files.

    One listing per day that the range touches (driver-side, names only).
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    by_day: dict[str, list[str]] = {}
    for h in hours_in_range(start, end):
        by_day.setdefault(h.strftime("%Y-%m-%d"), []).append(h.strftime("%H"))
    out = []
    for day, hours in by_day.items():
        path = jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{day_dir.format(day=day)}/*/*")
        found = path.getFileSystem(conf).globStatus(path) or []
        held = {f.getPath().getParent().getName() for f in found}
        out += [f"{day}-{h}" for h in hours if hour_dir.format(hour=h).split("/")[-1] not in held]
    return out


def union_logs(spark: SparkSession, path_sets: Iterable[str | Sequence[str]], gz_only: bool = True) -> DataFrame:
    """Bag union of several scans: a file matched by two scans is read twice.

    Each scan stays its own file source (no shuffle); ``unionByName`` only
    concatenates partitions.
    """
    out = None
    for p in path_sets:
        df = read_text_lines(spark, p, gz_only=gz_only)
        out = df if out is None else out.unionByName(df)
    return out if out is not None else _empty(spark)
