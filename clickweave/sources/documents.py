"""Document NDJSON scans over day directories of one or more roots."""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.functions.time import days_in_range
from clickweave.sources.raw_log import read_text_lines


def doc_day_glob(roots: Sequence[str], start: str, end: str, day_dir: str = "{day}", depth: int = 2) -> str:
    """One glob over ``{root1,root2}/{day1,...}/*[/*]`` for days ``start..end`` inclusive.

    ``depth`` is the number of levels below a day directory (2 = hour dir + file).
    """
    days = [d.strftime("%Y-%m-%d") for d in days_in_range(start, end)]
    dpart = "{" + ",".join(day_dir.format(day=d) for d in days) + "}" if len(days) > 1 else day_dir.format(day=days[0])
    rs = [r.rstrip("/") for r in roots]
    if len(rs) == 1:
        rpart = rs[0]
    else:
        # a glob may not start with a brace: keep the common parent outside it
        parent = os.path.commonpath(rs) if all("://" not in r for r in rs) else _common_parent(rs)
        rest = [r[len(parent):].lstrip("/") for r in rs]
        rpart = f"{parent}/{{{','.join(rest)}}}"
    return f"{rpart}/{dpart}" + "/*" * depth


def _common_parent(paths: Sequence[str]) -> str:
    parts = [p.split("/") for p in paths]
    common = []
    for segs in zip(*parts):
        if len(set(segs)) != 1:
            break
        common.append(segs[0])
    return "/".join(common)


def scan_doc_days(
    spark: SparkSession,
    roots: Sequence[str],
    start: str,
    end: str,
    day_dir: str = "{day}",
    depth: int = 2,
    allow_empty: bool = True,
    with_origin: bool = False,
) -> DataFrame:
    """Document JSON lines of every day in ``start..end``.

    ``with_origin`` adds ``day`` (a date, read from the day directory) and
    ``file`` (the path below it), for callers to whom the order of days matters.
    """
    glob = doc_day_glob(roots, start, end, day_dir, depth)
    lines = read_text_lines(spark, glob, gz_only=False, allow_empty=allow_empty, with_path=with_origin)
    if not with_origin:
        return lines
    before, after = (re.escape(x) for x in day_dir.split("{day}"))
    place = f"/{before}([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}){after}((?:/[^/]+){{{depth}}})$"
    return lines.select(
        "value",
        F.to_date(F.regexp_extract("path", place, 1)).alias("day"),
        F.regexp_extract("path", place, 2).alias("file"),
    )
