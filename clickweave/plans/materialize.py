"""Write adapter output as file trees in the shared work folder, once per input.

Scan queries need real files (gzip hour directories, document day
directories, TSV outputs). They are written by Spark from the driver tables
under ``spark.checkpoint.dir`` and reused while the input files are unchanged.
All bookkeeping goes through Hadoop's file systems, so any URI form works.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from clickweave.session import work_path


def _code_digest() -> str:
    pkg = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    h = hashlib.sha1()
    for root, _, files in sorted(os.walk(pkg)):
        for name in sorted(files):
            if name.endswith(".py"):
                with open(os.path.join(root, name), "rb") as f:
                    h.update(name.encode() + f.read())
    return h.hexdigest()


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _stamp(spark: SparkSession, sf_dir: str, tables: tuple[str, ...]) -> str:
    """Key of a cached build: input path, the input files' names, sizes and
    times, and the package's code (builds run adapters and operators, so any
    code change rebuilds)."""
    h = hashlib.sha1(_code_digest().encode())
    for t in tables:
        p, fs = _fs(spark, f"{sf_dir.rstrip('/')}/{t}.parquet")
        h.update(fs.makeQualified(p).toString().encode())
        if fs.exists(p):
            status = fs.getFileStatus(p)
            files = fs.listStatus(p) if status.isDirectory() else [status]
            seen = sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files)
            h.update(repr(seen).encode())
    return h.hexdigest()[:16]


def materialized(
    spark: SparkSession, sf_dir: str, name: str, tables: tuple[str, ...], write: Callable[[str], None]
) -> str:
    """Path of ``name`` built by ``write(path)`` for the tables of ``sf_dir``.

    Every builder writes its own directory and then publishes a ``READY-<id>``
    marker; readers take the first published build. Concurrent runs therefore
    never write into the same directory.
    """
    base = work_path(spark, f"{name}-{_stamp(spark, sf_dir, tables)}")
    markers, fs = _fs(spark, f"{base}/READY-*")
    ready = sorted(f.getPath().getName() for f in fs.globStatus(markers) or [])
    if ready:
        return f"{base}/{ready[0][len('READY-'):]}"
    build = uuid.uuid4().hex[:12]
    write(f"{base}/{build}")
    marker, fs = _fs(spark, f"{base}/READY-{build}")
    fs.create(marker).close()
    return f"{base}/{build}"
