"""A feature table in buckets of its key, of which an update rewrites only those it touches.

``<path>/data/version=<v>/bucket=<b>/`` holds the rows of bucket ``b`` as
version ``v`` wrote them, ``<path>/manifest/version=<v>/`` one row per bucket:
the version whose files hold it, and the schema of the rows. A version is there once its manifest is
written, which comes last; earlier versions stay readable, and a failed update
leaves nothing that a reader would look at.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave.operators.enrich import FEATURES, insert_new, latest_per_key, update_matched

BUCKET = "bucket"
PLACES = ("version", BUCKET)


def bucket_of(key: Column | str, buckets: int) -> Column:
    """Bucket of a key: the first 32 bits of its MD5 modulo ``buckets`` (a null key: as the empty text)."""
    c = F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("long") % buckets).cast("int")


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions of the store, in order (listed through Hadoop's file systems)."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/manifest/version=*/_SUCCESS")
    found = done.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(done) or []
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)


class Manifest(NamedTuple):
    version: int
    placed: dict[int, int]  #: bucket -> version that wrote it
    schema: T.StructType


def _manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest:
    """The manifest of a version (default: the newest): as many rows as buckets."""
    known = versions(spark, path)
    if not known or (version is not None and version not in known):
        raise FileNotFoundError(f"no such version of a store at {path}")
    at = known[-1] if version is None else version
    rows = spark.read.parquet(f"{path.rstrip('/')}/manifest/version={at}").collect()
    return Manifest(at, {r[BUCKET]: r["written"] for r in rows}, T.StructType.fromJson(json.loads(rows[0]["schema"])))


def _write(rows: DataFrame, path: str, manifest: Manifest) -> None:
    """Write ``rows`` (with their bucket) as the manifest's version, then the manifest."""
    spark, base = rows.sparkSession, path.rstrip("/")
    rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{base}/data/version={manifest.version}")
    listing = [(b, v, manifest.schema.json()) for b, v in sorted(manifest.placed.items())]
    placed = spark.createDataFrame(listing, f"{BUCKET} int, written int, schema string")
    placed.coalesce(1).write.parquet(f"{base}/manifest/version={manifest.version}")


def create_store(rows: DataFrame, path: str, key: str = "_id", buckets: int = 256) -> None:
    """A new store at ``path`` from ``rows`` as its version 1."""
    if versions(rows.sparkSession, path):
        raise FileExistsError(f"a store is at {path}")
    manifest = Manifest(1, dict.fromkeys(range(buckets), 1), rows.schema)
    _write(rows.withColumn(BUCKET, bucket_of(key, buckets)), path, manifest)


def _read(spark: SparkSession, path: str, manifest: Manifest, only: Sequence[int] | None = None) -> DataFrame:
    """Rows of the buckets ``only`` (default: all), with their places; a partition
    filter keeps each bucket to the version that holds it."""
    base = f"{path.rstrip('/')}/data"
    by_version: dict[int, list[int]] = {1: []}
    for b, v in manifest.placed.items():
        if only is None or b in set(only):
            by_version.setdefault(v, []).append(b)
    schema = T.StructType([*manifest.schema.fields, *(T.StructField(c, T.IntegerType()) for c in PLACES)])
    paths = [f"{base}/version={v}" for v in sorted(by_version)]
    here = F.lit(False)
    for v, bs in sorted(by_version.items()):
        here = here | ((F.col("version") == v) & F.col(BUCKET).isin(bs))
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).filter(here)


def read_store(spark: SparkSession, path: str, version: int | None = None, with_places: bool = False) -> DataFrame:
    """The rows of a version (default: the newest). ``with_places`` adds
    ``version`` and ``bucket``: who wrote the row's bucket, and which it is."""
    rows = _read(spark, path, _manifest(spark, path, version))
    return rows if with_places else rows.drop(*PLACES)


def update_store(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    mode: str = "update",
    key: str = "_id",
    columns: Sequence[str] = FEATURES,
    order: Sequence[Column | str] = (),
) -> list[int]:
    """Apply ``updates`` as a new version and return the buckets that it rewrote.

    ``mode="update"`` sets ``columns`` of the keys in the store, as
    :func:`update_matched` does; ``mode="insert"`` adds the keys that are not,
    as :func:`insert_new` does. Only buckets with such a key are written; those
    that the updates cannot concern are not even read.
    """
    if mode not in ("update", "insert"):
        raise ValueError("mode must be 'update' or 'insert'")
    manifest = _manifest(spark, path)
    buckets = len(manifest.placed)
    last = latest_per_key(updates, key, order).withColumn(BUCKET, bucket_of(key, buckets))
    maybe = [r[BUCKET] for r in last.select(BUCKET).distinct().collect()]  # no more than buckets
    keys = _read(spark, path, manifest, maybe).select(key)
    how = "left_semi" if mode == "update" else "left_anti"
    touched = sorted(r[BUCKET] for r in last.join(keys, key, how).select(BUCKET).distinct().collect())
    if not touched:
        return []
    old = _read(spark, path, manifest, touched).drop(*PLACES)
    changes = last.filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
    new = update_matched(old, changes, key, columns).drop("updated") if mode == "update" else insert_new(old, changes, key)
    new = new.select(*old.columns).withColumn(BUCKET, bucket_of(key, buckets))
    version = manifest.version + 1
    _write(new, path, Manifest(version, manifest.placed | dict.fromkeys(touched, version), manifest.schema))
    return touched
