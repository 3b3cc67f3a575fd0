"""The bucketed feature store and compaction by size."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from clickweave.operators import insert_new, update_matched
from clickweave.sinks import compact_by_size
from clickweave.sinks.store import bucket_of, create_store, read_store, update_store, versions

SCHEMA = "_id string, note string, htc_key array<array<string>>, htc_value array<array<double>>"


def features(i, word):
    return (str(i), f"n{i}", [[word]], [[float(i)]])


def rows_of(df):
    return sorted(map(str, df.select("_id", "note", "htc_key", "htc_value").collect()))


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/data/**/*.parquet", recursive=True)}


def test_update_rewrites_only_touched_buckets(spark, tmp_dir):
    path = f"{tmp_dir}/store"
    first = spark.createDataFrame([features(i, "old") for i in range(300)], SCHEMA)
    create_store(first, path, buckets=16)
    before = files(path)
    changed = [i for i in range(400) if i % 97 == 5]  # one of them is not in the store
    updates = spark.createDataFrame([features(i, "new") for i in changed] + [(None, None, [["x"]], [[0.0]])], SCHEMA)
    touched = update_store(spark, path, updates)
    buckets = {r._id: r.b for r in first.select("_id", bucket_of("_id", 16).alias("b")).collect()}
    assert touched == sorted({buckets[str(i)] for i in changed if i < 300}) and 0 < len(touched) < 16
    assert {f: t for f, t in files(path).items() if f in before} == before
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in files(path) if f not in before} == set(touched)
    whole = update_matched(first, updates.select("_id", "htc_key", "htc_value"))
    assert rows_of(read_store(spark, path)) == rows_of(whole)
    assert rows_of(read_store(spark, path, version=1)) == rows_of(first)
    places = read_store(spark, path, with_places=True).select("version", "bucket").distinct().collect()
    assert {(r.version, r.bucket) for r in places} == {(2 if b in touched else 1, b) for b in set(buckets.values())}


def test_inserts_empty_buckets_and_unknown_keys(spark, tmp_dir):
    path = f"{tmp_dir}/store"
    first = spark.createDataFrame([features(i, "old") for i in range(3)], SCHEMA)
    create_store(first, path, buckets=64)  # most buckets are empty
    none = spark.createDataFrame([features(1000, "new")], SCHEMA)
    assert update_store(spark, path, none) == [] and versions(spark, path) == [1]
    assert update_store(spark, path, none.limit(0)) == []
    new = spark.createDataFrame([features(i, "new") for i in range(2, 9)] + [features(8, "zz")], SCHEMA)
    assert update_store(spark, path, new, mode="insert")
    assert rows_of(read_store(spark, path)) == rows_of(insert_new(first, new))
    assert update_store(spark, path, new.filter("_id = '3'").withColumn("htc_key", F.lit([["again"]])))
    assert versions(spark, path) == [1, 2, 3]
    got = {r._id: r.htc_key for r in read_store(spark, path).collect()}
    assert got["3"] == [["again"]] and got["0"] == [["old"]] and got["8"] == [["zz"]] and len(got) == 9
    with pytest.raises(FileExistsError):
        create_store(first, path)
    with pytest.raises(FileNotFoundError):
        read_store(spark, f"{tmp_dir}/none")
    empty = f"{tmp_dir}/empty"
    create_store(first.limit(0), empty, buckets=4)
    assert read_store(spark, empty).count() == 0
    assert update_store(spark, empty, new, mode="insert") and read_store(spark, empty).count() == 7


def test_compaction_packs_by_size_without_a_shuffle(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/src")
    lines = []
    for i in range(40):
        some = [f"{i}-{j}-" + "x" * 50 for j in range(1 + i % 7 * 10)]
        lines += some
        with open(f"{tmp_dir}/src/part-{i:03d}.txt", "w") as f:
            f.write("".join(s + "\n" for s in some))
    total = sum(os.path.getsize(f) for f in glob.glob(f"{tmp_dir}/src/*"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    compact_by_size(spark, f"{tmp_dir}/src", f"{tmp_dir}/dst", target_bytes=8192)
    sizes = [os.path.getsize(f) for f in glob.glob(f"{tmp_dir}/dst/part-*")]
    assert max(sizes) <= 8192 + 80 and total / 8192 <= len(sizes) <= 2 * total / 8192 + 1
    assert sorted(r.value for r in spark.read.text(f"{tmp_dir}/dst").collect()) == sorted(lines)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    compact_by_size(spark, f"{tmp_dir}/src", f"{tmp_dir}/one", target_bytes=1 << 30, compression="gzip")
    assert len(glob.glob(f"{tmp_dir}/one/part-*.gz")) == 1
