"""Text sinks: TSV lines, optional gzip, overwrite, run-labelled outputs, compaction.

One lazy plan, one write, one commit: no staging directories. A single output
file is an explicit opt-in (``num_files=1``), never the default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_text(
    lines: DataFrame,
    path: str,
    compression: str | None = None,
    num_files: int | None = None,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    balance: bool = False,
    max_records_per_file: int | None = None,
) -> None:
    """Write a ``value`` column (plus optional partition columns) as text files.

    ``num_files`` repartitions (a shuffle) to exactly that many files;
    ``coalesce`` is not used because it would also shrink the upstream
    parallelism. ``balance`` instead lets AQE cut the final shuffle into
    partitions of the advisory size (``rebalance``): file size stays bounded
    whatever the input volume. ``max_records_per_file`` caps file size
    without any shuffle (a task rolls over to a new file).
    """
    df = lines.repartition(num_files) if num_files else (lines.hint("rebalance") if balance else lines)
    w = df.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.text(path)


def write_tsv(
    df: DataFrame,
    path: str,
    columns: Sequence[str] | None = None,
    compression: str | None = None,
    num_files: int | None = None,
    mode: str = "overwrite",
    run: str | None = None,
) -> None:
    """Columns -> tab-joined lines (missing values print ``null``).

    ``run`` writes under ``<path>/run=<run>/`` (a run-labelled output
    directory); overwrite then replaces only that run (dynamic partition
    overwrite), leaving other runs alone.
    """
    cols = list(columns or df.columns)
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cols]).alias("value")
    if run is None:
        write_text(df.select(line), path, compression, num_files, mode)
        return
    out = df.select(line, F.lit(run).alias("run"))
    if num_files:
        out = out.repartition(num_files)
    w = out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("run")
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def compact_files(
    spark: SparkSession, src: str | Sequence[str], dst: str, num_files: int, compression: str | None = None
) -> None:
    """Rewrite the text files under ``src`` as ``num_files`` files in a new ``dst``."""
    paths = [src] if isinstance(src, str) else list(src)
    write_text(spark.read.text(paths), dst, compression=compression, num_files=num_files)


def compact_by_size(
    spark: SparkSession, src: str | Sequence[str], dst: str, target_bytes: int = 256 << 20, compression: str | None = None
) -> None:
    """Rewrite the text files under ``src`` as files of up to ``target_bytes`` of input each in a new ``dst``.

    Small files are put together and files over the target cut, by the scan
    itself: Spark packs what it reads into partitions of a byte limit, largest
    first, and every partition is written by the task that read it. No row is
    shuffled. (A gzip file is one piece whatever its size.)
    """
    packing = spark.newSession()  # the limits hold for this read only
    for key, value in {
        "spark.sql.files.maxPartitionBytes": target_bytes,
        "spark.sql.files.openCostInBytes": 0,
        "spark.sql.files.minPartitionNum": 1,  # fewer partitions than cores, if the bytes say so
    }.items():
        packing.conf.set(key, str(value))
    paths = [src] if isinstance(src, str) else list(src)
    write_text(packing.read.text(paths), dst, compression=compression)


def write_snapshot(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a table version as parquet to a NEW path (never the one being read)."""
    df.write.mode(mode).parquet(path)
