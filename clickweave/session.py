"""Session helpers: a local session for tests/bench and the shared work folder.

Library operators never create sessions; they take DataFrames. Work folders
(checkpoints, materialised intermediates) live under ``spark.checkpoint.dir``
as the cluster names it; a private folder is chosen only when that is unset
(local tests).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "clickweave") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # local disk: list directories on the driver instead of launching a
        # listing job per scan (keep Spark's default on clusters/object stores)
        .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "4096")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a private one only if unset."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: clickweave writes stage tables and checkpoints to the "
                "cluster's shared folder and never to a machine-local temporary folder"
            )
        d = tempfile.mkdtemp(prefix="clickweave-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # some deployments lock core settings at runtime
            pass
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def work_path(spark: SparkSession, name: str, unique: bool = False) -> str:
    """A path under the shared folder for a materialised intermediate.

    ``unique`` paths (per-run stage tables) live under the application id, so a
    finished run's stage tables are one directory to remove.
    """
    base = shared_dir(spark)
    leaf = f"{spark.sparkContext.applicationId}/{_SCRATCH.get()}{name}-{uuid.uuid4().hex[:12]}" if unique else name
    return f"{base}/clickweave/{leaf}"


_SCRATCH: ContextVar[str] = ContextVar("scratch", default="")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Stage tables that are written inside go when the block ends. What must
    outlive it (a result) is written to a path taken before."""
    token = _SCRATCH.set(f"{_SCRATCH.get()}scratch-{uuid.uuid4().hex[:12]}/")
    path = f"{shared_dir(spark)}/clickweave/{spark.sparkContext.applicationId}/{_SCRATCH.get()}"
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        remove_path(spark, path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that nothing reads any more, through Hadoop's file systems."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def remove_stage_tables(spark: SparkSession) -> None:
    """Remove the stage tables of this application. Call it when no DataFrame
    that reads one is used any more; cached input trees stay."""
    remove_path(spark, f"{shared_dir(spark)}/clickweave/{spark.sparkContext.applicationId}")


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as a parquet table in the cluster's shared checkpoint
    folder and read it back (lineage is cut there).

    Used where one compact intermediate feeds two branches: without it the
    optimizer pushes the semi join below the aggregate and the (large) input
    is scanned and parsed twice. A written table (unlike an RDD checkpoint)
    is computed once, is columnar, survives executor loss and gives the
    optimizer real sizes for its broadcast decision.
    """
    spark = df.sparkSession
    path = work_path(spark, f"{name}", unique=True)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
