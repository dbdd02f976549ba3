"""Session helpers: a test session, and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, partitions: int = 8, name: str = "tidewater") -> SparkSession:
    """Session for tests and the bench.  On a cluster, build your own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_OWN_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a fresh temporary folder: there the
    driver and the executors are one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _OWN_DIRS:
        _OWN_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="tidewater-")
    return _OWN_DIRS[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts lineage and fixes values that a lost executor could otherwise
    recompute differently (partition numbers, for one).
    """
    path = scratch_path(df.sparkSession, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def size_in_bytes(df: DataFrame) -> int:
    """Optimizer's size estimate for a plan; an upper guide for broadcasts."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


SPREAD_BYTES = 16 << 20


def spread(df: DataFrame) -> DataFrame:
    """Deal a small input out to all task slots before heavy per-row work.

    A small file is often one row group and so one task.  An input with enough
    bytes for every slot is left as the scan splits it: no shuffle at scale.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if size_in_bytes(df) < slots * SPREAD_BYTES else df
