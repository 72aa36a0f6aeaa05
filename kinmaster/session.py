"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_MARKED: set[str] = set()


def local_session(cpus: int | str = 8, app: str = "kinmaster") -> SparkSession:
    """A single-machine session for tests and the benchmark.

    On a cluster the session comes from spark-submit; the library sets nothing
    there beyond what each operator needs.
    """
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("KINMASTER_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def workspace(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables, below the shared one.

    The cluster names that in ``spark.checkpoint.dir``. Where it is unset a
    local master (tests) gets a temporary folder; any other master is refused,
    because a machine-local path would be lost with its machine. The folder is
    removed when the driver ends.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="kinmaster-"))
        base = context.getCheckpointDir()
    folder = f"{base.rstrip('/')}/kinmaster/{context.applicationId}"
    if folder not in _MARKED:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        system = path.getFileSystem(context._jsc.hadoopConfiguration())
        system.mkdirs(path)
        system.deleteOnExit(path)
        _MARKED.add(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody else uses, inside the workspace."""
    return f"{workspace(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the workspace and read it back.

    This cuts lineage like ``checkpoint()`` does, survives lost executors, and
    as Parquet keeps column pruning and gives the planner real sizes.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(table: DataFrame) -> None:
    """Remove the files of a table that ``materialise`` returned and that nothing will read again.

    Only files of this application's workspace are touched, so any other table is left alone.
    """
    spark = table.sparkSession
    context, folder = spark.sparkContext, f"{workspace(spark)}/"
    for written in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        if folder in f"{written}/":
            path = context._jvm.org.apache.hadoop.fs.Path(written)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


# Inputs below this estimate may sit in too few row groups to use all cores.
SMALL_INPUT = 64 << 20


def spread(df: DataFrame) -> DataFrame:
    """Redistribute a small input before heavy work per row; leave others alone."""
    estimate = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if estimate < SMALL_INPUT else df
